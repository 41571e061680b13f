"""Toxicity by a weighted lexicon (operator 1).

Texts are folded (case, homoglyphs, digits and signs that stand for letters
inside words) and scanned with an Aho-Corasick automaton.  A term is a word
("idiot") or the beginning of words ("lowei*"); exception phrases that cover a
match take it back.  The weights found are summed, divided by a slowly growing
function of the length, and a logistic curve turns them into a score.

The lexicon is learned: terms are counted in labelled documents, weighted by
their log odds, and kept where the odds are sure.  Labelled rows are a bounded
sample (``sample`` documents of either label, by hash of the id), the terms
are a bounded list; scoring reads every whole text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingkit.llm.common import cut, fold_held_out, table
from listingkit.llm.textarrays import shingle_sets, slices

#: Labelled documents of either label that are learned from, at most.
SAMPLE = 8_000
#: Candidate terms that are counted, terms and exceptions of a lexicon, at most.
CANDIDATES, TERMS, EXCEPTIONS = 20_000, 2_000, 5_000
PREFIXES = (4, 5, 6, 7)
#: Toxic documents that a term is in, at least, whatever the size of the sample.
LEAST = 4
THRESHOLD = 0.7
#: Standard errors by which a term's log odds are lowered before they count.
SURE = 1.5

#: Letters of other scripts that look like Latin ones.
HOMOGLYPHS = str.maketrans(
    "аеорсухіјѕкмтвнԁ"
    "αεορτυχικνıɡ",
    "aeopcyxijskmtbhd" "aeoptuxikvig")
HOMOGLYPHS.update({0xFF41 + i: chr(97 + i) for i in range(26)})
HOMOGLYPHS.update({0xFF10 + i: chr(48 + i) for i in range(10)})
HOMOGLYPHS.update({c: None for c in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)})
_FOREIGN = re.compile("[­ıɡͰ-ԯ​-‍⁠﻿０-ｚ]")
_SIGNS = re.compile(r"(?<!\w)[013457@$]{1,2}(?=[^\W\d_])|(?<=[^\W\d_])[013457@$!]{1,2}(?=[^\W\d_])")
DIGITS = (str.maketrans("013457@$!", "oieastasi"), str.maketrans("013457@$!", "oleastasi"))
WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> list[str]:
    """The folded text; two readings where a 1 or ! may be an i or an l."""
    text = text.lower()
    if _FOREIGN.search(text):
        text = text.translate(HOMOGLYPHS)
    if not _SIGNS.search(text):
        return [text]
    return list({_SIGNS.sub(lambda m: m.group().translate(d), text) for d in DIGITS})


@dataclass
class Lexicon:
    """weights: "word" or "beginning*" -> weight; exceptions: phrases."""
    weights: dict[str, float]
    exceptions: set[str] = field(default_factory=set)
    bias: float = -3.0
    slope: float = 3.0

    def automaton(self):
        import ahocorasick
        found = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            found.add_word(term.rstrip("*"), ("term", len(term.rstrip("*")), weight, term.endswith("*")))
        for phrase in self.exceptions:
            if phrase not in found:
                found.add_word(phrase, ("exception", len(phrase), 0.0, False))
        if len(found):
            found.make_automaton()
        return found

    def strength(self, text: str | None, automaton) -> tuple[float, int]:
        """(weight found by length, matches) of one whole text."""
        best, hits = 0.0, 0
        for t in fold(text or "") if len(automaton) else []:
            spans, out = [], []
            for last, (kind, size, weight, open_end) in automaton.iter(t):
                start, end = last - size + 1, last + 1
                if (start and t[start - 1].isalpha()) or (not open_end and end < len(t) and t[end].isalpha()):
                    continue
                (spans if kind == "term" else out).append((start, end, weight))
            places: dict[int, float] = {}
            for a, b, w in spans:
                if not any(x <= a and b <= y for x, y, _ in out):
                    places[a] = max(w, places.get(a, 0.0))
            best, hits = max(best, sum(places.values())), max(hits, len(places))
        return best / (1 + math.log1p(len(text or "") / 600)), hits

    def score(self, strength: float) -> float:
        z = max(-500.0, min(500.0, self.bias + self.slope * strength))
        return 1 / (1 + math.exp(-z))


def _terms(text: str | None) -> set[str]:
    words = {w for t in fold(text or "") for w in WORD.findall(t) if 3 <= len(w) <= 40}
    return words | {w[:k] + "*" for w in words for k in PREFIXES if len(w) >= k}


def _count_terms(texts: DataFrame, wanted: set[str] | None) -> DataFrame:
    """(term, n): in how many of the texts a term is; of ``wanted`` terms and of
    words they begin, if given."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter[str] = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                terms = _terms(t)
                if wanted is not None:
                    terms = {x for x in terms if x in wanted or
                             (x[-1] != "*" and any(x[:k] + "*" in wanted for k in PREFIXES))}
                n.update(terms)
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())],
                                         names=["term", "n"])
    return texts.mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def _odds(n1: float, n0: float, size1: int, size0: int) -> float:
    return math.log((n1 + 0.5) / (size1 + 1)) - math.log((n0 + 0.5) / (size0 + 1))


def _choose(toxic: dict[str, int], clean: dict[str, int], size1: int, size0: int) -> Lexicon:
    """Terms with sure odds, shortest that explain the counts, and exceptions."""
    sure = {}
    for t, n1 in toxic.items():
        n0 = clean.get(t, 0)
        odds = _odds(n1, n0, size1, size0)
        if n1 >= LEAST and (low := odds - SURE * math.sqrt(1 / (n1 + 0.5) + 1 / (n0 + 0.5))) >= 1.5:
            sure[t] = (n1 * low, odds)
    chosen: dict[str, float] = {}
    for t in sorted(sure, key=lambda x: (-round(sure[x][0], 6), len(x), x)):
        stem = t.rstrip("*")
        if any(stem[:k] + "*" in chosen for k in PREFIXES if k < len(stem) + (t[-1] != "*")):
            continue
        if t[-1] == "*":
            known = [c for c in chosen if c.rstrip("*").startswith(stem)]
            left1 = toxic[t] - sum(toxic[c] for c in known)
            if known and left1 < LEAST:
                continue
        chosen[t] = min(sure[t][1], 8.0)
        if len(chosen) >= TERMS:
            break
    against = [w for w, n0 in clean.items() if w[-1] != "*" and w not in chosen and n0 >= 2
               and _odds(toxic.get(w, 0), n0, size1, size0) < 0
               and any(w[:k] + "*" in chosen for k in PREFIXES)]
    against.sort(key=lambda w: (-clean[w], w))
    return Lexicon(chosen, set(against[:EXCEPTIONS]))


def _calibrate(lexicon: Lexicon, x: np.ndarray, y: np.ndarray) -> None:
    """Logistic curve of the strength by Newton steps, with a weak prior."""
    w = np.array([-3.0, 3.0])
    if len(y):
        m = np.stack([np.ones_like(x), x], 1)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(m @ w, -30, 30)))
            g = m.T @ (p - y) + 0.05 * (w - np.array([-3.0, 3.0]))
            h = (m * (p * (1 - p))[:, None]).T @ m + 0.05 * np.eye(2)
            step = np.linalg.solve(h, g)
            w = w - np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-8:
                break
    lexicon.bias, lexicon.slope = float(w[0]), max(0.1, float(w[1]))


def _with_least_shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the least 3-word shingle hash: near copies mostly share it, so that
    a group of copies is learned from about once."""
    for b in batches:
        for part in slices(b, 0):
            least = [int(s[0]) >> 1 if len(s) else 0 for s in shingle_sets(part.column(0), 3)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1).cast(pa.int32()), pa.array(least, pa.int64())],
                                             names=["text", "toxic", "least"])


def learn_lexicon(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Lexicon:
    """Lexicon from the labelled documents (doc_id, text) x (doc_id, toxic).

    Documents held out (crc32 of the id mod 3 is 1), null labels and null ids
    are not used.  An id labelled both ways counts as toxic.  Without rows of
    both labels the lexicon is empty."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic")).where(~fold_held_out(F.col("doc_id"), 3, 1))
    chosen = None
    for label in (0, 1):        # top-k of hashes: bounded by ``sample``
        part = known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        chosen = part if chosen is None else chosen.unionAll(part)
    texts = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(cut(chosen)), "doc_id").select("text", "toxic")
    texts = cut(texts.mapInArrow(_with_least_shingle, "text string, toxic int, least long")
                .groupBy("least", "toxic").agg(F.min("text").alias("text")).select("text", "toxic"))
    size = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    size1, size0 = size.get(1, 0), size.get(0, 0)
    if not size1 or not size0:
        return Lexicon({})
    found = _count_terms(texts.where("toxic = 1").select("text"), None).where(F.col("n") >= 3)
    toxic = {r["term"]: r["n"] for r in found.orderBy(F.col("n").desc(), "term").limit(CANDIDATES).collect()}
    found = _count_terms(texts.where("toxic = 0").select("text"), set(toxic))
    clean = {r["term"]: r["n"] for r in found.orderBy(F.col("n").desc(), "term").limit(5 * CANDIDATES).collect()}
    lexicon = _choose(toxic, clean, size1, size0)
    strengths = _apply(texts.select(F.lit(0).alias("doc_id"), "text", "toxic"), lexicon, ["toxic"])
    xy = np.array([(r["strength"], r["toxic"]) for r in strengths.select("strength", "toxic").collect()], float)
    _calibrate(lexicon, xy[:, 0], xy[:, 1])
    return lexicon


def _apply(docs: DataFrame, lexicon: Lexicon, keep: Iterable[str]) -> DataFrame:
    keep = list(keep)
    rows = docs.select(F.col("text").cast("string").alias("_text"), *keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for b in batches:
            for part in slices(b, 0):
                got = [lexicon.strength(t, automaton) for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array([s for s, _ in got], pa.float64()),
                     pa.array([h for _, h in got], pa.int64()),
                     pa.array([lexicon.score(s) for s, _ in got], pa.float64())],
                    names=[*keep, "strength", "matches", "score"])

    return rows.mapInArrow(scan, f"{schema}, strength double, matches long, score double")


def score_toxicity(docs: DataFrame, lexicon: Lexicon, keep: Iterable[str] = ("doc_id",),
                   threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` columns, strength, matches, score (0 to 1), predicted (0 or 1).

    Null and empty texts hold no match and get the lowest score.  A row each
    for repeated rows; an empty table gives none."""
    return _apply(docs, lexicon, keep).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learned from the labels not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = learn_lexicon(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, lexicon).select(
        "doc_id", fold_held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", "predicted", "matches")
