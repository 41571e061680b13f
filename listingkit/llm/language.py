"""Language identification, words first (operator 6).

A known word counts with its log frequency in every language.  An unseen word
falls back to character n-grams of its marked form ("<word>"), the longest
length of which one is known, and each step down costs a little.  All counts
come from all training documents; the model keeps the most frequent words and
n-grams (a bounded number), whatever is rarer falls back.

Verdicts compare distributions that share one floor: a small part of each is the
frequency in all languages together, so that a language learned from few words
is no likelier for the words it never had.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingkit.llm.common import cut, fold_held_out, most_frequent, table
from listingkit.llm.textarrays import coded_words, slices

#: Words and n-grams (of each length) that a model keeps.
WORDS, GRAMS, LENGTHS = 50_000, 20_000, (4, 3, 2, 1)
#: Smoothing count, log penalty of each step down, words that make a verdict sure.
ADD, STEP, SURE = 0.5, 0.5, 10
UNKNOWN = "und"
#: Part of every language's frequencies that is the frequency in all languages.
SHARED = 0.01

#: Bytes of text that a task works on at a time.
SLICE = 8 << 20

_RUN = re.compile(r"[^\W\d_]+")
_MARK = ("<", ">")


def letters(word: str) -> list[str]:
    """Lower-case letter runs of a word."""
    return [r for r in _RUN.findall(word.lower()) if r.isalpha()]


def grams(word: str, n: int) -> list[str]:
    marked = f"{_MARK[0]}{word}{_MARK[1]}" if n > 1 else word
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


def _counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) over all documents, summed in the tasks first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, 1, SLICE):
                lang = part.column(0).dictionary_encode()
                langs, of = lang.dictionary.to_pylist(), lang.indices.to_numpy()
                code, first, words = coded_words(part.column(1))
                pair = np.repeat(of, np.diff(first)).astype(np.int64) * max(1, len(words)) + code
                pair, n = np.unique(pair, return_counts=True)
                runs = [letters(w) for w in words]
                total: Counter[tuple[int, str]] = Counter()
                for p, k in zip(pair.tolist(), n.tolist()):
                    of_lang, w = divmod(p, len(words))
                    for r in runs[w]:
                        total[of_lang, r] += k
                if total:
                    at, w = zip(*total)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([langs[i] for i in at], pa.string()), pa.array(w, pa.string()),
                         pa.array(list(total.values()), pa.int64())], names=["lang", "word", "n"])
    counted = docs.mapInArrow(count, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _gram_counts(counts: DataFrame) -> DataFrame:
    """(lang, word, n): n-grams of the counted words, as if words."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[tuple[str, str]] = Counter()

        def flush() -> pa.RecordBatch:
            lang, gram = zip(*total)
            return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(gram, pa.string()),
                                               pa.array(list(total.values()), pa.int64())], names=["lang", "word", "n"])
        for b in batches:
            for lang, word, n in zip(*(c.to_pylist() for c in b.columns)):
                for k in LENGTHS:
                    for g in grams(word, k):
                        total[lang, g] += n
            if len(total) > 500_000:
                yield flush()
                total.clear()
        if total:
            yield flush()
    return counts.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


@dataclass
class Counts:
    """Kept words (or n-grams), numbered, their counts by language (a row each),
    and the counts of all words by language."""
    at: dict[str, int]
    n: np.ndarray
    totals: np.ndarray

    def logs(self, shared: float) -> np.ndarray:
        """Log frequencies: of each language by itself with a smoothing count, or
        with a part ``shared`` from all languages together."""
        if not shared:
            return np.log((self.n + ADD) / (self.totals + 1))
        every = self.n.sum(1, keepdims=True) / max(1.0, self.totals.sum())
        return np.log((1 - shared) * self.n / np.maximum(self.totals, 1) + shared * every)


@dataclass
class Model:
    langs: list[str]
    words: Counts
    grams: Counts

    def scores(self, runs: list[str], shared: float = 0.0) -> np.ndarray:
        """Log frequencies of letter runs in every language (a row each): of the
        word, else the mean of the longest n-grams of which any is known."""
        at = np.array([self.words.at.get(r, -1) for r in runs], np.int64)
        out = np.full((len(runs), len(self.langs)), math.log(1e-9))
        out[at >= 0] = self._logs(self.words, shared)[at[at >= 0]]
        left, find = np.flatnonzero(at < 0), self.grams.at.get
        for step, n in enumerate(LENGTHS, 1):
            found = [[g for i in range(len(m) - n + 1) if (g := find(m[i:i + n])) is not None]
                     for m in (f"<{runs[k]}>" if n > 1 else runs[k] for k in left.tolist())]
            size = np.array([len(f) for f in found], np.int64)
            hit = np.flatnonzero(size)
            if len(hit):
                flat = self._logs(self.grams, shared)[[g for f in found for g in f]]
                first = np.cumsum(size[hit]) - size[hit]
                out[left[hit]] = np.add.reduceat(flat, first, axis=0) / size[hit][:, None] - step * STEP
            left = left[size == 0]
        return out

    def _logs(self, counts: Counts, shared: float) -> np.ndarray:
        """``counts.logs``, kept for the next slice."""
        made = self.__dict__.setdefault("_made", {})
        key = id(counts), shared
        if key not in made:
            made[key] = counts.logs(shared)
        return made[key]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_made"}

    def predict(self, texts: pa.Array) -> tuple[list[str], list[float]]:
        code, first, words = coded_words(texts)
        runs = [letters(w) for w in words]
        weight = np.array([len(r) for r in runs], np.int64)
        flat = [x for r in runs for x in r]
        scores = np.zeros((len(runs), len(self.langs)))
        np.add.at(scores, np.repeat(np.arange(len(runs)), weight), self.scores(flat, SHARED))
        n = np.diff(np.concatenate([[0], np.cumsum(weight[code])])[first])
        total = np.zeros((len(n), len(self.langs)))
        for k in range(len(self.langs)):
            total[:, k] = np.diff(np.concatenate([[0], np.cumsum(scores[code, k])])[first])
        z = total / np.maximum(n, 1)[:, None] * np.minimum(n, SURE)[:, None]
        z = np.exp(z - z.max(axis=1, keepdims=True)) if len(self.langs) else z
        best = z.argmax(axis=1) if len(self.langs) else np.zeros(len(n), np.int64)
        lang = [self.langs[i] if k and self.langs else UNKNOWN for i, k in zip(best.tolist(), n.tolist())]
        sure = [float(r[i] / r.sum()) if k and self.langs else 0.0 for r, i, k in zip(z, best.tolist(), n.tolist())]
        return lang, sure


def _kept(counts: DataFrame, langs: list[str], totals: dict[str, int], keep: int, by_length: bool) -> Counts:
    """The most frequent words and their counts."""
    per = cut(counts.groupBy("word").agg(F.sum("n").alias("total")))
    at: dict[str, int] = {}
    rows: list[tuple[int, int, int]] = []
    for length in (LENGTHS if by_length else (None,)):
        top = most_frequent(per.where(F.length("word") == length) if length else per, "total", keep)
        found = counts.join(F.broadcast(top.select("word")), "word").collect()    # keep x languages
        rows += [(at.setdefault(r.word, len(at)), langs.index(r.lang), r.n) for r in sorted(found, key=lambda r: r.word)]
    n = np.zeros((len(at), len(langs)))
    for word, lang, k in rows:
        n[word, lang] += k
    return Counts(at, n, np.array([totals.get(x, 0) for x in langs], float))


def learn(docs: DataFrame) -> Model:
    """Model from rows (lang, text) without null languages."""
    counts = cut(_counts(docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))))
    totals = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    if not langs:
        nothing = Counts({}, np.zeros((0, 0)), np.zeros(0))
        return Model([], nothing, nothing)
    grams_of = cut(_gram_counts(counts))
    gram_totals = {r.lang: r.n for r in grams_of.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    return Model(langs, _kept(counts, langs, totals, WORDS, False), _kept(grams_of, langs, gram_totals, GRAMS, True))


def identify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row.

    Null and empty texts and texts without a letter are ``und`` with score 0, as
    is every text if nothing was learned.  Ties go to the first language by
    code point.  Repeated rows keep a row each."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, 1, SLICE):
                lang, score = shared.value.predict(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                                 names=["doc_id", "lang_pred", "score"])
    return rows.mapInArrow(predict, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned from four fifths of the documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = fold_held_out(F.col("doc_id"), 5, 0)
    model = learn(docs.where(~held & F.col("doc_id").isNotNull() & F.col("lang").isNotNull()))
    return identify(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")
