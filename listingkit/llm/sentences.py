"""Substring dedup by sliding sentence spans (operator 9).

Every run of several consecutive sentences is hashed; runs are counted over all
documents, places of runs that several documents hold meet the first of them in
a join, and sentences covered by a run that is not its first place are removed.

Tokens are words between white space; characters of scripts that put no spaces
between words are tokens of their own.  A sentence ends after a stop of any
script (and closing marks) or at a line feed.  Stretches without stops are cut
as well, where a token's surroundings hash to the least value of a window: such
cuts, like the stops, depend on few tokens around them, so two places of a
passage are cut alike but for its ends.

A run begins at every sentence and takes SENTENCES of them, or more until it
has TOKENS tokens; one ends with every sentence, by the same rule.  Every covered
sentence goes, however short the stretch; ``min_passage`` can spare short ones.

With ``once``, a second text comes beside the first: there runs of SENTENCES
sentences count whatever their tokens, and places in the same document as well,
so that no run is left twice in all texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingkit.llm.common import table, written
from listingkit.llm.textarrays import hash_words, mix64, slices

#: Sentences of a run, at least; tokens of a run, at least.
SENTENCES, TOKENS = 3, 12
#: Tokens of the shortest stretch that is removed; 0: every covered sentence goes.
MIN_PASSAGE = 0
#: A cut by content is the least of REACH tokens to either side, none of which
#: is next to the end of a sentence.
REACH = 3
#: Bytes of text that a task works on at a time.
SLICE = 4 << 20

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Letters of scripts written without spaces (Thai to Khmer, kana, Han).
_UNSPACED = r"[\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{2E80}-\x{A4CF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}]"
_STOP = r"[.!?…。．！？؟۔।॥]+[\"'»”’)\]」』）]*$"
#: Stands for a line feed among the tokens; a private character, no word.
_LINE = ""


class Tokens:
    """Tokens and sentences of an Arrow column of texts; null is empty.

    hashes: of every token; first: first token of each text, plus the end;
    units: first token of every sentence, plus the end; first_unit: first
    sentence of each text, plus the end."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts, "")
        raw = texts.buffers()[2]
        if raw is not None and (np.frombuffer(raw, np.uint8) >= 0xE0).any():
            texts = pc.replace_substring_regex(texts, f"({_UNSPACED})", r" \1 ")
        self.split = pc.utf8_split_whitespace(pc.replace_substring(texts, "\n", f" {_LINE} "))
        coded = self.split.flatten().dictionary_encode()
        words = coded.dictionary
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        first = self.split.offsets.to_numpy().astype(np.int64)
        first -= first[0]
        line = pc.equal(words, _LINE).to_numpy(zero_copy_only=False)
        real = ~(line | pc.equal(words, "").to_numpy(zero_copy_only=False))[code]
        stop = pc.match_substring_regex(words, _STOP).to_numpy(zero_copy_only=False)
        place = np.cumsum(real)                                   # tokens up to and with each entry
        self.first = np.concatenate([[0], place])[first]
        n = int(self.first[-1])
        ends = np.zeros(n + 1, bool)
        ends[place[line[code]]] = True                            # a token that a line feed follows
        ends = ends[1:]
        self.code = code[real]
        ends |= stop[self.code]
        self.hashes = hash_words(words.to_pylist())[self.code] if n else np.zeros(0, np.uint64)
        ends[self.first[1:][self.first[1:] > self.first[:-1]] - 1] = True
        cuts = np.flatnonzero(ends | self._cuts(ends))
        self.units = np.concatenate([[0], cuts + 1]) if n else np.zeros(1, np.int64)
        self.first_unit = np.searchsorted(self.units, self.first)

    def _cuts(self, ends: np.ndarray) -> np.ndarray:
        """Tokens after which a stretch without stops is cut; where words repeat
        and several are least, after each of them."""
        n = len(ends)
        near = np.zeros(n + 2 * REACH + 2, bool)                  # an end within REACH, or just before
        for k in range(2 * REACH + 2):
            near[k:n + k] |= ends
        near = near[REACH:n + REACH]
        near[:REACH + 1] = True                                   # the first text begins as others do
        h = np.concatenate([self.hashes[:1], self.hashes, self.hashes[-1:]])
        around = mix64((h[:-2] * _P + h[1:-1]) * _P + h[2:]) if n else h
        edge = np.full(REACH, np.uint64(0xFFFFFFFFFFFFFFFF))
        wide = np.concatenate([edge, around, edge])
        least = np.ones(n, bool)
        for k in range(REACH):
            least &= (around <= wide[k:n + k]) & (around <= wide[REACH + 1 + k:][:n])
        return least & ~near

    def runs(self, short: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash, text, first token, last token + 1) of every run; with ``short``,
        also of SENTENCES sentences that have fewer than TOKENS tokens together."""
        units = len(self.units) - 1
        if units < 1:
            return (np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3)
        size = np.diff(self.units)
        place = np.arange(len(self.hashes)) - np.repeat(self.units[:-1], size)
        powers = np.concatenate([[np.uint64(1)], np.full(int(max(size.max(), units)), _P)]).cumprod(dtype=np.uint64)
        own = mix64(np.add.reduceat(self.hashes * powers[place], self.units[:-1]) + size.astype(np.uint64))
        total = np.concatenate([[np.uint64(0)], np.cumsum(own * powers[:units], dtype=np.uint64)])
        start = np.arange(units)
        end = np.maximum(start + SENTENCES, np.searchsorted(self.units, self.units[:-1] + TOKENS))
        # the same from every end backwards, where that is another run
        last = np.arange(1, units + 1)
        begin = np.minimum(last - SENTENCES, np.searchsorted(self.units, self.units[1:] - TOKENS, side="right") - 1)
        other = (begin >= 0) & (end[np.maximum(begin, 0)] != last)
        few = np.flatnonzero(end > start + SENTENCES) if short else start[:0]
        start, end = np.concatenate([start, begin[other], few]), np.concatenate([end, last[other], few + SENTENCES])
        text = np.searchsorted(self.first_unit, start, side="right") - 1
        fits = end <= self.first_unit[1:][text]
        start, end, text = start[fits], end[fits], text[fits]
        back = np.concatenate([[np.uint64(1)], np.full(units, _P_INVERSE)]).cumprod(dtype=np.uint64)
        h = mix64((total[end] - total[start]) * back[start] + (end - start).astype(np.uint64))
        return h, text, self.units[start], self.units[end]


def run_rows(docs: DataFrame, short: bool = False) -> DataFrame:
    """(hash, row_key, span): every run of every document; ``span`` is its first
    token times 2^32 plus its number of tokens."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, 0, SLICE):
                t = Tokens(part.column(0))
                h, text, start, end = t.runs(short)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), part.column(1).take(pa.array(text)),
                     pa.array((start - t.first[text] << 32) + end - start)], names=["hash", "row_key", "span"])
    return docs.select("text", "row_key").mapInArrow(emit, "hash long, row_key long, span long")


def repeated_spans(docs: DataFrame, short: bool = False) -> DataFrame:
    """(doc_id, row_key, spans): runs whose first place is in another document.

    Counts are summed in the tasks before they are shuffled, so a passage that
    very many documents share is no hot group; places are looked up for
    repeated hashes alone, by joins, which Spark splits where they are skewed.
    Runs are made anew for the second look, which is cheaper than keeping all."""
    # a document that holds a run twice counts twice, and is sorted out below
    often = run_rows(docs, short).groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    ids = docs.select("row_key", "doc_id").distinct()
    some = written(run_rows(docs, short).join(written(often, "often"), "hash").join(ids, "row_key"), "repeated-runs")
    # first places: the smallest id, null first, then the smallest key
    least = some.groupBy("hash").agg(F.min("doc_id").alias("id"), F.count("doc_id").alias("known"), F.count("*").alias("n"))
    least = least.select("hash", F.when(F.col("known") == F.col("n"), F.col("id")).alias("first_id"))
    of_id = some.join(least, "hash").where(F.col("doc_id").eqNullSafe(F.col("first_id")))
    first = written(of_id.groupBy("hash").agg(F.min("row_key").alias("first_key")), "first-places")
    later = some.join(first, "hash").where("row_key != first_key").select("doc_id", "row_key", "span")
    return later.groupBy("doc_id", "row_key").agg(F.collect_set("span").alias("spans"))


def _again(t: Tokens, short: bool) -> tuple[np.ndarray, np.ndarray]:
    """(text, span) of the runs that their own text holds before, in order of texts."""
    h, text, start, end = t.runs(short)
    order = np.lexsort((start, h, text))
    h, text, start, end = h[order], text[order], start[order], end[order]
    again = np.flatnonzero((h[1:] == h[:-1]) & (text[1:] == text[:-1])) + 1
    return text[again], (start[again] - t.first[text[again]] << 32) + end[again] - start[again]


def _covered(spans: np.ndarray, n: int) -> np.ndarray:
    """Which of n tokens the spans cover."""
    steps = np.zeros(n + 1, np.int64)
    start = spans >> 32
    np.add.at(steps, start, 1)
    np.add.at(steps, start + (spans & 0xFFFFFFFF), -1)
    return np.cumsum(steps[:-1]) > 0


def _remove(text: str, words: list[str], covered: np.ndarray, min_passage: int) -> tuple[str, np.ndarray]:
    """(text without the covered stretches that are long enough, tokens that went)."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    gone = np.zeros(len(covered), bool)
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        gone[a:b] = b - a >= min_passage
    if not gone.any():
        return text, gone
    starts, at = [], 0
    for w in words:
        at = text.index(w, at)
        starts.append(at)
        at += len(w)
    starts.append(len(text))
    kept, at = [], 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        kept.append(text[at:starts[a]])
        at = starts[b]
    return "".join([*kept, text[at:]]), gone


def dedup_sentences(docs: DataFrame, min_passage: int = MIN_PASSAGE, within: bool = False,
                    doc_id: str = "doc_id", text: str = "text", once: bool = False) -> DataFrame:
    """The documents with repeated passages removed from ``text``, and columns
    n_sentences, n_removed (sentences that went), removed_words (tokens).

    What several documents hold stays in the first of them only.  Covered
    stretches of fewer than ``min_passage`` tokens stay.  With ``within``, runs that a document repeats itself go as well, but for their
    first place.  A passage loses the sentences that lie in it whole; words of it
    that share a sentence with others around it stay.

    With ``once``, two columns more: text_once, the text without every sentence
    that a repeated run of SENTENCES sentences covers but for its first place,
    however few tokens the run has and also where the first place is in the same
    document; n_repeated, the sentences that went from it.

    Other columns stay as they are, but for those of these names.  Null texts
    stay null; blank texts, and texts with fewer sentences or tokens than a run,
    stay as they are.  Rows with equal id and text are one document and come out
    alike; ids order the documents, null first, equal ids by a hash of the text."""
    new = ("n_sentences", "n_removed", "removed_words", *(("text_once", "n_repeated") if once else ()))
    extra = [c for c in docs.columns if c not in (doc_id, text, *new)]
    one = docs.select(F.struct(*extra).alias("_extra") if extra else F.lit(None).cast("string").alias("_extra"),
                      F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    one = one.withColumn("row_key", F.xxhash64("doc_id", "text"))
    found = repeated_spans(one, once)
    same = one["doc_id"].eqNullSafe(found["doc_id"]) & (one["row_key"] == found["row_key"])
    joined = one.join(found, same, "left").select("_extra", one["doc_id"], one["text"], "spans")
    none = np.zeros(0, np.int64)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, 2, SLICE):
                t = Tokens(part.column(2))
                texts, total = part.column(2).to_pylist(), np.diff(t.first_unit)
                of, again = _again(t, once) if within or once else (none, none)
                edge = np.searchsorted(of, np.arange(len(texts) + 1))
                rows, rows_once = [], []
                for i, s in enumerate(texts):
                    spans = part.column(3)[i]
                    spans, own = spans.values.to_numpy() if spans.is_valid else none, again[edge[i]:edge[i + 1]]
                    if s is None or not len(spans) + len(own):
                        rows.append((s, 0, 0))
                        rows_once.append((s, 0, 0))
                        continue
                    every = np.concatenate([spans, own])
                    spans = every if within else spans
                    a, z = int(t.first[i]), int(t.first[i + 1])
                    begin = t.units[t.first_unit[i]:t.first_unit[i + 1]] - a
                    tokens = [w for w in t.split[i].as_py() if w and w != _LINE]
                    for out, some, least in ((rows, spans[(spans & 0xFFFFFFFF) >= TOKENS], min_passage), (rows_once, every, 0))[:1 + once]:
                        left, gone = _remove(s, tokens, _covered(some, z - a), least)
                        out.append((left, int(gone[begin].sum()), int(gone.sum())))
                texts, cut, words = zip(*rows)
                columns = [pa.array(texts, pa.string()), pa.array(total.astype(np.int64)), pa.array(cut, pa.int64()), pa.array(words, pa.int64())]
                if once:
                    texts, cut, _ = zip(*rows_once)
                    columns += [pa.array(texts, pa.string()), pa.array(cut, pa.int64())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], names=["_extra", "doc_id", "text", *new])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema.fields[:2])
    types = {"text_once": "string"}
    out = joined.mapInArrow(apply, f"{schema}, text string, " + ", ".join(f"{c} {types.get(c, 'long')}" for c in new))
    back = [F.col("doc_id").alias(doc_id) if c == doc_id else F.col("text").alias(text) if c == text
            else F.col("_extra").getField(c).alias(c) for c in docs.columns if c not in new]
    return out.select(*back, *new)


def op9_sentence_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the sentences that an earlier document holds, in runs
    of TOKENS tokens (text), and without any that a run repeats (text_once)."""
    return dedup_sentences(table(spark, sf_dir, "documents").select("doc_id", "text"), once=True).select(
        "doc_id", "text", "n_sentences", "n_removed", "removed_words", F.length("text").cast("long").alias("n_chars_left"),
        "text_once", "n_repeated")
