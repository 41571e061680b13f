"""Hidden Markov language model (operator 7).

Latent states emit words.  Baum-Welch runs as a Spark job: every task adds up
the expected counts of its documents by a scaled forward and backward
recursion, the counts are summed by word across all tasks, and the new
parameters go back out.  A text's score is the scaled forward recursion's exact
likelihood.

The vocabulary has no bound, what is broadcast has one: the most frequent words
have emissions of their own (a fixed number of words of bounded length); all
others share one emission, RARE, times the word's share of the rare mass, which
follows from its exact count.  The counts of a fixed number of words are
broadcast, those of the rest come by a join.  So every word has a probability,
and all training documents count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingkit.llm.common import cut, fold_held_out, most_frequent, table
from listingkit.llm.textarrays import coded_words, slices

#: Latent states, Baum-Welch rounds, words with emissions of their own, and the
#: length of the longest of these (in characters).
STATES, ROUNDS, WORDS, LONGEST = 8, 3, 65_000, 64
#: Words whose counts are broadcast (the first WORDS of them emit on their own).
COUNTED = 300_000
#: Probability with which a state of the first model stays.
STAY = 0.9
#: Pseudo-counts of transitions and emissions.
ADD_MOVE, ADD_WORD = 1.0, 0.1
#: The end of a text, as a token; no word holds a line feed.
END = "\n"
SEED = 11


@dataclass
class Hmm:
    """start (K), move (K, K), emit (V + 2, K): columns are distributions over
    the known words, then RARE, then END."""
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def first_model(weights: np.ndarray, states: int, seed: int = SEED) -> Hmm:
    """Unigram emissions, each state's disturbed at random, and states that stay:
    what a state then learns first is a kind of text, such as a language."""
    rng = np.random.default_rng(seed)
    emit = (weights[:, None] + ADD_WORD) * rng.uniform(0.5, 1.5, (len(weights), states))
    move = np.full((states, states), (1 - STAY) / max(1, states - 1))
    np.fill_diagonal(move, STAY if states > 1 else 1.0)
    return Hmm(np.full(states, 1 / states), move, emit / emit.sum(0))


def _grids(code: np.ndarray, first: np.ndarray, cells: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Texts of similar length side by side: (texts, lengths, tokens by step)."""
    n = np.diff(first)
    order = np.argsort(-n, kind="stable")
    at = 0
    while at < len(order):
        width = max(1, min(len(order) - at, cells // max(1, int(n[order[at]]))))
        own = order[at:at + width]
        size = n[own]
        grid = np.full((int(size[0]), width), -1, np.int64)
        step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        grid[step, np.repeat(np.arange(width), size)] = code[np.repeat(first[own], size) + step]
        yield own, size, grid
        at += width


def _live(size: np.ndarray, steps: int) -> np.ndarray:
    """How many of the texts (longest first) reach each step."""
    return np.searchsorted(-size, -np.arange(steps), side="left")


def log10_likelihood(model: Hmm, code: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Exact log10 probability of every text, by the scaled forward recursion."""
    out = np.zeros(len(first) - 1)
    for own, size, grid in _grids(code, first):
        live = _live(size, len(grid))
        total = np.zeros(len(own))
        a = model.start * model.emit[grid[0]]
        for t in range(len(grid)):
            k = live[t]
            if t:
                a = (a[:k] @ model.move) * model.emit[grid[t, :k]]
            scale = a.sum(1)
            total[:k] += np.log10(scale)
            a = a / scale[:, None]
        out[own] = total
    return out


def expected_counts(model: Hmm, code: np.ndarray, first: np.ndarray):
    """(start, move, emit) expected counts over the texts, by forward-backward."""
    states = len(model.start)
    start, move = np.zeros(states), np.zeros((states, states))
    emit = np.zeros_like(model.emit)
    p_start, p_move, p_emit = (x.astype(np.float32) for x in (model.start, model.move, model.emit))
    for own, size, grid in _grids(code, first):
        live = _live(size, len(grid))
        forward, emitted = [], []
        a = None
        for t in range(len(grid)):
            k = live[t]
            e = p_emit[grid[t, :k]]
            a = p_start * e if a is None else (a[:k] @ p_move) * e
            scale = 1 / a.sum(1, keepdims=True)
            a *= scale
            e *= scale
            forward.append(a)
            emitted.append(e)
        b = np.ones((live[-1], states), np.float32)
        for t in range(len(grid) - 1, -1, -1):
            k = live[t]
            if len(b) < k:
                b = np.concatenate([b, np.ones((k - len(b), states), np.float32)])
            e = emitted[t] * b
            forward[t] = forward[t] * b                 # posteriors of the states
            if t:
                move += model.move * (forward[t - 1][:k].T @ e)
                b = e @ p_move.T
            else:
                start += forward[t].sum(0)
        flat = np.concatenate(forward)
        words = np.concatenate([grid[t, :live[t]] for t in range(len(grid))])
        order = np.argsort(words, kind="stable")
        words = words[order]
        cuts = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
        emit[words[cuts]] += np.add.reduceat(flat[order], cuts, axis=0, dtype=float)
    return start, move, emit


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n, trained): occurrences in all rows, and in those to learn from
    (``learn``).  Includes END.  Summed per slice and task before the shuffle."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, 0):
                code, first, words = coded_words(part.column(0))
                learn = np.array(part.column(1).to_pylist(), bool)
                n = np.bincount(code, minlength=len(words))
                trained = np.bincount(code[np.repeat(learn, np.diff(first))], minlength=len(words))
                used = np.flatnonzero(n).tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([words[i] for i in used] + [END], pa.string()),
                     pa.array([*n[used].tolist(), len(learn)], pa.int64()),
                     pa.array([*trained[used].tolist(), int(learn.sum())], pa.int64())], names=["word", "n", "trained"])
    counted = docs.select("text", "learn").mapInArrow(count, "word string, n long, trained long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"), F.sum("trained").alias("trained"))


class Vocabulary:
    """The most frequent words with their counts in training; the first ``own``
    have codes of their own, RARE and END follow.

    The driver holds and sends the words as an Arrow array; ``at`` is made in the
    tasks alone."""

    def __init__(self, words: pa.Array, trained: np.ndarray, own: int):
        self.words = words
        self.trained = trained
        self.rare = min(own, len(words))
        self.end = self.rare + 1

    @cached_property
    def at(self) -> dict[str, int]:
        return {w: i for i, w in enumerate(self.words.to_pylist())}

    def place(self, words: list[str]) -> np.ndarray:
        """Rank of each word; the number of counted words where unknown."""
        return np.array([self.at.get(w, len(self.at)) for w in words], np.int64)


def _by_count(rows: DataFrame) -> pa.Table:
    """(word, trained) of bounded rows, most trained first, then by word; collected
    as an Arrow table, as a row object for each would take the driver's memory."""
    return rows.select("word", "trained").toArrow().sort_by([("trained", "descending"), ("word", "ascending")])


def _with_ends(values: np.ndarray, first: np.ndarray, end) -> tuple[np.ndarray, np.ndarray]:
    """A value after each text's values, and where each text now begins."""
    n = len(first) - 1
    whole = np.full(len(values) + n, end, values.dtype)
    whole[np.arange(len(values)) + np.repeat(np.arange(n), np.diff(first))] = values
    return whole, first + np.arange(n + 1)


def _codes(raw: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Codes of texts packed as 16-bit integers, and where each text begins."""
    code = np.frombuffer(b"".join(raw.to_pylist()), "<u2").astype(np.int64)
    return code, np.concatenate([[0], np.cumsum(pc.binary_length(raw).to_numpy().astype(np.int64) // 2)])


def train(encoded: DataFrame, weights: np.ndarray, states: int = STATES, rounds: int = ROUNDS) -> Hmm:
    """Baum-Welch over all rows of ``encoded`` (codes, as 16-bit integers)."""
    model = first_model(weights, states)
    spark = encoded.sparkSession
    names = [f"s{k}" for k in range(states)]
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = None
            for b in batches:
                for part in slices(b, 0, 6 << 20):
                    got = expected_counts(shared.value, *_codes(part.column(0)))
                    sums = got if sums is None else tuple(x + y for x, y in zip(sums, got))
            if sums is not None:
                start, move, emit = sums
                used = np.flatnonzero(emit.any(1))
                row = np.concatenate([used, [-1], -2 - np.arange(states)])
                values = np.concatenate([emit[used], start[None], move])
                yield pa.RecordBatch.from_arrays([pa.array(row), *(pa.array(c) for c in values.T)], names=["row", *names])

        sums = (encoded.select("codes").mapInArrow(expect, "row long, " + ", ".join(f"{n} double" for n in names))
                .groupBy("row").agg(*(F.sum(n).alias(n) for n in names)))
        start, move = np.zeros(states) + ADD_MOVE, np.zeros((states, states)) + ADD_MOVE
        emit = np.zeros((len(weights), states)) + ADD_WORD
        got = sums.toArrow()                            # at most WORDS + states + 3 rows
        row, value = got["row"].to_numpy(), np.stack([got[n].to_numpy() for n in names], 1)
        emit[row[row >= 0]] += value[row >= 0]
        start += value[row == -1].sum(0)
        move[-2 - row[row < -1]] += value[row < -1]
        model = Hmm(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))
        shared.destroy()
        del got, row, value, sums
    return model


def _encoded(rows: DataFrame, vocabulary, floor: float, spread: float, ends: int) -> DataFrame:
    """Per text: its codes, what the counted words give, and its other words
    (joined by spaces, repeats kept)."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary.value
        c = np.concatenate([vocab.trained, [0]])
        base, share, known = np.log10((c + 1) / floor), np.log10((c + 1) / spread), c > 0
        base[-1] = share[-1] = 0                        # the rest comes by the join
        share[:vocab.rare] = 0
        end_base = np.log10((ends + 1) / floor)
        for b in batches:
            for part in slices(b, 1, 8 << 20):
                code, first, words = coded_words(part.column(1))
                place = vocab.place(words)[code] if len(code) else code
                codes, at = _with_ends(np.minimum(place, vocab.rare).astype("<u2"), first, vocab.end)
                add = lambda v: np.diff(np.concatenate([[0], np.cumsum(v)])[first])
                odd = np.flatnonzero(place == len(vocab.at))
                cuts = np.searchsorted(odd, first).tolist()
                other = [words[i] for i in code[odd].tolist()]
                raw, at = codes.tobytes(), (2 * at).tolist()
                sums = [[float(v[i:j].sum()) for i, j in zip(first[:-1].tolist(), first[1:].tolist())]
                        for v in (base[place], share[place])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(np.diff(first) + 1),
                     pa.array(add(known[place].astype(np.int64)) + (1 if ends else 0)),
                     pa.array(np.array(sums[0]) + end_base), pa.array(sums[1], pa.float64()),
                     pa.array([raw[i:j] for i, j in zip(at, at[1:])], pa.binary()),
                     pa.array([" ".join(other[i:j]) for i, j in zip(cuts, cuts[1:])], pa.string())],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "base", "share", "codes", "other"])

    return rows.select("doc_id", "text", "held_out").mapInArrow(
        encode, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, share double, "
                "codes binary, other string").withColumn("row", F.monotonically_increasing_id())


def score_texts(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS, own: int = WORDS,
                counted: int = COUNTED) -> DataFrame:
    """Scores of rows (doc_id, text, held_out), learned from the rows not held out:
    doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Null and empty texts are their END alone.  Repeated rows keep a row each.
    If all rows are held out the counts are 0 and emissions near uniform; an
    empty table gives no rows."""
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), "held_out")
    counts = cut(word_counts(rows.withColumn("learn", ~F.col("held_out"))))
    total = counts.agg(F.coalesce(F.sum("trained"), F.lit(0)).alias("n"),
                       F.count(F.when(F.col("trained") > 0, 1)).alias("v"),
                       F.coalesce(F.sum(F.when(F.col("word") == END, F.col("trained"))), F.lit(0)).alias("ends")).first()
    tokens, distinct, ends = int(total.n), int(total.v), int(total.ends)
    # the training rows alone say which words emit; words frequent in all rows have their
    # counts broadcast besides, which saves a join and changes no score
    short = counts.where((F.col("word") != END) & (F.length("word") <= LONGEST))
    emitting = _by_count(most_frequent(short.where("trained > 0"), "trained", own))
    more = _by_count(most_frequent(short, "n", counted))
    more = more.filter(pc.invert(pc.is_in(more["word"], emitting["word"].combine_chunks())))
    listed = pa.concat_tables([emitting, more]).combine_chunks()
    vocab = Vocabulary(listed["word"].combine_chunks(), listed["trained"].to_numpy().astype(np.int64), emitting.num_rows)
    del emitting, more, listed
    emits = vocab.trained[:vocab.rare]
    rare_tokens = tokens - ends - int(emits.sum())
    rare_distinct = distinct - int((emits > 0).sum()) - (1 if ends else 0)
    floor = float(tokens + distinct + 1)
    spread = float(rare_tokens + rare_distinct + 1)     # the rare mass, with one part for the unseen
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(vocab)
    encoded = cut(_encoded(rows, vocabulary, floor, spread, ends))
    vocabulary.unpersist()
    weights = np.concatenate([emits, [rare_tokens, ends]]).astype(float)
    model = spark.sparkContext.broadcast(train(encoded.where(~F.col("held_out")), weights, states, rounds))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, 0, 6 << 20):
                likely = log10_likelihood(model.value, *_codes(part.column(0)))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(likely)],
                                                 names=[*part.schema.names[1:], "likely"])

    small = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "share"]
    kinds = {f.name: f.dataType.simpleString() for f in encoded.schema}
    scored = encoded.select("codes", *small).mapInArrow(
        score, ", ".join(f"{c} {kinds[c]}" for c in small) + ", likely double")
    other = encoded.where("other <> ''").select("row", F.explode(F.split("other", " ")).alias("word"))
    c = F.coalesce("trained", F.lit(0))
    other = (other.join(counts.select("word", "trained"), "word", "left").groupBy("row").agg(
        F.sum((c > 0).cast("long")).alias("more_known"), F.sum(F.log10(c + 1)).alias("more"), F.count("*").alias("times")))
    out, none = scored.join(other, "row", "left"), F.lit(0)
    more, times = F.coalesce("more", F.lit(0.0)), F.coalesce("times", none)
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", none)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more - times * float(np.log10(floor))).alias("base_score"),
        (F.col("likely") + F.col("share") + more - times * float(np.log10(spread))).alias("score"))


def op7_hmm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, scored by the model learned from six sevenths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_texts(docs.withColumn("held_out", fold_held_out(F.col("doc_id"), 7, 2)))
