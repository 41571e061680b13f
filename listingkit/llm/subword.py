"""Quality classifier by supervised subword embeddings (operator 12).

A document is the mean of learned vectors of its words, word pairs and the
character n-grams inside its words (word ends count as characters); a pair
also counts by its form, whether its words are the same.  PRIOR empty features
are counted in, so that a few words alone decide little.  A softmax layer turns the mean into label probabilities.  Vectors live in a table of
hashed buckets and are trained with the layer by stochastic gradient descent.

Training reads a bounded sample of labelled documents (``sample`` of each
label, by hash of the id), in a fixed number of parts: every round each part
goes through its documents from the same model in a task of its own, and the models are
averaged.  Scoring reads every whole text; because mean and layer are linear,
it needs only the layer's output for every bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingkit.llm.common import fold_held_out, table, written
from listingkit.llm.textarrays import mix64, slices

#: Labelled documents of each label that are learned from, at most.
SAMPLE = 4_000
#: Buckets of the hash table (a power of two), dimensions, lengths of character n-grams.
BUCKETS, DIMS, GRAMS = 1 << 16, 12, (3, 4, 5)
#: Parts that train side by side, rounds, first step size, seed of the start.
PARTS, ROUNDS, RATE, SEED = 4, 5, 1.0, 12
#: Steps of a part in a round, at least: small samples are gone through again.
STEPS = 1_000
#: Code points of a long text that are taken at a time (and the rest of a word).
PIECE = 1 << 18
#: Empty features every document has.
PRIOR = 60
THRESHOLD = 0.3
_P = np.uint64(0x9E3779B97F4A7C15)


def _space(codes: np.ndarray) -> np.ndarray:
    """ASCII white space: blank, and 9 to 13 (smaller codes wrap around)."""
    return (codes == 0x20) | (codes - np.uint32(9) <= 4)


def _bucket(x: np.ndarray, salt: int, shift: np.uint64) -> np.ndarray:
    """The upper bits of a multiplicative hash."""
    return ((x ^ (x >> np.uint64(29))) + np.uint64(salt)) * np.uint64(0xBF58476D1CE4E5B9) >> shift


# ---------------------------------------------------------------- features

def _pieces(codes: np.ndarray) -> Iterator[np.ndarray]:
    """Stretches of about PIECE code points, cut at white space only."""
    at = 0
    while at < len(codes):
        end = at + PIECE
        while end < len(codes):
            spaces = np.flatnonzero(_space(codes[end:end + PIECE]))
            if len(spaces):
                end += int(spaces[0])
                break
            end += PIECE
        yield codes[at:end]
        at = end


def buckets_of(text: str | None, buckets: int = BUCKETS) -> Iterator[np.ndarray]:
    """Bucket numbers of all features of a whole text, a piece at a time.

    Words end at ASCII white space.  Null and blank texts have none."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)
    shift, last = np.uint64(65 - buckets.bit_length()), None
    for piece in _pieces(codes):
        space = _space(piece)
        # one space before, between and after words
        keep = ~space | np.concatenate([[False], ~space[:-1]])
        c = piece[keep].astype(np.uint64)
        space = space[keep]
        if not len(c) or space.all():
            continue
        c = np.concatenate([[0x20], np.where(space, 0x20, c), [] if space[-1] else [0x20]]).astype(np.uint64)
        space = c == 0x20
        ends = np.flatnonzero(space)
        # words: polynomial of the characters, each by its place in the word
        start, stop = ends[:-1] + 1, ends[1:]
        powers = np.concatenate([[np.uint64(1)], np.full(int((stop - start).max()), _P)]).cumprod(dtype=np.uint64)
        place = np.arange(len(c)) - np.repeat(ends, np.diff(np.append(ends, len(c))))
        words = np.add.reduceat(np.where(space, np.uint64(0), c * powers[place]), start)
        out = [_bucket(words, 0, shift)]
        chain = words if last is None else np.concatenate([[last], words])
        out.append(_bucket(chain[:-1] * _P + chain[1:], 1, shift))
        out.append(_bucket((chain[:-1] == chain[1:]).astype(np.uint64), 2, shift))
        last = words[-1]
        rolled, inner = c, np.zeros(len(c), bool)
        for n in range(2, max(GRAMS) + 1):
            size = len(c) - n + 1
            if size <= 0:
                break
            if n > 2:
                inner = inner[:size] | space[n - 2:n - 2 + size]
            else:
                inner = inner[:size]
            rolled = rolled[:size] * _P + c[n - 1:n - 1 + size]
            if n in GRAMS:
                out.append(_bucket(rolled[~inner], n, shift))
        yield np.concatenate(out).astype(np.int64)


def sparse_features(text: str | None, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, their shares of all features and PRIOR more) of a whole text."""
    total: np.ndarray | None = None
    one: list[np.ndarray] = []
    for ids in buckets_of(text, buckets):
        one.append(ids)
        if len(one) > 1 or total is not None:          # long texts: counts of the table's size
            total = np.zeros(buckets) if total is None else total
            for x in one:
                total += np.bincount(x, minlength=buckets)
            one = []
    if total is not None:
        ids = np.flatnonzero(total)
        return ids, total[ids] / (total.sum() + PRIOR)
    if not one:
        return np.zeros(0, np.int64), np.zeros(0)
    ids, n = np.unique(one[0], return_counts=True)
    return ids, n / (n.sum() + PRIOR)


# ---------------------------------------------------------------- model

@dataclass
class Subword:
    """vectors: (buckets, dims); layer: (dims, labels); bias: (labels,)."""
    vectors: np.ndarray
    layer: np.ndarray
    bias: np.ndarray

    @classmethod
    def start(cls, labels: int = 2, buckets: int = BUCKETS, dims: int = DIMS, seed: int = SEED) -> Subword:
        rng = np.random.default_rng(seed)
        return cls(rng.uniform(-1 / dims, 1 / dims, (buckets, dims)).astype(np.float32),
                   rng.normal(0, 0.1, (dims, labels)).astype(np.float32), np.zeros(labels, np.float32))

    def train(self, examples: list[tuple[np.ndarray, np.ndarray, int]], rates: np.ndarray) -> None:
        """One pass of stochastic gradient descent, in the order given."""
        for (ids, share, label), rate in zip(examples, rates):
            share = share.astype(np.float32)
            hidden = share @ self.vectors[ids]
            off = _softmax(hidden @ self.layer + self.bias)
            off[label] -= 1
            back = self.layer @ off
            self.layer -= rate * np.outer(hidden, off)
            self.bias -= rate * off
            # shares are small, so the vectors take larger steps
            self.vectors[ids] -= rate * np.outer(share / max(float(share @ share), 1e-6) ** 0.5, back)

    def outputs(self) -> np.ndarray:
        """What every bucket adds to the outputs: (buckets, labels)."""
        return (self.vectors.astype(float) @ self.layer.astype(float))

    def raw(self) -> bytes:
        return b"".join(np.ascontiguousarray(x, np.float32).tobytes() for x in (self.vectors, self.layer, self.bias))

    def from_flat(self, flat: np.ndarray) -> Subword:
        a, b = self.vectors.size, self.layer.size
        return Subword(flat[:a].reshape(self.vectors.shape), flat[a:a + b].reshape(self.layer.shape), flat[a + b:])


def _softmax(x: np.ndarray) -> np.ndarray:
    y = np.exp(x - x.max(-1, keepdims=True))
    return y / y.sum(-1, keepdims=True)


# ---------------------------------------------------------------- learning

def _sampled(labels: DataFrame, sample: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, label) of ``sample`` documents of each label at most, by hash of
    the id, and how many of each there are.  Of several labels of one id the
    smallest counts; null ids and labels count as none."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull()).groupBy("doc_id").agg(
        F.min("label").alias("label"))
    sizes = {r.label: r.c for r in rows.groupBy("label").agg(F.count("*").alias("c")).collect()}   # one a label
    parts = [rows.where(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for v in sorted(sizes)]
    out = rows.limit(0)
    for part in parts:
        out = out.unionByName(part)
    return out, sizes


@dataclass
class Classifier:
    """outputs: (labels, buckets); offset: bias and the labels' true shares."""
    labels: list[int]
    outputs: np.ndarray
    offset: np.ndarray

    def scores(self, text: str | None) -> np.ndarray:
        """Probabilities of the labels for a whole text."""
        total, n = np.zeros(len(self.labels)), PRIOR
        for ids in buckets_of(text, self.outputs.shape[1]):
            total += [out.take(ids).sum() for out in self.outputs]
            n += len(ids)
        return _softmax(total / n + self.offset)


def learn_classifier(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, rounds: int = ROUNDS,
                     parts: int = PARTS) -> Classifier:
    """Learns the labels (doc_id, label: integers) of documents (doc_id, text).

    Of documents that share an id the smallest text is read.  Without labelled
    documents the two labels 0 and 1 are equally likely; with one label alone
    it is certain."""
    spark = docs.sparkSession
    chosen, sizes = _sampled(labels, sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")              # 2 * sample ids at most
    rows = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select(
        F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(parts)).cast("int").alias("part"),
        F.xxhash64("doc_id").alias("key"), "label", "text")
    rows = written(rows, "quality-sample")
    drawn = {r.label: r.c for r in rows.groupBy("label").agg(F.count("*").alias("c")).collect()}
    kinds = sorted(drawn)
    if len(kinds) < 2:
        known = kinds if kinds else [0, 1]
        return Classifier(known, np.zeros((len(known), 1)), np.zeros(len(known)))
    model = Subword.start(len(kinds))

    def epoch(shared, turn):
        def run(group: pa.Table) -> pa.Table:
            key = group.column("key").to_numpy().astype(np.int64).view(np.uint64)
            m = Subword.start(len(kinds)).from_flat(np.frombuffer(shared.value, np.float32).copy())
            n = len(key)
            passes = -(-STEPS // n)
            order = np.concatenate([np.argsort(mix64(key + np.uint64(turn * passes + i))) for i in range(passes)])
            rates = RATE * (1 - (turn + np.arange(len(order)) / len(order)) / rounds)
            texts, y = group.column("text"), group.column("label").to_pylist()
            known: dict[int, tuple] = {}
            for i, rate in zip(order.tolist(), rates):
                x = known.get(i) or sparse_features(texts[i].as_py())
                if passes > 1:
                    known[i] = x
                m.train([(*x, kinds.index(y[i]))], [rate])
            return pa.table({"n": pa.array([n], pa.int64()), "raw": pa.array([m.raw()], pa.binary())})
        return run

    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(model.raw())
        total, n = 0.0, 0
        for r in rows.groupBy("part").applyInArrow(epoch(shared, turn), "n long, raw binary").collect():   # a model a part
            total, n = total + r.n * np.frombuffer(r.raw, np.float32).astype(float), n + r.n
        model = model.from_flat((total / n).astype(np.float32))
        shared.unpersist()
    # the sample holds labels in other shares than the data
    odds = np.array([np.log(sizes[k] / drawn[k]) for k in kinds])
    return Classifier(kinds, np.ascontiguousarray(model.outputs().T), model.bias.astype(float) + odds - odds.max())


def classify(docs: DataFrame, model: Classifier, label: int = 1, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default doc_id) and ``score``, the probability of
    ``label`` (0 if it was never learned), for each row; one pass, no shuffle.

    Null, empty and blank texts get the score of no features."""
    keep = keep or ["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(model)                  # buckets x labels
    at = model.labels.index(label) if label in model.labels else None
    rows = docs.select(F.struct(*keep).alias("row"), F.col("text").alias("read"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, 1):
                s = [0.0 if at is None else float(shared.value.scores(t.as_py())[at]) for t in b.column(1)]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], names=["row", "score"])
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, score double").select("row.*", "score")


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learned from four fifths of the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = learn_classifier(docs, labels.where(~fold_held_out(F.col("doc_id"), 5, 0)))
    return classify(docs, model).select(
        "doc_id", fold_held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
