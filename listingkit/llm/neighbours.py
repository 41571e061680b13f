"""Approximate nearest neighbours on shifted space-filling curves (operator 5).

Vectors are projected to a few dimensions, several times over, with random
directions and a random shift each; a Hilbert curve through every projection
puts all rows in order, by range partitions.  A query looks at the blocks of
rows next to its own place on every curve; what it finds is merged and ranked
by the exact distance of the original vectors.

How many blocks it looks at is measured: for a bounded sample of queries the
true neighbours are found by a scan of all rows, and the window is the
smallest that holds ``recall`` of them on at least one curve.  Clustered
vectors need short windows; for vectors without structure no ordering helps
and windows grow until the recall is met.

Equal vectors count as one point that carries its smallest ids, so copies
neither fill windows nor tie arbitrarily.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listingkit.llm.common import cut, table

CURVES, DIMS, BITS, SEED = 8, 3, 20, 7
#: Rows of a block; queries the window is measured on, at most; recall asked for.
BLOCK, SAMPLE, RECALL = 512, 100, 0.97


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of integer points (rows, dims) on the Hilbert curve through a grid of
    2^bits cells a side: the coordinates' bits are turned and mirrored level by
    level, then interleaved."""
    x = list(cells.T.astype(np.int64))
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(dims):
            mirror = (x[i] & bit) != 0
            swap = np.where(mirror, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(mirror, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap
    for i in range(1, dims):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn = np.where((x[-1] & (1 << level)) != 0, turn ^ ((1 << level) - 1), turn)
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | ((x[i] ^ turn) >> level & 1)
    return key


def _matrix(column: pa.Array, kind: str = "<f4") -> np.ndarray:
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), kind).astype(float).reshape(len(raw), -1) if raw else np.zeros((0, 1))


def valid_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per id: vec_id, vec.  Rows with a null id, and vectors null,
    empty, zero, or holding null or non-finite components take no part; nor do
    those of another length than most.  Of rows with equal id the smallest
    vector counts."""
    v = F.col(embedding)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(vec_id).alias("vec_id"), v.alias("vec")).where(F.col("vec_id").isNotNull() & fine)
    rows = rows.groupBy("vec_id").agg(F.min("vec").alias("vec"))
    usual = rows.groupBy(F.size("vec").alias("n")).agg(F.count("*").alias("c")).agg(F.max_by("n", F.struct("c", "n")).alias("n"))
    return rows.join(F.broadcast(usual), F.size("vec") == F.col("n")).drop("n")


def _points(rows: DataFrame, k: int) -> DataFrame:
    """(id, ids, raw): distinct vectors with their k + 1 smallest ids."""
    small = rows.withColumn("at", F.row_number().over(W.partitionBy("vec").orderBy("vec_id"))).where(F.col("at") <= k + 1)
    return small.groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).select(
        F.col("ids")[0].alias("id"), "ids", "vec")


def _as_bytes(points: DataFrame) -> DataFrame:
    """Vectors as packed bytes of their own type, which move and stack quickly."""
    wide = points.schema["vec"].dataType.elementType.simpleString() != "float"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column(2)
            flat = v.flatten().to_numpy(zero_copy_only=False).astype("<f8" if wide else "<f4")
            at = (v.offsets.to_numpy() - v.offsets[0].as_py()) * flat.itemsize
            raw = flat.tobytes()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(
                [raw[x:y] for x, y in zip(at.tolist(), at[1:].tolist())], pa.binary())], names=["id", "ids", "raw"])
    return points.withColumn("id", F.col("id").cast("long")).withColumn("ids", F.col("ids").cast("array<long>")).mapInArrow(
        pack, "id long, ids array<long>, raw binary")


def _moments(points: DataFrame, kind: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, mean and covariance, summed up in the tasks."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, one, two = 0, 0, 0
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(0), kind)
                n, one, two = n + len(x), one + x.sum(0), two + x.T @ x
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([one.tobytes()]), pa.array([two.tobytes()])],
                                             names=["n", "one", "two"])
    n, one, two = 0, 0, 0
    for r in points.select("raw").coalesce(64).mapInArrow(add, "n long, one binary, two binary").toLocalIterator():
        d = len(r.one) // 8
        n, one, two = n + r.n, one + np.frombuffer(r.one), two + np.frombuffer(r.two).reshape(d, d)
    if not n:
        return 0, np.zeros(1), np.eye(1)
    return n, one / n, two / n - np.outer(one / n, one / n)


def _curve_keys(points: DataFrame, mean: np.ndarray, cov: np.ndarray, kind: str) -> DataFrame:
    """(curve, key, id, ids, raw): every point on every curve."""
    rng = np.random.default_rng(SEED)
    axes = rng.normal(size=(CURVES, len(mean), DIMS))
    shift = rng.random((CURVES, DIMS))
    scale = np.sqrt(np.maximum(np.einsum("cdk,de,cek->ck", axes, cov, axes), 1e-300))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column(2), kind) - mean
            for c in range(CURVES):
                even = 1 / (1 + np.exp(-np.clip(1.7 * (x @ axes[c]) / scale[c], -40, 40)))   # about uniform
                cell = np.minimum((even + shift[c]) / 2 * (1 << BITS), (1 << BITS) - 1).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), c, np.int32)), pa.array(hilbert_key(cell, BITS)), *b.columns],
                    names=["curve", "key", "id", "ids", "raw"])
    return points.mapInArrow(place, "curve int, key long, id long, ids array<long>, raw binary")


def _ranked(keyed: DataFrame) -> DataFrame:
    """Adds ``block``: the row's place on its curve, in blocks of BLOCK rows.

    Range partitions are sorted and numbered inside; the counts of the
    partitions before (a row each) make the numbers global."""
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), np.zeros(CURVES, np.int64)
        for b in batches:
            curve = b.column(0).to_numpy()
            pos = np.empty(len(curve), np.int64)
            for c in np.unique(curve):
                own = curve == c
                pos[own] = at[c] + np.arange(own.sum())
                at[c] += own.sum()
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(curve), part, np.int32)), pa.array(pos), *b.columns],
                                             names=["part", "pos", "curve", "key", "id", "ids", "raw"])
    dealt = keyed.repartitionByRange("curve", "key", "id").sortWithinPartitions("curve", "key", "id")
    rows = cut(dealt.mapInArrow(number, "part int, pos long, curve int, key long, id long, ids array<long>, raw binary"))
    counts = rows.groupBy("part", "curve").agg(F.count("*").alias("n"))
    before = W.partitionBy("curve").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return rows.join(counts, ["part", "curve"]).select(
        "curve", F.floor((F.col("pos") + F.col("before")) / BLOCK).alias("block"), "id", "ids", "raw")


def _window(ranked: DataFrame, queries: DataFrame, k: int, kind: str, sample: int, recall: float) -> int:
    """Blocks to either side that hold ``recall`` of the sample's true neighbours."""
    chosen = queries.orderBy(F.xxhash64("id"), "id").limit(sample).select("id", "raw").collect()
    if not chosen:
        return 1
    ids = np.array([r.id for r in chosen])
    x = np.stack([np.frombuffer(r.raw, kind) for r in chosen]).astype(float)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                own, y = b.column(0).to_numpy(), _matrix(b.column(1), kind)
                d = (x * x).sum(1)[:, None] - 2 * x @ y.T + (y * y).sum(1)[None]
                d[ids[:, None] == own[None]] = np.inf
                best = np.argsort(d, axis=1)[:, :k]
                q = np.repeat(ids, best.shape[1])
                d = np.take_along_axis(d, best, 1).ravel()
                ok = np.isfinite(d)
                yield pa.RecordBatch.from_arrays([pa.array(q[ok]), pa.array(own[best.ravel()][ok]), pa.array(d[ok])],
                                                 names=["q", "id", "d"])
    near = ranked.where("curve = 0").select("id", "raw").mapInArrow(scan, "q long, id long, d double")
    near = near.withColumn("at", F.row_number().over(W.partitionBy("q").orderBy("d", "id"))).where(F.col("at") <= k)
    pairs = [(r.q, r.id) for r in near.collect()]            # at most sample * k
    need = {i for p in pairs for i in p}
    if not pairs:
        return 1
    small = F.broadcast(ranked.sparkSession.createDataFrame([(int(i),) for i in need], "id long"))
    place: dict[int, dict[int, int]] = {}
    for r in ranked.join(small, "id").select("id", "curve", "block").collect():
        place.setdefault(r.id, {})[r.curve] = r.block
    apart = sorted(min(abs(place[q][c] - place[i][c]) for c in place[q]) for q, i in pairs)
    return max(1, apart[min(len(apart) - 1, int(np.ceil(recall * len(apart))) - 1)])


def _visit(queries: DataFrame, ranked: DataFrame, window: int, k: int, kind: str) -> DataFrame:
    """(query_id, vec_id, score) of the k best of every block a query looks at."""
    def best(asked: list, block: list) -> pa.RecordBatch:
        x = np.frombuffer(b"".join(r[2] for r in asked), kind).astype(float).reshape(len(asked), -1)
        y = np.frombuffer(b"".join(r[2] for r in block), kind).astype(float).reshape(len(block), -1)
        out = []
        step = max(1, (1 << 22) // y.size)
        for at in range(0, len(asked), step):
            d = np.sqrt(((x[at:at + step, None] - y[None]) ** 2).sum(2))
            last = np.partition(d, min(k, d.shape[1] - 1), axis=1)[:, min(k, d.shape[1] - 1)]
            for i in range(len(d)):
                own = asked[at + i][0]
                found = sorted((d[i, j], v) for j in np.flatnonzero(d[i] <= last[i]) for v in block[j][1] if v != own)
                out.extend((own, v, s) for s, v in found[:k])
        q, v, s = zip(*out) if out else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float64())],
                                          names=["query_id", "vec_id", "score"])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, asked, block = None, [], []
        for b in batches:
            for curve, part, asks, *row in zip(*(c.to_pylist() for c in b.columns)):
                if (curve, part) != at:
                    if asked and block:
                        yield best(asked, block)
                    at, asked, block = (curve, part), [], []
                (asked if asks else block).append(row)
        if asked and block:
            yield best(asked, block)

    last = ranked.groupBy("curve").agg(F.max("block").alias("last"))
    own = queries.select(F.col("id").alias("query_id"), "point")
    asks = (ranked.join(own.withColumnRenamed("point", "id"), "id").join(F.broadcast(last), "curve")
            .select("curve", F.explode(F.sequence(F.greatest(F.lit(0), F.col("block") - window),
                                                  F.least("last", F.col("block") + window))).alias("block"),
                    F.lit(True).alias("asks"), F.col("query_id").alias("id"),
                    F.array().cast("array<long>").alias("ids"), "raw"))
    rows = asks.unionByName(ranked.withColumn("asks", F.lit(False)))
    rows = rows.select("curve", "block", "asks", "id", "ids", "raw").repartition("curve", "block").sortWithinPartitions(
        "curve", "block", "asks", "id")
    return rows.mapInArrow(stream, "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, is_query, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding",
            sample: int = SAMPLE, recall: float = RECALL) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k nearest found, by
    Euclidean distance, ties to the smaller id.

    ``is_query`` is a condition on ``vec_id``.  A query's own row is no
    candidate, equal vectors of other ids are.  See ``valid_vectors`` for rows
    that take no part; an empty table gives no rows."""
    rows = cut(valid_vectors(vectors, vec_id, embedding))
    kind = "<f4" if rows.schema["vec"].dataType.elementType.simpleString() == "float" else "<f8"
    points = cut(_as_bytes(_points(rows, k)))
    n, mean, cov = _moments(points, kind)
    if not n:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    ranked = cut(_ranked(_curve_keys(points, mean, cov, kind)))
    named = rows.groupBy("vec").agg(F.min("vec_id").cast("long").alias("point"))
    queries = cut(rows.where(is_query).join(named, "vec").select(F.col("vec_id").cast("long").alias("id"), "point"))
    asked = points.join(queries.select(F.col("point").alias("id")).distinct(), "id")
    window = _window(ranked, asked, k, kind, sample, recall)
    found = _visit(queries, ranked, window, k, kind)
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest of every hundredth embedding, against all rows."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
