"""Centroid clustering with Ptolemaic pivots (operator 13).

Lloyd's rounds on integer vectors, exact to the last digit.  Every vector
keeps its distances to fixed pivots, the centroids of a few early rounds; for a
pair of pivots p, s Ptolemy's inequality bounds its distance to a centroid c
from below,

    d(v, c) >= |d(v, p) d(c, s) - d(v, s) d(c, p)| / d(p, s),

from cached distances and those of the centroids alone.  A centroid uses the
pivot next to it with the pivots farthest from that one: the nearer it is, the
closer the bound.  Bounds are lowered by
more than rounding can have raised them; centroids whose bound passes the best
exact distance found are left out, all others are compared exactly.

A round's tasks send counts and exact sums for each centroid, never rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingkit.llm.common import table, written

SCALE, DIMS, CLUSTERS, ROUNDS = 1024, 64, 8, 10
#: Rounds whose centroids become the pivots; pairs a centroid's bound takes.
PIVOT_ROUNDS, PAIRS = (0, 2, 5), 2
#: Vectors a task compares at a time.
BLOCK = 8192
#: Entries stay under this magnitude, so that squared distances are longs.
LARGEST = 1 << 27
#: Relative error that a bound is lowered by; rounding stays far below.
MARGIN = 1e-9


def integer_vectors(vectors: DataFrame, scale: int = SCALE, dims: int = DIMS, vec_id: str = "vec_id",
                    embedding: str = "embedding") -> DataFrame:
    """(vec_id, x): rows whose vector has exactly ``dims`` components, none null or
    non-finite, as ``floor(scale * component)``.  Vectors with an integer of
    2^27 or more take no part.  Repeated rows and null ids stay."""
    v = F.transform(F.col(embedding), lambda c: c.cast("double"))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * scale < float(LARGEST) - 1))
    rows = rows.where((F.size("v") == dims) & fine)
    return rows.select("vec_id", F.transform("v", lambda c: F.floor(c * scale).cast("int")).alias("x"))


def starting_vectors(rows: DataFrame, clusters: int, seed: str) -> list[list[int]]:
    """The vectors with the smallest sha256 of ``seed:vec_id``, in that order;
    of rows that share an id those with smaller vectors first, null ids last."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return [list(r.x) for r in rows.orderBy(key.asc_nulls_last(), "x").limit(clusters).collect()]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to one vector."""
    off = x - c
    return np.einsum("ij,ij->i", off, off)


def with_pivots(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Adds ``p``: the distance to every pivot, computed once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column(1))
            d = np.sqrt(np.stack([_squares(x, c) for c in pivots], 1).astype(float)) if len(x) else np.zeros((0, len(pivots)))
            flat = pa.FixedSizeListArray.from_arrays(pa.array(d.ravel()), len(pivots)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*b.columns, flat], names=["vec_id", "x", "p"])
    return rows.mapInArrow(run, "vec_id long, x array<int>, p array<double>")


class Assigner:
    """Nearest centroid (ties: the smaller number) by bounds and exact checks."""

    def __init__(self, centroids: list[list[int]], pivots: np.ndarray):
        self.c = np.array(centroids, np.int64)
        cp = np.sqrt(np.stack([_squares(self.c, p) for p in pivots], 1).astype(float))
        between = np.sqrt(np.stack([_squares(pivots, p) for p in pivots], 1).astype(float))
        self.pairs = []                      # centroid, pivots a and b, its distances to them, theirs
        for c in range(len(self.c)):
            a = int(cp[c].argmin())
            for b in np.argsort(-between[a], kind="stable")[:PAIRS].tolist():
                if between[a, b] > 0:
                    self.pairs.append((c, a, b, cp[c, a], cp[c, b], between[a, b]))

    def bounds(self, p: np.ndarray) -> np.ndarray:
        """Squared lower bounds (rows, centroids), never above the true value."""
        low = np.zeros((len(self.c), len(p)))
        for c, a, b, ca, cb, d in self.pairs:
            left, right = p[:, a] * cb, p[:, b] * ca
            np.maximum(low[c], (np.abs(left - right) - MARGIN * (left + right)) / d, out=low[c])
        return (low * low * (1 - MARGIN)).T

    def assign(self, x: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(cluster, squared distance, exact comparisons)."""
        low = self.bounds(p)
        best = np.full(len(x), np.iinfo(np.int64).max)
        own = np.zeros(len(x), np.int64)
        done = np.zeros(low.shape, bool)
        checked = 0
        # the most promising centroid first, then the survivors in order
        first = low.argmin(1)
        for phase in (0, 1):
            for c in range(len(self.c)):
                rows = np.flatnonzero(first == c) if not phase else np.flatnonzero(~done[:, c] & (low[:, c] <= best))
                if not len(rows):
                    continue
                d = _squares(x[rows], self.c[c])
                done[rows, c] = True
                checked += len(rows)
                closer = (d < best[rows]) | ((d == best[rows]) & (c < own[rows]))
                best[rows[closer]], own[rows[closer]] = d[closer], c
        return own, best, checked


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, BLOCK):
            yield b.slice(at, BLOCK)


def _round(rows: DataFrame, centroids: list[list[int]], pivots: np.ndarray) -> list[list[int]]:
    """Centroids after one assignment: floor of the exact means."""
    k, dims = len(centroids), len(centroids[0])
    assigner = Assigner(centroids, pivots)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for b in _blocks(batches):
            x = _matrix(b.column(0))
            own, _, _ = assigner.assign(x, np.stack(b.column(1).to_numpy(zero_copy_only=False)))
            for c in range(k):
                mine = own == c
                n[c] += mine.sum()
                total[c] += x[mine].sum(0)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, dims).astype(np.int32)), pa.array(np.tile(np.arange(dims, dtype=np.int32), len(used))),
             pa.array(np.repeat(n[used], dims)), pa.array(total[used].ravel())], names=["c", "at", "n", "s"])
    sums = rows.select("x", "p").mapInArrow(add, "c int, at int, n long, s long").groupBy("c", "at").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(30,0)")).alias("s"))
    out = [list(c) for c in centroids]
    for r in sums.collect():                                                  # clusters x dims rows
        out[r.c][r["at"]] = int(r.s) // r.n
    return out


SCHEMA = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, dims: int = DIMS,
            seed: str = "3", vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia and
    centroid_sha256 of every vector kept (see ``integer_vectors``).

    With fewer vectors than clusters there are fewer clusters; clusters that
    lose all vectors keep their centroid.  An empty table gives no rows.  Equal
    vectors may start several clusters; the smaller number then wins."""
    spark = vectors.sparkSession
    rows = written(integer_vectors(vectors, scale, dims, vec_id, embedding), "vectors")
    centroids = starting_vectors(rows, clusters, seed)
    if not centroids:
        return spark.createDataFrame([], SCHEMA)
    plain, pivots = rows, np.zeros((0, dims), np.int64)
    for k in range(rounds + 1):
        if k in PIVOT_ROUNDS:
            pivots = np.unique(np.array(centroids, np.int64), axis=0)
            rows = written(with_pivots(plain, pivots), "pivots")
        if k < rounds:
            centroids = _round(rows, centroids, pivots)
    assigner = Assigner(centroids, pivots)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches):
            own, d, _ = assigner.assign(_matrix(b.column(1)), np.stack(b.column(2).to_numpy(zero_copy_only=False)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(own.astype(np.int32)), pa.array(d)],
                                             names=["vec_id", "cluster", "distance"])
    out = written(rows.mapInArrow(last, "vec_id long, cluster int, distance long"), "clusters")
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    sums = {r.cluster: int(r.s) for r in out.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}              # one a cluster
    facts = spark.createDataFrame([(c, s, sum(sums.values()), sha[c]) for c, s in sums.items()],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight clusters of all embeddings."""
    return cluster(table(spark, sf_dir, "embeddings"))


def _oracle() -> str:
    """The rounds as one chain of tables, every distance computed."""
    steps = [f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, x FROM (
    SELECT vec_id, list_transform(embedding, lambda c: CAST(floor({SCALE} * CAST(c AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings WHERE len(embedding) = {DIMS}
      AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = {DIMS})),
e AS MATERIALIZED (
  SELECT row, CAST(unnest(range(1, {DIMS + 1})) AS INTEGER) AS d, unnest(x) AS x FROM v),
c0 AS MATERIALIZED (
  SELECT k, CAST(unnest(range(1, {DIMS + 1})) AS INTEGER) AS d, unnest(x) AS x FROM (
    SELECT row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR)), x) - 1 AS k, x FROM v)
  WHERE k < {CLUSTERS})"""]
    for i in range(ROUNDS + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT row, k, s FROM (
    SELECT row, k, s, row_number() OVER (PARTITION BY row ORDER BY s, k) AS place FROM (
      SELECT e.row, c{i}.k, CAST(sum((e.x - c{i}.x) * (e.x - c{i}.x)) AS BIGINT) AS s
      FROM e JOIN c{i} USING (d) GROUP BY e.row, c{i}.k)) WHERE place = 1)""")
        if i < ROUNDS:
            steps.append(f"""m{i} AS MATERIALIZED (
  SELECT a{i}.k, e.d, CAST(sum(e.x) AS BIGINT) AS s, count(*) AS n FROM a{i} JOIN e USING (row) GROUP BY a{i}.k, e.d),
c{i + 1} AS MATERIALIZED (
  SELECT c.k, c.d, CASE WHEN m.n IS NULL THEN c.x
    ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS x
  FROM c{i} c LEFT JOIN m{i} m ON c.k = m.k AND c.d = m.d)""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT v.vec_id, CAST(a.k AS INTEGER) AS cluster, a.s AS distance,
  CAST(sum(a.s) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.s) OVER () AS BIGINT) AS inertia, h.sha AS centroid_sha256
FROM a{ROUNDS} a JOIN v USING (row)
JOIN (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS sha FROM c{ROUNDS} GROUP BY k) h ON h.k = a.k"""


OP13_SQL = _oracle()
