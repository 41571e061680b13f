"""Whitening of embeddings by a bidiagonal qd solver (operator 11).

Blocks of centred rows are reduced to triangles by QR where they lie, and
triangles to one by levels of QR.  On the last triangle, whose size is the
number of dimensions: Householder reflections make it bidiagonal, the dqds
transform finds its singular values to high relative accuracy, and a twisted
factorisation for each gives its right singular vector.  No covariance matrix
is formed on the way, so small singular values keep their digits.

Rows enter as integers ``floor(scale * component)``; the fit counts every
distinct integer vector once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingkit.llm.common import table, written

SCALE, COMPONENTS = 256, 4
#: Rows of a block of the QR; triangles one task of a level reduces.
BLOCK, FAN_IN = 4096, 32
#: Greatest magnitude of an integer entry (beyond it doubles hold no integers).
LARGEST = 1 << 53
EPS = float(np.finfo(float).eps)
TINY = float(np.finfo(float).tiny)


# ---------------------------------------------------------------- rows

def integer_vectors(vectors: DataFrame, scale: int = SCALE, vec_id: str = "vec_id",
                    embedding: str = "embedding") -> DataFrame:
    """(vec_id, x): every row whose vector is not null and holds neither null nor
    non-finite entries, as ``floor(scale * entry)``.

    Empty vectors, vectors of another length than most (ties: the longer) and
    vectors with an entry beyond 2^53 take no part.  Repeated rows all stay;
    a null id stays null."""
    v = F.transform(F.col(embedding), lambda c: c.cast("double"))
    rows = vectors.select(F.col(vec_id).alias("vec_id"), v.alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float(LARGEST) / scale))
    rows = rows.where((F.size("v") > 0) & fine)
    usual = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("c")).agg(
        F.max_by("d", F.struct("c", "d")).alias("d"))                         # one row
    x = F.transform("v", lambda c: F.floor(c * scale).cast("long"))
    return rows.join(F.broadcast(usual), F.size("v") == F.col("d")).select("vec_id", x.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    """(rows, dims) integers of a list column without nulls."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def fit_sums(distinct: DataFrame) -> tuple[int, list[int]]:
    """Rows and exact sums of each dimension; only sums leave the tasks."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, None
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(0))
                # high and low halves cannot overflow in a batch
                part = [(int(h) << 26) + int(w) for h, w in zip((x >> 26).sum(0), (x & ((1 << 26) - 1)).sum(0))]
                sums = part if sums is None else [a + c for a, c in zip(sums, part)]
                n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(sums)), pa.int32()), pa.array([n] * len(sums), pa.int64()),
                 pa.array([Decimal(s) for s in sums], pa.decimal128(30, 0))], names=["at", "n", "s"])
    parts = distinct.select("x").mapInArrow(add, "at int, n long, s decimal(30,0)")
    rows = parts.groupBy("at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("at").collect()   # one a dimension
    return (rows[0].n, [int(r.s) for r in rows]) if rows else (0, [])


def _mean(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Whole and fractional part of each mean, so that centring loses nothing."""
    return (np.array([s // n for s in sums], np.int64), np.array([(s % n) / n for s in sums]))


def _centred(x: np.ndarray, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
    return (x - whole).astype(float) - rest


# ---------------------------------------------------------------- blockwise QR

def _triangle(stack: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.concatenate(stack), mode="r")


def _one(r: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    if r is not None:
        yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(r).tobytes()], pa.binary())], names=["r"])


def triangle_of(distinct: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The triangle R of the centred rows' QR.

    A task folds its blocks into one triangle; levels of FAN_IN triangles a
    task follow until one is left.  What reaches the driver is one matrix of
    dims x dims."""
    whole, rest = _mean(n, sums)
    dims = len(sums)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                x = _centred(_matrix(b.column(0).slice(at, BLOCK)), whole, rest)
                r = _triangle([x] if r is None else [r, x])
        yield from _one(r)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for b in batches:
            for raw in b.column(0).to_pylist():
                part = np.frombuffer(raw).reshape(-1, dims)
                r = part if r is None else _triangle([r, part])
        yield from _one(r)

    rows = written(distinct.select("x").mapInArrow(blocks, "r binary"), "triangles")
    left = rows.count()
    while left > 1:
        left = -(-left // FAN_IN)
        rows = rows.repartition(left).mapInArrow(merge, "r binary")
    last = np.frombuffer(rows.collect()[0].r).reshape(-1, dims)               # one row
    square = np.zeros((dims, dims))
    square[:len(last)] = last
    return square


# ---------------------------------------------------------------- bidiagonal qd

def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, W): R = U B W' by Householder reflections from
    both sides; U is not kept."""
    a = np.array(r, float)
    n = len(a)
    w = np.eye(n)

    def reflector(v: np.ndarray) -> np.ndarray | None:
        """Unit vector u with (I - 2uu')v along the first axis; null if v is there already."""
        size = np.abs(v).max(initial=0.0)
        if size == 0 or not v[1:].any():
            return None
        u = v / size
        u[0] += np.copysign(np.linalg.norm(u), u[0])
        return u / np.linalg.norm(u)

    for k in range(n):
        u = reflector(a[k:, k].copy())
        if u is not None:
            a[k:, k:] -= 2 * np.outer(u, u @ a[k:, k:])
        if k + 1 < n:
            u = reflector(a[k, k + 1:].copy())
            if u is not None:
                a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ u, u)
                w[:, k + 1:] -= 2 * np.outer(w[:, k + 1:] @ u, u)
    return np.diag(a).copy(), np.diag(a, 1).copy(), w


def _qd_step(q: list[float], e: list[float], shift: float):
    """One dqds transform (q, e, pivots); None where a pivot is not positive."""
    nq, ne, pivots, d = [], [], [], q[0] - shift
    for nxt, off in zip(q[1:], e):
        if not d > 0:
            return None
        pivots.append(d)
        nq.append(d + off)
        t = nxt / nq[-1]
        ne.append(off * t)
        d = d * t - shift
    if d < 0 or (d == 0 and not shift):
        return None
    pivots.append(d)
    nq.append(d)
    return nq, ne, pivots


def qd_values(q: list[float], e: list[float]) -> list[float]:
    """Eigenvalues of B'B, falling, from the squared diagonal ``q`` and squared
    superdiagonal ``e`` of a bidiagonal B, by dqds.

    The shift is Newton's step for the characteristic polynomial, one over the
    sum of the reciprocal pivots: it never passes the smallest eigenvalue, so
    pivots stay positive (but for rounding, where a smaller shift is taken).  A
    negligible ``e`` splits the problem.  Zeros count as a value below rounding."""
    least = max([*q, *e, 0.0]) * EPS ** 3 + TINY
    alike = (10 * EPS) ** 2
    out: list[float] = []
    todo = [([max(x, least) for x in q], list(e), 0.0)]
    while todo:
        q, e, moved = todo.pop()
        shift = 0.0
        while len(q) > 1:
            cut = next((i for i, off in enumerate(e) if off <= alike * (moved + min(q[i], q[i + 1]))), None)
            if cut is not None:
                todo.append((q[:cut + 1], e[:cut], moved))
                q, e, shift = q[cut + 1:], e[cut + 1:], 0.0
                continue
            step = _qd_step(q, e, shift)
            if step is None:
                if not shift:                      # a pivot under the smallest number
                    q = [max(x, least) for x in q]
                shift = shift / 4 if shift > EPS * moved else 0.0
                continue
            q, e, pivots = step
            moved += shift
            shift = (1 - 8 * EPS * len(q)) / sum(1 / max(p, TINY) for p in pivots)
        out.extend(moved + x for x in q)
    return sorted(out, reverse=True)


@dataclass
class _Twisted:
    """N D N' = L diag(d) L' - value: downwards to row r, upwards from the end."""
    down: np.ndarray
    up: np.ndarray
    pivots: np.ndarray
    r: int

    def solve(self, f: np.ndarray) -> np.ndarray:
        y, r, m = f.copy(), self.r, len(f)
        for i in range(r):
            y[i + 1] -= self.down[i] * y[i]
        for i in range(m - 2, r - 1, -1):
            y[i] -= self.up[i] * y[i + 1]
        return self.back(y / self.pivots)

    def back(self, y: np.ndarray) -> np.ndarray:
        """Solution of N' z = y."""
        z = y.copy()
        for i in range(self.r - 1, -1, -1):
            z[i] -= self.down[i] * z[i + 1]
        for i in range(self.r, len(z) - 1):
            z[i + 1] -= self.up[i] * z[i]
        return z


def _safe(x: float, least: float) -> float:
    return x if abs(x) > least else np.copysign(least, x)


def twisted(d: np.ndarray, low: np.ndarray, value: float) -> _Twisted:
    """Twisted factorisation at the row with the smallest pivot."""
    m, least = len(d), EPS * EPS * float(np.abs(d).max()) + TINY
    down, up = np.zeros(m), np.zeros(m)
    dn, dp, s, p = np.zeros(m), np.zeros(m), np.zeros(m), np.zeros(m)
    s[0], p[-1] = -value, d[-1] - value
    for i in range(m - 1):
        dp[i] = _safe(s[i] + d[i], least)
        down[i] = d[i] * low[i] / dp[i]
        s[i + 1] = down[i] * low[i] * s[i] - value
    for i in range(m - 2, -1, -1):
        dn[i + 1] = _safe(d[i] * low[i] * low[i] + p[i + 1], least)
        t = d[i] / dn[i + 1]
        up[i] = low[i] * t
        p[i] = p[i + 1] * t - value
    gamma = s + p + value
    r = int(np.argmin(np.abs(gamma)))
    pivots = np.concatenate([dp[:r], [_safe(gamma[r], least)], dn[r + 1:]])
    return _Twisted(down, up, pivots, r)


def singular_vectors(a: np.ndarray, b: np.ndarray, values: list[float], close: float = 1e-3) -> np.ndarray:
    """Right singular vectors (columns) of the bidiagonal matrix for the first
    eigenvalues of B'B.

    Values within ``close`` of each other, relatively, are separated by inverse
    iteration with the same factors, orthogonal to those before."""
    m = len(a)
    least = np.sqrt(float(np.abs(np.concatenate([a, b])).max()) ** 2 * EPS ** 3 + TINY)
    a = np.where(np.abs(a) > least, a, least)
    d, low = a * a, b / a[:-1]
    rng = np.random.default_rng(1)
    out: list[np.ndarray] = []
    for k, value in enumerate(values):
        near = [out[i] for i in range(k) if abs(values[i] - value) <= close * value]
        factors = twisted(d, low, value)
        z = factors.back(np.eye(m)[factors.r])
        z /= np.linalg.norm(z)
        for turn in range(4 if near else 0):
            for v in near + near:
                z = z - (v @ z) * v
            if np.linalg.norm(z) < 0.01:
                z = rng.normal(size=m)
                for v in near + near:
                    z = z - (v @ z) * v
            z = factors.solve(z / np.linalg.norm(z))
            z /= np.linalg.norm(z)
        for v in near + near:
            z = z - (v @ z) * v
        out.append(z / np.linalg.norm(z))
    return np.array(out).T.reshape(m, -1)


# ---------------------------------------------------------------- model and operator

@dataclass
class Whitening:
    """What whitening needs: mean (n, exact sums), unit directions in columns,
    eigenvalues of the covariance, their shares of its trace, and the measured
    distance of the whitened covariance from the identity."""
    n: int
    sums: list[int]
    directions: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float = float("nan")

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, *_mean(self.n, self.sums)) @ (self.directions / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - sum)^2, exactly."""
        most, top, d = int(np.abs(x).max(initial=0)), max(abs(s) for s in self.sums), x.shape[1]
        if d * most * max(most, top) < 1 << 62:
            s = np.array(self.sums, np.int64) if top < 1 << 62 else np.array(self.sums, object)
        else:
            x, s = x.astype(object), np.array(self.sums, object)
        own = sum(v * v for v in self.sums)
        return [self.n * (self.n * int(p) - 2 * int(c)) + own for p, c in zip((x * x).sum(1), x @ s)]


def solve(r: np.ndarray, n: int, components: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(directions, eigenvalues, shares) of the covariance R'R / n, largest first.

    Eigenvalues that are zero to rounding have no whitening direction."""
    a, b, w = bidiagonal(r)
    values = qd_values((a * a).tolist(), (b * b).tolist())
    rank = sum(v > values[0] * (len(a) * EPS) ** 2 for v in values) if values[0] > len(a) * TINY else 0
    kept = values[:min(components, rank)]
    directions = w @ singular_vectors(a, b, kept) if kept else np.zeros((len(a), 0))
    sign = np.sign(directions[np.abs(directions).argmax(0), range(len(kept))]) if kept else 1
    return directions * sign, np.array(kept) / n, np.array(kept) / (sum(values) or 1.0)


def fit_whitening(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fits the distinct vectors ``x``; None without rows."""
    distinct = written(rows.select("x").distinct(), "whitening")
    n, sums = fit_sums(distinct)
    if not n:
        return None
    model = Whitening(n, sums, *solve(triangle_of(distinct, n, sums), n, components))
    k = len(model.values)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for b in batches:
            if b.num_rows:
                y = model.whitened(_matrix(b.column(0)))
                total += np.concatenate([y.sum(0)[None], y.T @ y])
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], names=["at", "s"])
    if k:
        sums_ = distinct.select("x").mapInArrow(products, "at int, s double").groupBy("at").agg(F.sum("s").alias("s"))
        total = np.zeros((k + 1) * k)
        for r in sums_.collect():                                             # (k + 1) * k rows
            total[r["at"]] = r.s
        total = total.reshape(k + 1, k) / n
        model.identity_error = float(np.abs(total[1:] - np.outer(total[0], total[0]) - np.eye(k)).max())
    return model


SCHEMA = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
          "explained double, identity_error double")


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE,
           vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained,
    identity_error: a row for each vector that takes part (see
    ``integer_vectors``) and each of the first components.

    Components whose eigenvalue is zero have no rows, so vectors that are all
    equal, and an empty table, give none.  Other columns of the input are not
    read, whatever their names."""
    rows = integer_vectors(vectors, scale, vec_id, embedding).withColumn("vec_id", F.col("vec_id").cast("long"))
    model = fit_whitening(rows, components)
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], SCHEMA)
    shared = rows.sparkSession.sparkContext.broadcast(model)                  # dims x components

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        k = len(m.values)
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                part = b.slice(at, BLOCK)
                x = _matrix(part.column(1))
                rep = np.repeat(np.arange(len(x)), k)
                deviation = pa.array([Decimal(v) for v in m.deviations(x)], pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rep)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                     pa.array(np.full(len(rep), m.n)), deviation.take(pa.array(rep)), pa.array(m.whitened(x).ravel()),
                     pa.array(np.tile(m.explained, len(x))), pa.array(np.full(len(rep), m.identity_error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return rows.mapInArrow(apply, SCHEMA)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 4 whitened components of every embedding.  A deviation beyond
    a long is null (the operator has it as a decimal)."""
    out = whiten(table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.col("deviation").try_cast("long"))
