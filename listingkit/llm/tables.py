"""Tables of fixed size that all tasks fill together: counts and bits by hash.

Their size does not follow the data, so they may be sent to every task.  A
table that fills up only lets more rows pass; no wanted row is ever missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Bits of the table of wanted values; parts in which a table travels.
WANTED_CELLS, STRIPES = 1 << 25, 64


def stripes(cells: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(stripe, raw) rows of a task's table, without its empty parts."""
    parts = np.split(cells, STRIPES)
    used = [i for i, p in enumerate(parts) if p.any()]
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()),
                                      pa.array([parts[i].tobytes() for i in used], pa.binary())],
                                     names=["stripe", "raw"])


def add_stripes(rows: DataFrame, cells: int, kind: str, combine) -> np.ndarray:
    """Combines the (stripe, raw) rows of all tasks."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for i, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                part = np.frombuffer(raw, kind)
                sums[i] = combine(sums[i], part) if i in sums else part.copy()
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()),
                                              pa.array([x.tobytes() for x in sums.values()], pa.binary())],
                                             names=["stripe", "raw"])
    out = np.zeros(cells, kind)
    width = cells // STRIPES
    for r in rows.repartition("stripe").mapInArrow(fold, "stripe int, raw binary").collect():
        out[r.stripe * width:(r.stripe + 1) * width] = np.frombuffer(r.raw, kind)
    return out


def _places(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    cell = values.to_numpy().view(np.uint64) % np.uint64(WANTED_CELLS)
    return (cell >> np.uint64(3)).astype(np.int64), (cell & np.uint64(7)).astype(np.uint8)


def wanted_bits(values: DataFrame) -> np.ndarray:
    """The table with a bit for each value of the (only, long) column."""
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(WANTED_CELLS // 8, np.uint8)
        for b in batches:
            byte, bit = _places(b.column(0))
            np.bitwise_or.at(bits, byte, np.uint8(1) << bit)
        yield from stripes(bits)
    return add_stripes(values.mapInArrow(mark, "stripe int, raw binary"), WANTED_CELLS // 8, "|u1", np.bitwise_or)


def maybe_wanted(values: pa.Array, bits: np.ndarray) -> np.ndarray:
    """Whether each value may be wanted."""
    byte, bit = _places(values)
    return (bits[byte] >> bit & 1).astype(bool)


def keep_wanted(rows: DataFrame, bits: np.ndarray) -> DataFrame:
    """The rows whose first (long) column may be wanted."""
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(maybe_wanted(b.column(0), shared.value)))
    return rows.mapInArrow(keep, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema))
