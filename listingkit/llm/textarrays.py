"""Words and shingles of Arrow text columns as numpy arrays (inside tasks)."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc


try:
    _TRIM = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError):                      # not glibc: its allocator gives back by itself
    _TRIM = None


def release() -> None:
    """Gives freed memory back to the system: workers live on from task to task
    and stage to stage, and others need the room."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def slices(batch: pa.RecordBatch, column: int, size: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that each part holds about ``size`` bytes of that column."""
    width = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(width.astype(np.int64)) // size
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)
            pa.default_memory_pool().release_unused()
    release()


def coded_words(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(code of each word, first word of each text plus the end, distinct words).

    Words are runs of characters other than ASCII white space; null is empty."""
    texts = pc.fill_null(texts, "")
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    coded = split.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    first = split.offsets.to_numpy().astype(np.int64)
    first -= first[0]
    if "" in words:                                # the split leaves empty strings at the ends
        real = code != words.index("")
        first = np.concatenate([[0], np.cumsum(real)])[first]
        code = code[real]
    return code, first, words


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit of a 64-bit integer over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_words(words: list[str]) -> np.ndarray:
    return pd.util.hash_array(np.array(words, dtype=object), categorize=False) if words else np.zeros(0, np.uint64)


def shingle_sets(texts: pa.Array, width: int = 5) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles of each text.

    A text with fewer words has one shingle, all its words; none without words."""
    code, first, words = coded_words(texts)
    h = hash_words(words)[code] if len(code) else np.zeros(0, np.uint64)
    rolled = h[:max(0, len(h) - width + 1)].copy()
    for k in range(1, width):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + h[k:len(rolled) + k]
    rolled = mix64(rolled)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(rolled[a:b - width + 1]))
        elif b > a:
            one = np.array([b - a], np.uint64)
            for k in range(a, b):
                one = one * np.uint64(0x9E3779B97F4A7C15) + h[k]
            out.append(mix64(one))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
