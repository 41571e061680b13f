"""Best-fit packing of token sequences (operator 4).

Texts are tokenized inside tasks; a long document is cut into pieces of
``max_tokens`` and every other document stays one piece.  Only small rows
(where a piece lies, its length) are then dealt by hash over partitions, and
each partition is packed online by bounded-space best fit: the open bins are
kept in a bitset keyed by free space, a piece goes to the open bin with the
least room that still holds it, and when more than ``open_bins`` are open the
fullest closes first.

How texts are tokenized: no rule of the tokenizer reaches over ASCII white
space, so a text's ids are those of its words in order.  Each Python worker
keeps a bounded table word -> ids, filled by the tokenizer itself.
"""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingkit.llm.common import table
from listingkit.llm.textarrays import release, slices

MAX_TOKENS, END_ID, OPEN_BINS = 4096, 1, 2048
#: Words whose ids a Python worker remembers, in each of two generations.
REMEMBERED = 100_000
#: Words that it keeps from one task to the next.
KEPT = 50_000
#: Bytes of text that a worker takes at once.
SLICE = 4 << 20

#: Words of these characters (no apostrophe) are cut by the tokenizer into runs
#: of letters, single digits and runs of the rest.
PLAIN = re.compile("[!-&(-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
CUT = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")
LETTERS = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")


class WordIds(dict):
    """Lower-case word -> its ids as little-endian 32-bit integers.

    Bounded: a full table becomes the old generation, from which words in use
    come back."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.old: dict[str, bytes] = {}
        size = self.tokenizer.get_vocab_size()
        self.ends = np.zeros(size, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            if PLAIN.fullmatch(word) and "<|" not in word and (parts := CUT.findall(word.lower())) != [word]:
                ids = b"".join([self[p] for p in parts])
            else:
                ids = self._ids(word).tobytes()
        if len(word) <= 64:
            self[word] = ids
        return ids

    def learn(self, words: list[str]) -> None:
        """Looks up the letter runs of new words in one call: each ends with its
        only end-of-word token."""
        if len(self) > REMEMBERED:
            self.old = dict(self)
            self.clear()
        new = " ".join([w for w in words if w not in self and w not in self.old]).lower()
        new = [t for t in set(LETTERS.findall(new)) if t not in self and t not in self.old]
        if not new:
            return
        ids = self._ids(" ".join(new))
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) == len(new):
            raw, at = ids.tobytes(), 0
            for t, stop in zip(new, (4 * stops).tolist()):
                self[t] = raw[at:stop]
                at = stop

    def rest(self) -> None:
        """Between tasks a worker keeps few words: those that came again."""
        known = itertools.islice(((w, i) for w, i in self.items() if w in self.old or len(w) < 6), KEPT)
        known = dict(known)
        self.old = {}
        self.clear()
        self.update(known)

    def encode(self, texts: pa.Array) -> list[bytes]:
        """All ids of each text, four little-endian bytes each."""
        split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        self.learn(words)
        known = [self[w] if w else b"" for w in words]
        pool = np.frombuffer(b"".join(known), "<u4")
        length = np.fromiter(map(len, known), np.int32, len(known)) // 4
        start = np.cumsum(length, dtype=np.int32) - length
        code = coded.indices.to_numpy()
        stop = np.concatenate([[0], np.cumsum(length[code])])    # of each word, in ids
        place = np.repeat(start[code] - stop[:-1].astype(np.int32), length[code])
        place += np.arange(stop[-1], dtype=np.int32)
        ids = pool[place].tobytes()
        edge = (4 * stop[split.offsets.to_numpy() - split.offsets[0].as_py()]).tolist()
        return [ids[a:b] for a, b in zip(edge, edge[1:])]


_TABLES: dict[str, WordIds] = {}


def encode(texts: pa.Array, path: str) -> list[bytes]:
    """All ids of each text, by this worker's table."""
    if path not in _TABLES:
        _TABLES[path] = WordIds(path)
    return _TABLES[path].encode(texts)


def _vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def tokenize_pieces(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", doc_id: str = "doc_id",
                    text: str = "text", max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece (from 0), start, length, ids (binary).

    A null or blank text is just the end id.  Whole texts are read; rows may
    repeat and ids may be null.  ``vocabulary`` names a public tokenizer file,
    or is a path."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    size, end = 4 * max_tokens, end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = vocabulary if os.sep in vocabulary else _vocabulary(vocabulary)
        for b in batches:
            id_type = b.schema.field(0).type
            for part in slices(b, 1, SLICE):
                of, piece, start, ids = [], [], [], []
                for i, whole in enumerate(encode(part.column(1), path)):
                    whole += end
                    for k, s in enumerate(range(0, len(whole), size)):
                        of.append(i)
                        piece.append(k)
                        start.append(s // 4)
                        ids.append(whole[s:s + size])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(of, pa.int32())).cast(id_type), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array(ids, pa.binary())], names=["doc_id", "piece", "start", "length", "ids"])
        if path in _TABLES:
            _TABLES[path].rest()
            release()

    return rows.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids binary")


class OpenBins:
    """Bins by free space; ``bits`` has bit f set while a bin with f free is open."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.bits, self.count, self.made = 0, 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        found = self.by_free[free].pop()
        if not self.by_free[free]:
            self.bits &= ~(1 << free)
        self.count -= 1
        return found

    def put(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece of that length."""
        room = self.bits >> length
        if room:
            free = length + (room & -room).bit_length() - 1
            box = self._take(free)
        else:
            free, box = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            self.by_free[left].append(box)
            self.bits |= 1 << left
            self.count += 1
            if self.count > self.limit:                  # the fullest closes
                self._take((self.bits & -self.bits).bit_length() - 1)
        return box, self.capacity - free


def pack(pieces: DataFrame, length: str = "length", max_tokens: int = MAX_TOKENS,
         open_bins: int = OPEN_BINS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` (gapless from 0) to rows with a length.

    Columns of these two names are replaced.  ``length`` must be 1..max_tokens.  Rows are dealt by a hash of all their
    columns and packed by descending length, ties by that hash.  An empty
    table stays empty."""
    pieces = pieces.drop("sequence_id", "offset")
    names, schema = pieces.columns, pieces.schema
    at = names.index(length)
    order = F.xxhash64(*names)
    dealt = (pieces.withColumn("_order", order).repartition("_order")
             .sortWithinPartitions(F.col(length).desc(), "_order", *names).drop("_order"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, first = OpenBins(max_tokens, open_bins), TaskContext.get().partitionId() << 40
        for b in batches:
            spots = [bins.put(n) for n in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([first + s for s, _ in spots], pa.int64()),
                 pa.array([o for _, o in spots], pa.int64())], names=[*names, "sequence_id", "offset"])

    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return dealt.mapInArrow(place, f"{out}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, **options) -> DataFrame:
    """Pieces of all documents with their ids' CRC-32, packed."""
    pieces = tokenize_pieces(docs, **options)
    small = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(small)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"))
