"""N-gram Jaccard join by signature trees (operator 8).

Links all pairs of documents whose sets of 5-word shingles have a Jaccard
similarity of at least 0.75, exactly, and returns connected components.

* Documents with equal sets form a class; only classes are joined.
* The top level of the tree deals classes into nodes.  Shingles are ordered
  rarest first (by a fixed-size table of counts over all documents, ties by
  hash); two linked classes share one of the first n - ceil(0.75 n) + 1
  shingles of each.  Classes that share such a shingle lie under one node,
  named after the smallest of them.
* Every class is compared with the head of the node it shares most with, if the
  shared shingles and then short bitmaps allow a link.  Nodes whose members these links already
  connect hold nothing new and are dropped.
* In the others a tree of OR-combined bitmaps and size ranges is built over the
  members, and a dual traversal descends only into node pairs whose greatest
  possible overlap reaches the threshold: first over short bitmaps alone, which
  leaves few members, then over these members' sets.  Large nodes are split
  into blocks of neighbouring sizes and block pairs are traversed apart.

A link inside a component that is already connected adds nothing, so the
traversal skips such pairs; no link between components is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listingkit.llm.common import cut, table, written
from listingkit.llm.components import components
from listingkit.llm.tables import add_stripes, keep_wanted, stripes, wanted_bits
from listingkit.llm.textarrays import shingle_sets, slices

WIDTH = 5
#: Similarity as a fraction of integers: 75 / 100.
PART, WHOLE = 75, 100
#: Cells of the count table (fixed size).
COUNT_CELLS = 1 << 20
#: Shingles a block may hold in one task.
BLOCK_SHINGLES = 4_000_000
#: Parts that members of a node with sets of one size are dealt to.
SIZE_PARTS = 64
#: What a member counts besides its shingles, so that blocks of short texts stay small too.
ROW_COST = 256
#: Members of a node that are compared with its head in one part.
PART_MEMBERS = 512
SLICE = 8 << 20


def _class_of(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _ref(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def _width(n: int) -> int:
    """Bits of the bitmap of n shingles."""
    return max(256, 1 << (2 * n - 1).bit_length())


def bitmap(s: np.ndarray, width: int) -> np.ndarray:
    bits = np.zeros(width // 8, np.uint8)
    cell = s % np.uint64(width)
    np.bitwise_or.at(bits, (cell >> np.uint64(3)).astype(np.int64), np.uint8(1) << (cell & np.uint64(7)).astype(np.uint8))
    return bits.view(np.uint64)


def prefix_length(n):
    return n - (PART * n + WHOLE - 1) // WHOLE + 1


def _prefixes(texts: DataFrame, counts) -> DataFrame:
    """(shingle, ref) of the first shingles of every class, rarest first."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = counts.value
        for b in batches:
            seen: set[bytes] = set()
            for part in slices(b, 0, SLICE):
                tokens, refs, sizes = [], [], []
                for s in shingle_sets(part.column(0), WIDTH):
                    if len(s) and (key := _class_of(s)) not in seen:
                        seen.add(key)
                        k = prefix_length(len(s))
                        load = weight[(s % np.uint64(COUNT_CELLS)).astype(np.int64)]
                        tokens.append(s[np.argsort(load, kind="stable")[:k]])
                        refs.append(_ref(key))
                        sizes.append(k)
                if refs:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(tokens).view(np.int64)),
                         pa.array(np.repeat(np.array(refs, np.int64), sizes))], names=["shingle", "ref"])
    return texts.mapInArrow(emit, "shingle long, ref long")


def _members(prefixes: DataFrame) -> DataFrame:
    """(head, ref, shared): classes under the node of each shared shingle, whose
    head is the smallest ref.  Rows come sorted, so nothing is gathered."""
    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = head = last = None
        for b in batches:
            t = b.column(0).to_numpy()
            r = b.column(1).to_numpy()
            if not len(t):
                continue
            fresh = np.concatenate([[token is None or t[0] != token], t[1:] != t[:-1]])
            again = ~fresh & (r == np.concatenate([[last if last is not None else 0], r[:-1]]))
            at = np.maximum.accumulate(np.where(fresh, np.arange(len(t)), -1))
            h = np.where(at >= 0, r[at], head if head is not None else 0)
            token, head, last = t[-1], h[-1], r[-1]
            use = (h != r) & ~again
            pairs, n = np.unique(np.stack([h[use], r[use]]), axis=1, return_counts=True) if use.any() else (None, None)
            if pairs is not None:
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1]), pa.array(n.astype(np.int64))],
                                                 names=["head", "ref", "shared"])
    dealt = prefixes.repartition("shingle").sortWithinPartitions("shingle", "ref")
    return (dealt.mapInArrow(heads, "head long, ref long, shared long")
            .groupBy("head", "ref").agg(F.sum("shared").alias("shared")))


def _with_texts(rows: DataFrame, whole: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Adds ``text`` to rows with the row_key that stands for their class.

    Texts travel, not sets, which are larger; a task that needs a set makes it.
    Texts that are not wanted are passed over before the join; ``keys`` may give
    the row_keys of the rows where these are long to make."""
    wanted = (rows if keys is None else keys).select("row_key").distinct()
    return rows.join(keep_wanted(whole.select("row_key", "text"), wanted_bits(wanted)), "row_key")


def _own_sets(keys: list[bytes], texts: pa.Array) -> list[np.ndarray | None]:
    """The set of each class from its text; None if the text is another's."""
    return [s if _class_of(s) == k else None for k, s in zip(keys, shingle_sets(texts, WIDTH))]


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Exact test of two sorted sets."""
    if WHOLE * min(len(a), len(b)) < PART * max(len(a), len(b)):
        return False
    common = int(np.isin(a, b, assume_unique=True).sum())
    return WHOLE * common >= PART * (len(a) + len(b) - common)


def most_common(n: int, a: bytes, m: int, b: bytes) -> int:
    """Greatest possible overlap of two sets by their sizes and bitmaps: the bits
    of both, and shingles that share a bit.  The wider bitmap is folded."""
    x, y = int.from_bytes(a, "little"), int.from_bytes(b, "little")
    w, v = 8 * len(a), 8 * len(b)
    while w > v:
        w //= 2
        x = x >> w | x & ((1 << w) - 1)
    while v > w:
        v //= 2
        y = y >> v | y & ((1 << v) - 1)
    return (x & y).bit_count() + min(n - x.bit_count(), m - y.bit_count())


def _may_link(best: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows (head, ref) whose bitmaps allow a link: few do, and only these
    need their texts."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, bits, m, head_bits = (c.to_pylist() for c in b.columns[2:])
            ok = [(WHOLE + PART) * most_common(*x) >= PART * (x[0] + x[2]) for x in zip(n, bits, m, head_bits)]
            yield b.select(["head", "ref"]).filter(pa.array(ok, pa.bool_()))
    own = classes.select("ref", "n", "bits")
    heads = classes.select(F.col("ref").alias("head"), F.col("n").alias("m"), F.col("bits").alias("head_bits"))
    both = best.join(own, "ref").join(heads, "head").select("head", "ref", "n", "bits", "m", "head_bits")
    return both.mapInArrow(keep, "head long, ref long")


def _edges(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    a, b = zip(*pairs)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def _with_heads(best: DataFrame, classes: DataFrame, whole: DataFrame) -> DataFrame:
    """Links between each class and the head of its best node, streamed: the
    head comes first and its set is the only one kept.  Members of a large node
    are dealt over several parts, each with the head."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, heads = None, {}
        for b in batches:
            for part in slices(b, 4, SLICE):
                out = []
                head, salt, own, key = (c.to_pylist() for c in part.columns[:4])
                for i, s in enumerate(_own_sets(key, part.column(4))):
                    if (head[i], salt[i]) != at:
                        at, heads = (head[i], salt[i]), {}
                    if s is None:
                        continue
                    if own[i]:
                        heads.setdefault(key[i], s)
                    out.extend((k, key[i]) for k, h in heads.items() if k != key[i] and linked(h, s))
                if out:
                    yield _edges(out)
    parts = best.groupBy("head").agg(F.ceil(F.count("*") / PART_MEMBERS).alias("parts"))
    rows = best.join(parts, "head").withColumn("salt", F.pmod(F.xxhash64("ref"), F.col("parts"))).drop("parts")
    rows = rows.unionByName(rows.select("head", F.col("head").alias("ref"), "salt").distinct())
    rows = rows.join(classes.select("ref", "class", F.col("rep.row_key").alias("row_key")), "ref")
    rows = _with_texts(rows, whole).select("head", "salt", (F.col("head") == F.col("ref")).alias("own"), "class", "text")
    return (rows.repartition("head", "salt").sortWithinPartitions("head", "salt", F.col("own").desc(), "class")
            .mapInArrow(compare, "a binary, b binary"))


class SignatureTree:
    """Bitmaps and size ranges over members; each level joins ``FAN`` neighbours."""

    FAN = 8

    def __init__(self, bits: np.ndarray, size: np.ndarray):
        hidden = size - np.bitwise_count(bits).sum(1, dtype=np.int64)   # shingles that share a bit
        self.levels = [(bits, size, size, hidden)]
        while len(self.levels[-1][0]) > self.FAN:
            b, low, high, hid = self.levels[-1]
            cuts = np.arange(0, len(b), self.FAN)
            self.levels.append((np.bitwise_or.reduceat(b, cuts), np.minimum.reduceat(low, cuts),
                                np.maximum.reduceat(high, cuts), np.maximum.reduceat(hid, cuts)))

    def candidates(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (i <= j) of members that may be linked, by dual traversal; a batch
        of node pairs is expanded depth first, so memory stays bounded."""
        top = len(self.levels[-1][0])
        i, j = np.triu_indices(top)
        stack = [(len(self.levels) - 1, i, j)]
        while stack:
            level, i, j = stack.pop()
            if len(i) > 4096:
                stack.append((level, i[4096:], j[4096:]))
                i, j = i[:4096], j[:4096]
            bits, low, high, hidden = self.levels[level]
            keep = (WHOLE * high[i] >= PART * low[j]) & (WHOLE * high[j] >= PART * low[i])
            i, j = i[keep], j[keep]
            most = np.empty(len(i), np.int64)
            step = max(1, (1 << 21) // bits.shape[1])
            for a in range(0, len(i), step):
                both = bits[i[a:a + step]] & bits[j[a:a + step]]
                most[a:a + step] = np.bitwise_count(both).sum(1, dtype=np.int64)
            most += np.minimum(hidden[i], hidden[j])
            keep = (WHOLE + PART) * most >= PART * (low[i] + low[j])
            i, j = i[keep], j[keep]
            if level == 0:
                yield i, j
            elif len(i):
                n = len(self.levels[level - 1][0])
                k = np.arange(self.FAN)
                ci = (i[:, None, None] * self.FAN + k[:, None] + 0 * k).reshape(-1)
                cj = (j[:, None, None] * self.FAN + 0 * k[:, None] + k).reshape(-1)
                ok = (ci <= cj) & (ci < n) & (cj < n)
                stack.append((level - 1, ci[ok], cj[ok]))


def join_members(keys: list[bytes], groups: list[bytes], sets: list[np.ndarray]) -> list[tuple[bytes, bytes]]:
    """Links that connect the groups (components so far) of the members."""
    order = sorted(range(len(sets)), key=lambda i: (groups[i], len(sets[i])))
    sets, keys = [sets[i] for i in order], [keys[i] for i in order]
    at = np.unique([groups[i] for i in order], return_inverse=True)[1]
    size = np.array([len(s) for s in sets], np.int64)
    width = 8 * _width(int(np.median(size)))
    out = []
    for i, j in SignatureTree(np.stack([bitmap(s, width) for s in sets]), size).candidates():
        while len(i):
            apart = at[i] != at[j]
            i, j = i[apart], j[apart]
            for k, (a, b) in enumerate(zip(i.tolist(), j.tolist())):
                if linked(sets[a], sets[b]):
                    out.append((keys[a], keys[b]))
                    at[at == at[b]] = at[a]
                    i, j = i[k + 1:], j[k + 1:]
                    break
            else:
                break
    return out


def possible_members(groups: list[bytes], sizes: list[int], raw: list[bytes]) -> np.ndarray:
    """Which members their bitmaps allow a link to a member of another group.

    A bitmap folds to half its width by OR of its halves; sets of comparable
    size have equal or neighbouring widths, so each width is traversed together
    with the next, folded."""
    at = np.unique(groups, return_inverse=True)[1]
    size, width = np.array(sizes, np.int64), np.array([8 * len(r) for r in raw])
    hit = np.zeros(len(raw), bool)
    for w in np.unique(width).tolist():
        own = np.flatnonzero((width == w) | (width == 2 * w))
        own = own[np.lexsort((size[own], at[own]))]
        bits = np.zeros((len(own), w // 64), np.uint64)
        for k, i in enumerate(own.tolist()):
            full = np.frombuffer(raw[i], np.uint64)
            bits[k] = full if len(full) == w // 64 else full[:w // 64] | full[w // 64:]
        for i, j in SignatureTree(bits, size[own]).candidates():
            i, j = own[i], own[j]
            apart = at[i] != at[j]
            hit[i[apart]] = hit[j[apart]] = True
    return hit


def _dealt(members: DataFrame) -> DataFrame:
    """(head, ref, one, two): members (head, ref, n) dealt to the block pairs
    (one, two) of their node.

    Blocks follow size and hold about BLOCK_SHINGLES; a node pair whose size
    ranges cannot reach the similarity is not made.  The running sum that cuts
    them has two levels, parts of the members of one size and the totals of the
    parts, so that no task sorts a whole node; sets and bitmaps stay out of it."""
    part = (F.col("n") * SIZE_PARTS + F.pmod(F.xxhash64("ref"), F.lit(SIZE_PARTS))).alias("part")
    small = members.select("head", "ref", "n", part).distinct()
    cost = F.sum(F.col("n") + ROW_COST)
    before = W.partitionBy("head").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    totals = small.groupBy("head", "part").agg(cost.alias("cost"))
    totals = totals.select("head", "part", F.coalesce(F.sum("cost").over(before), F.lit(0)).alias("before"))
    within = W.partitionBy("head", "part").orderBy("ref").rowsBetween(W.unboundedPreceding, 0)
    rows = small.withColumn("upto", cost.over(within)).join(totals, ["head", "part"]).select(
        "head", "ref", "n", F.floor((F.col("before") + F.col("upto")) / BLOCK_SHINGLES).alias("block"))
    rows = written(rows, "blocks")                 # read three times below
    span = rows.groupBy("head", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    two = span.select("head", F.col("block").alias("two"), F.col("low").alias("low2"))
    pairs = (span.withColumnRenamed("block", "one").join(two, "head").where("one <= two")
             .where(F.col("high") * WHOLE >= F.col("low2") * PART).select("head", "one", "two"))
    ends = pairs.select("head", "one", "two", F.explode(F.array_distinct(F.array("one", "two"))).alias("block"))
    return rows.join(ends, ["head", "block"]).select("head", "ref", "one", "two")


def _blocks(open_nodes: DataFrame, members: DataFrame) -> DataFrame:
    """Members (head, ref, ..) dealt to the block pairs (one, two) of their node;
    ``members`` has head, ref and n of the same rows."""
    return open_nodes.join(_dealt(members), ["head", "ref"])


def _by_node(dealt: DataFrame, columns: list[str], per_node, schema: str, order: str) -> DataFrame:
    """Calls ``per_node`` with head and the lists of the columns of one block pair
    (head, one, two)."""
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for b in batches:
            for *node, row in zip(*(c.to_pylist() for c in b.columns[:3]), zip(*(c.to_pylist() for c in b.columns[3:]))):
                if node != at:
                    if len(held) > 1:
                        yield from per_node(at[0], [list(c) for c in zip(*held)])
                    at, held = node, []
                held.append(row)
        if len(held) > 1:
            yield from per_node(at[0], [list(c) for c in zip(*held)])
    node = ["head", "one", "two"]
    return (dealt.select(*node, *columns).repartition(*node).sortWithinPartitions(*node, order)
            .mapInArrow(stream, schema))


def _possible(open_nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """(head, ref) of the members (head, ref, n) that may have a link to another
    component; ``classes`` has ref, n, group and bits.  Bitmaps join rows that
    are dealt already, so they travel once more only."""
    def traverse(head, columns) -> Iterator[pa.RecordBatch]:
        refs, groups, sizes, raw = columns
        hit = np.flatnonzero(possible_members(groups, sizes, raw)).tolist()
        if hit:
            yield pa.RecordBatch.from_arrays([pa.array([head] * len(hit), pa.int64()),
                                              pa.array([refs[i] for i in hit], pa.int64())], names=["head", "ref"])
    dealt = _dealt(open_nodes).join(classes.select("ref", "group", "n", "bits"), "ref")
    return _by_node(dealt, ["ref", "group", "n", "bits"], traverse, "head long, ref long", "ref").distinct()


def _inside(members: DataFrame, whole: DataFrame) -> DataFrame:
    """Links found by the trees over the sets of these members.  Texts join rows
    that are dealt already."""
    def traverse(head, columns) -> Iterator[pa.RecordBatch]:
        rows = [(k, g, s) for k, g, s in zip(columns[0], columns[1], _own_sets(columns[0], pa.array(columns[2])))
                if s is not None]
        if out := join_members(*(list(c) for c in zip(*rows))) if rows else None:
            yield _edges(out)
    dealt = _blocks(members.drop("n"), members)
    return _by_node(_with_texts(dealt, whole, members), ["class", "group", "text"], traverse,
                    "a binary, b binary", "class").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, row_key and ``first``: it is the
    row that stands for its component.

    Null, empty and blank texts have no shingles and are components of their
    own.  component_id is the smallest non-null doc_id of the component.  Equal
    rows belong together (each of them is ``first`` if one is)."""
    whole = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    whole = whole.withColumn("row_key", F.xxhash64("doc_id", "text"))
    spark = docs.sparkSession
    id_type = whole.schema["doc_id"].dataType

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per document, and the counts of the shingles of all of them."""
        cells = np.zeros(COUNT_CELLS, "<f4")
        names = ["doc_id", "row_key", "n", "class", "ref", "bits", "stripe", "raw"]
        kind = None
        for b in batches:
            kind = b.schema.field(0).type
            for part in slices(b, 1, SLICE):
                sets = shingle_sets(part.column(1), WIDTH)
                got = np.concatenate([s % np.uint64(COUNT_CELLS) for s in sets]).astype(np.int64)
                cells += np.bincount(got, minlength=COUNT_CELLS).astype("<f4")
                keys = [_class_of(s) if len(s) else None for s in sets]
                none = pa.nulls(len(sets))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(keys, pa.binary()), pa.array([k and _ref(k) for k in keys], pa.int64()),
                     pa.array([bitmap(s, _width(len(s))).tobytes() if len(s) else None for s in sets], pa.binary()),
                     none.cast(pa.int32()), none.cast(pa.binary())], names=names)
        if kind is not None:
            for stripe in stripes(cells):
                none = pa.nulls(stripe.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [none.cast(kind), none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.binary()),
                     none.cast(pa.int64()), none.cast(pa.binary()), *stripe.columns], names=names)

    every = cut(whole.mapInArrow(describe, f"doc_id {id_type.simpleString()}, row_key long, n long, class binary, "
                                           "ref long, bits binary, stripe int, raw binary"))
    rows = every.where("stripe is null").drop("stripe", "raw")
    counts = spark.sparkContext.broadcast(add_stripes(
        every.where("stripe is not null").select("stripe", "raw"), COUNT_CELLS, "<f4", np.add))
    members = cut(_members(_prefixes(whole.select("text"), counts)))
    counts.unpersist()

    one = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("row_key").alias("row_key"))
    classes = cut(rows.where("n > 0").groupBy("class").agg(
        F.min(one).alias("rep"), F.min("n").alias("n"), F.min("ref").alias("ref"), F.min("bits").alias("bits")))

    # links to the head of the best node, where the shared first shingles allow one
    sizes = classes.select("ref", "n")
    near = (members.join(sizes, "ref").join(sizes.select(F.col("ref").alias("head"), F.col("n").alias("m")), "head"))
    rest = lambda n: F.ceil(F.col(n) * PART / WHOLE) - 1  # noqa: E731  what lies behind the first shingles
    most = F.col("shared") + F.greatest(rest("n"), rest("m"))
    near = near.where((WHOLE + PART) * most >= PART * (F.col("n") + F.col("m")))
    best = cut(near.groupBy("ref").agg(F.max(F.struct("shared", "head")).alias("b"))
               .select(F.col("b.head").alias("head"), "ref"))
    best = cut(_may_link(best, classes))
    edges = cut(_with_heads(best, classes, whole).distinct())
    groups = components(edges)

    # trees over the nodes that still hold several components
    part = classes.join(groups, classes["class"] == groups["node"], "left").select(
        "class", "rep", "ref", "n", "bits", F.coalesce("root", "class").alias("group"))
    part = cut(part)
    nodes = members.select("head", "ref").unionByName(members.select("head", F.col("head").alias("ref")).distinct())
    nodes = cut(nodes.join(part.select("ref", "n", "group"), "ref"))
    mixed = nodes.groupBy("head").agg(F.min("group").alias("lo"), F.max("group").alias("hi")).where("lo <> hi")
    still = nodes.join(mixed.select("head"), "head", "left_semi").select("head", "ref")
    still = cut(_possible(still.join(part.select("ref", "n"), "ref"), part))
    still = still.join(part.select("ref", "class", "n", "group", F.col("rep.row_key").alias("row_key")), "ref")
    still = cut(still)
    more = cut(_inside(still, whole))
    # the groups found so far connect what their links connect, in fewer rounds
    groups = components(groups.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))

    part = classes.join(groups, classes["class"] == groups["node"], "left").select(
        "class", "rep", F.coalesce("root", "class").alias("root"))
    top = part.groupBy("root").agg(F.min("rep").alias("top"))
    part = part.join(top, "root").select("class", "top")
    full = rows.where("n > 0").join(part, "class").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("top.doc_id").alias("component_id"), "row_key",
        (F.col("row_key").eqNullSafe(F.col("top.row_key")) & F.col("doc_id").eqNullSafe(F.col("top.doc_id"))).alias("first"))
    none = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
                                      "row_key", F.lit(True).alias("first"))
    return full.unionByName(none)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


#: All pairs that share a shingle, then the closure: for small tables only.
OP8_SQL = r"""
with recursive w as (
  select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (
  select r, list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s,
    doc_id from w),
e as (select r, unnest(s) as s from s),
n as (select r, doc_id, len(s) as n from s),
p as (select a.r as a, b.r as b, count(*) as c from e a join e b on a.s = b.s and a.r <> b.r group by 1, 2),
l as (select p.a, p.b from p join n x on x.r = p.a join n y on y.r = p.b where 100 * c >= 75 * (x.n + y.n - c)),
reach as (select r as a, r as b from n union select reach.a, l.b from reach join l on l.a = reach.b)
select n.doc_id, cast(n.n as bigint) as n_shingles, min(m.doc_id) as component_id
from n join reach on reach.a = n.r join n m on m.r = reach.b group by n.r, n.doc_id, n.n"""
