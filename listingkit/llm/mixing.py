"""Mixing sources to target weights (operator 2), native.

The words of a source, document after document, form a stream that is cut into
blocks of fixed length.  An output mix is a row of slots in shards:

1. every slot draws its source, so a shard's counts per source are a
   multinomial draw over the target shares;
2. a source's k-th slot takes block ``perm(k)`` of the source, a pseudorandom
   permutation that is new in every pass over the source;
3. slots and document spans meet in an equi-join on (source, block).

Draws beyond a source's quota are drawn again for sources that are short of
theirs, so the taken words are the targets to the word.  Everything follows
from hashes of row values, hence reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listingkit.llm.common import SPACE, cut, table, uniform, word_count, written

WEIGHTS = (5, 2, 1)
MAX_PASSES = 3
BLOCK_WORDS = 256
SHARD_SLOTS = 4096
#: Draws fall into this many equal cells; a cell knows the sources inside it.
CELLS = 4096
#: Rows of a running sum are dealt over this many chunks per key.
CHUNKS = 2048
ROUNDS = 20
#: Shares of a document are counted in these parts.
PARTS = 1_000_000


def _running(df: DataFrame, keys: list[str], chunk: str, order: list[str], value: str, out: str) -> DataFrame:
    """Sum of ``value`` over the rows before, by keys, in order of chunk, then
    ``order``.  Two levels: within a chunk, and over the chunks' totals, so
    that no key's rows meet in one task."""
    totals = df.groupBy(*keys, chunk).agg(F.sum(value).alias("_total"))
    before = W.partitionBy(*(keys or [F.lit(0)])).orderBy(chunk).rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(*keys, chunk, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_chunk_before"))
    inside = W.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (df.withColumn("_before", F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .join(totals, [*keys, chunk])
            .withColumn(out, (F.col("_before") + F.col("_chunk_before")).cast("long"))
            .drop("_before", "_chunk_before"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_passes: int = MAX_PASSES) -> DataFrame:
    """sid, source, source_size, target of each source (one row a source).

    Sources by code point, null last, take the weights in turn and share the
    sum of all sizes; a share stops at ``max_passes`` times its source, and
    what is left over is shared again.  Filled in order of cap per weight, the
    capped sources are a prefix, so the sharing ends after one pass."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = W.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("sid", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("sid") % len(weights) + 1).cast("double")
    per = per.withColumn("weight", weight).withColumn("cap", (max_passes * F.col("source_size")).cast("double"))
    all_rows = W.partitionBy(F.lit(0))
    fill = all_rows.orderBy(F.col("cap") / F.col("weight"), "sid")
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    left = F.sum("source_size").over(all_rows) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = left / F.sum("weight").over(fill.rowsBetween(W.currentRow, W.unboundedFollowing))
    per = per.withColumn("level", level).withColumn("capped", F.col("level") * F.col("weight") > F.col("cap"))
    last = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), F.col("sid"),
                                                   F.col("level").alias("level")))).over(all_rows)["level"]
    return per.select("sid", "source", "source_size",
                      F.when(F.col("capped"), F.col("cap")).otherwise(last * F.col("weight")).alias("target"))


def permuted(x: Column, n: Column, key: Column, rounds: int = ROUNDS) -> Column:
    """Pseudorandom permutation of 0..n-1: each round pairs x with K - x mod n
    and a hash of the pair says whether they change places (swap-or-not)."""
    def step(at: Column, r: Column) -> Column:
        turn = F.pmod(F.xxhash64(key, r), n)
        other = F.pmod(turn - at, n)
        swap = F.xxhash64(key, r, F.greatest(at, other)) < 0
        return F.when(swap, other).otherwise(at)
    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), x, step)


def size_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   source: str = "source") -> DataFrame:
    """doc_id, source, size (words), order key; written once."""
    return cut(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                           word_count(F.col(text)).alias("size"),
                           F.xxhash64(F.col(doc_id), F.col(text)).alias("row_key")))


def spread_documents(sizes: DataFrame, shares: DataFrame) -> DataFrame:
    """Adds sid, targets and ``at``: the document's first word in its source's
    stream.  Equal rows take places of their own."""
    known = sizes.join(shares, sizes["source"].eqNullSafe(shares["source"])).select(
        sizes["*"], "sid", "source_size", "target")
    known = known.withColumn("chunk", F.pmod(F.col("row_key"), F.lit(CHUNKS)))
    return _running(known, ["sid"], "chunk", ["doc_id", "row_key", "size"], "size", "at").drop("chunk")


def _plan(shares: DataFrame, block: int) -> DataFrame:
    """Per source: whole blocks, blocks a pass, slots of the mix, words of the
    last, partial pass."""
    words = F.least(F.round("target").cast("long"), MAX_PASSES * F.col("source_size"))
    return (shares.where("source_size > 0").withColumn("words", words)
            .withColumn("whole", F.expr(f"source_size div {block}"))
            .withColumn("a_pass", F.expr(f"(source_size + {block - 1}) div {block}"))
            .withColumn("rest", F.expr("words % source_size"))
            .withColumn("slots", F.expr(f"(words div source_size) * a_pass + (rest + {block - 1}) div {block}")))


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """The rows in as many partitions as shuffles have.  The number is given, since
    partitions of few rows would be merged, and each row here becomes thousands."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def drawn_shards(plan: DataFrame, shard_slots: int) -> DataFrame:
    """n (slots of the mix), shard: a row a shard."""
    return dealt(plan.agg(F.sum("slots").alias("n")).where("n > 0").select("n", F.explode(F.sequence(
        F.lit(0).cast("long"), F.expr(f"(n - 1) div {shard_slots}"))).alias("shard")), "shard")


def draw_slots(plan: DataFrame, seed: str, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """sid, shard, k: every slot of the mix, with its number k in its source."""
    before = W.partitionBy(F.lit(0)).orderBy("sid").rowsBetween(W.unboundedPreceding, -1)
    line = plan.select("sid", "slots", F.coalesce(F.sum("slots").over(before), F.lit(0)).alias("lo"),
                       F.sum("slots").over(W.partitionBy(F.lit(0))).alias("n")).where("slots > 0")
    line = line.withColumn("lo", F.col("lo") / F.col("n")).withColumn("hi", F.col("lo") + F.col("slots") / F.col("n"))
    # at most CELLS rows more than there are sources
    cells = line.select("sid", "lo", "hi", F.explode(F.sequence(
        F.floor(F.col("lo") * CELLS), F.least(F.floor(F.col("hi") * CELLS), F.lit(CELLS - 1).cast("long")))).alias("cell"))
    drawn = (drawn_shards(plan, shard_slots)
             .select("shard", F.explode(F.sequence(F.lit(0), F.least(
                 F.lit(shard_slots), F.col("n") - F.col("shard") * shard_slots).cast("int") - 1)).alias("slot"))
             .withColumn("u", uniform(seed, F.col("shard"), F.col("slot")))
             .withColumn("cell", F.floor(F.col("u") * CELLS)))
    counts = (drawn.join(cells, "cell").where("u >= lo and (u < hi or hi > 0.9999999999)")
              .groupBy("shard", "slot").agg(F.min("sid").alias("sid"))
              .groupBy("shard", "sid").agg(F.count("*").alias("c")))
    counts = cut(counts)
    chunked = counts.withColumn("chunk", F.expr("shard div 1024"))
    counts = _running(chunked, ["sid"], "chunk", ["shard"], "c", "p").join(plan.select("sid", "slots"), "sid")
    kept = F.greatest(F.lit(0), F.least(F.col("c"), F.col("slots") - F.col("p")))
    counts = written(counts.withColumn("kept", kept), "draws")     # read five times below
    first = dealt(counts.where("kept > 0"), "sid", "shard").select("sid", "shard", F.explode(F.sequence(
        F.col("p"), F.col("p") + F.col("kept") - 1)).alias("k"))
    # surplus draws, one after another, fill the quotas that are not reached
    over = counts.groupBy("shard", "chunk").agg(F.sum(F.col("c") - F.col("kept")).alias("over")).where("over > 0")
    over = _running(over, [], "chunk", ["shard"], "over", "o").select("shard", F.explode(F.sequence(
        F.col("o"), F.col("o") + F.col("over") - 1)).alias("rank"))
    total = counts.groupBy("sid").agg(F.sum("c").alias("drawn"))
    short = (plan.select("sid", "slots").join(total, "sid", "left")
             .withColumn("drawn", F.coalesce("drawn", F.lit(0))).withColumn("short", F.col("slots") - F.col("drawn"))
             .where("short > 0"))
    short = (short.withColumn("o", F.coalesce(F.sum("short").over(before), F.lit(0)))
             .select("sid", "drawn", "o", F.explode(F.sequence(F.col("o"), F.col("o") + F.col("short") - 1)).alias("rank")))
    again = over.join(short, "rank").select("sid", "shard", (F.col("drawn") + F.col("rank") - F.col("o")).alias("k"))
    return first.unionByName(again)


def mix(placed: DataFrame, shares: DataFrame, block: int = BLOCK_WORDS, seed: str = "mix") -> DataFrame:
    """Spans of the mix: shard, sid, k (slot), block, doc_id, at, start (word of
    the document), length (words), place (word of the block)."""
    plan = cut(_plan(shares, block))
    slots = draw_slots(plan, seed).join(plan, "sid")
    turn, pos = F.expr("k div a_pass"), F.expr("k % a_pass")
    slots = (slots.withColumn("turn", turn).withColumn("pos", pos)
             .withColumn("block", F.when(F.col("pos") < F.col("whole"), permuted(
                 F.col("pos"), F.col("whole"), F.xxhash64(F.lit(seed), F.col("sid"), F.col("turn"))))
                 .otherwise(F.col("whole")))
             .withColumn("limit", F.when(F.col("turn") == F.expr("words div source_size"),
                                         F.least(F.lit(block), F.col("rest") - F.col("pos") * block))
                         .otherwise(F.lit(block)))
             .select("sid", "shard", "k", "block", "limit"))
    held = placed.where("size > 0").select("sid", "doc_id", "at", "size", F.explode(F.sequence(
        F.expr(f"at div {block}"), F.expr(f"(at + size - 1) div {block}"))).alias("block"))
    low = F.greatest(F.col("at"), F.col("block") * block)
    high = F.least(F.col("at") + F.col("size"), F.col("block") * block + F.col("limit"))
    return (slots.join(held, ["sid", "block"])
            .select("shard", "sid", "k", "block", "doc_id", "at", (low - F.col("at")).alias("start"),
                    (high - low).alias("length"), (low - F.col("block") * block).alias("place"))
            .where("length > 0"))


def taken_words(docs: DataFrame, **columns) -> DataFrame:
    """Per document: doc_id, row_key, source, size, source_size, target (its
    source's), taken (words the mix takes, repeats counted).

    A null text has no words.  Null sources are one source.  Repeated rows and
    null ids are documents of their own.  An empty table gives no rows; where
    no document has a word, all targets are 0."""
    sizes = size_documents(docs, **columns)
    shares = cut(targets(sizes))
    placed = cut(spread_documents(sizes, shares))
    taken = written(mix(placed, shares).groupBy("sid", "at").agg(F.sum("length").alias("taken")), "taken-at")
    full = placed.where("size > 0").join(taken, ["sid", "at"], "left")
    none = placed.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return full.unionByName(none).select(
        "sid", "doc_id", "row_key", "source", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def whole_copies(taken: DataFrame) -> DataFrame:
    """doc_id, row_key, source, times: how often the mix has each document whole.

    A document of n words of which t are taken comes t div n times; the shares
    that are left are added up over the documents of a source, by size, and each
    whole number that the sum passes is one document more.  So every source
    keeps its words to about one document.  Documents without words come once."""
    one = taken.groupBy("sid", "doc_id", "row_key", "source").agg(F.sum("size").alias("size"), F.sum("taken").alias("taken"))
    one = written(one, "taken")                    # read three times below, each with the plan of the whole mix else
    some = one.where("size > 0").withColumn("part", F.round((F.col("taken") % F.col("size")) / F.col("size") * PARTS).cast("long"))
    level = F.floor(F.log2(F.col("size").cast("double")) * 8).cast("long")
    some = some.withColumn("chunk", level * 256 + F.pmod("row_key", F.lit(256)))
    some = _running(some, ["sid"], "chunk", ["size", "row_key", "doc_id"], "part", "sum")
    times = F.expr(f"taken div size + (sum + part) div {PARTS} - sum div {PARTS}").cast("int")
    none = one.where("size = 0").withColumn("times", F.lit(1))
    columns = ["doc_id", "row_key", "source", "times"]
    return some.withColumn("times", times).select(columns).unionByName(none.select(columns))


def mixed_texts(docs: DataFrame, **columns) -> DataFrame:
    """The mix itself: shard, sid, k, text (a block's words, joined by spaces)."""
    text, doc_id = columns.get("text", "text"), columns.get("doc_id", "doc_id")
    sizes = size_documents(docs, **columns)
    shares = cut(targets(sizes))
    placed = cut(spread_documents(sizes, shares))
    spans = mix(placed, shares).join(placed.select("sid", "at", "row_key").where("size > 0"), ["sid", "at"])
    words = docs.select(F.xxhash64(F.col(doc_id), F.col(text)).alias("row_key"), F.split(
        F.regexp_replace(F.col(text), f"^{SPACE}", ""), SPACE).alias("words")).dropDuplicates(["row_key"])
    part = F.array_join(F.slice("words", F.col("start").cast("int") + 1, F.col("length").cast("int")), " ")
    return (spans.join(words, "row_key").withColumn("part", part).groupBy("shard", "sid", "k")
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "part"))),
                                          lambda x: x["part"]), " ").alias("text")))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    taken = taken_words(table(spark, sf_dir, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", "taken")
