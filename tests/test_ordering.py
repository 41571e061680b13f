"""Keep-first dedupe, dense ids, balanced chunks, sort and retry merge."""

import random

import pytest
from pyspark.sql import functions as F

from listingkit.operators import ordering as O
from listingkit.plans import listings as P

SCHEMA = ("job_idx long, page_id long, pos long, latitude double, longitude double, "
          "keyword string, link string")


@pytest.mark.parametrize("rows,n,sizes", [(8, 3, [3, 3, 2]), (2, 3, [1, 1, 0]), (9, 3, [3, 3, 3])])
def test_balanced_chunks(spark, rows, n, sizes):
    df = spark.range(rows).withColumnRenamed("id", "job_idx")
    out = O.balanced_chunks(df, n, ["job_idx"]).groupBy("chunk").count().collect()
    got = {r["chunk"]: r["count"] for r in out}
    assert [got.get(c, 0) for c in range(n)] == sizes
    # contiguous: chunk never decreases along the order
    ch = [r.chunk for r in O.balanced_chunks(df, n, ["job_idx"]).orderBy("job_idx").collect()]
    assert ch == sorted(ch)


def test_assign_ids_dense_and_ordered(spark):
    random.seed(7)
    vals = [(random.randint(0, 50), i) for i in range(3000)]
    df = spark.createDataFrame(vals, "k int, t int").repartition(13)
    out = O.assign_ids(df, ["k", "t"], "num_id", num_partitions=7).collect()
    got = sorted((r.num_id, r.k, r.t) for r in out)
    want = [(i + 1, k, t) for i, (k, t) in enumerate(sorted(vals))]
    assert got == want


def test_keep_first_rules(spark):
    rows = [(5, 0, 0, -25.0, -57.0, "b", "L1"), (2, 0, 3, -25.1, -57.1, "a", "L1"),
            (3, 0, 0, -25.2, -57.2, "c", None), (4, 0, 0, -25.3, -57.3, "d", None),
            (1, 0, 1, -25.4, None, "e", "L2")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = {(r.link, r.job_idx) for r in P.dedupe_keep_first(df).collect()}
    assert out == {("L1", 2), (None, 3), ("L2", 1)}
    merged = [r.link for r in P.merge_results(df).collect()]
    assert merged[-1] == "L2"                     # null longitude sorts last


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_keep_first_independent_of_partitioning(spark, parts):
    random.seed(3)
    rows = [(random.randint(0, 30), random.randint(0, 3), i, -25.0, -57.0, "k",
             f"L{random.randint(0, 40)}") for i in range(2000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = {(r.link, r.job_idx, r.page_id, r.pos) for r in P.dedupe_keep_first(df).collect()}
    best = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        best.setdefault(r[6], (r[6], r[0], r[1], r[2]))
    assert got == set(best.values())


def test_concat_schema_drift(spark):
    a = spark.createDataFrame([(1, 0, 0, -25.0, -57.0, "k", "L1")], SCHEMA)
    b = spark.createDataFrame([(2, 0, 0, -25.0, -57.0, "k", "L2", "021")],
                              SCHEMA + ", phone string")
    both = P.concat_results(a, b)
    assert set(both.columns) >= {"phone"} and both.count() == 2
    assert both.where(F.col("phone").isNull()).count() == 1


def test_dedupe_stats(spark):
    rows = [(1, 0, 0, 0.0, 0.0, "k", "A"), (2, 0, 0, 0.0, 0.0, "k", "A"),
            (3, 0, 0, 0.0, 0.0, "k", None), (4, 0, 0, 0.0, 0.0, "k", None)]
    s = P.dedupe_stats(spark.createDataFrame(rows, SCHEMA)).first()
    assert (s.rows_before, s.rows_after, s.removed) == (4, 2, 2)


def test_retry_merge_master_wins_and_order(spark, tmp_path):
    master = spark.createDataFrame([(1, 0, 0, -25.0, -57.5, "k", "A"), (3, 0, 0, -25.0, -57.3, "k", None),
                                    (2, 0, 0, -25.0, -57.4, "k", "B")], SCHEMA)
    retry = spark.createDataFrame([(9, 0, 0, -25.0, -58.0, "r", "A"), (9, 0, 1, -25.0, -58.0, "r", None), (9, 0, 2, -25.0, -58.0, "r", ""),
                                   (8, 0, 0, -25.0, -59.0, "r", "C"), (8, 0, 1, -25.0, -59.0, "r", "C")], SCHEMA)
    step = P.write_master(P.merge_results(master), str(tmp_path / "master"), buckets=4)
    merged = P.retry_merge(step, retry)
    listings, _ = P.postprocess(merged.withColumn("rating", F.lit("4.0(1)")))
    got = [(r.num_id, r.link, r.keyword) for r in listings.orderBy("num_id").collect()]
    # master rows first in their sorted order, retry-only rows after them; A and the null link kept from master
    assert got == [(1, "A", "k"), (2, "B", "k"), (3, None, "k"), (4, "C", "r"), (5, "", "r")]


def _exchanges_above_scan(plan: str, table: str) -> int:
    """Exchanges on the way from the scan of ``table`` to the top of the plan."""
    lines = plan.splitlines()
    n = 0
    for at, line in enumerate(lines):
        if "FileScan" in line and table in line:
            depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
            for above in reversed(lines[:at]):
                d = len(above) - len(above.lstrip(" :+-*()0123456789"))
                if d < depth:
                    depth = d
                    n += "Exchange" in above
    return n


def test_retry_merge_does_not_move_the_master(spark, tmp_path):
    rows = [(i, 0, 0, -25.0, -57.0 + i / 1e4, "k", f"L{i}") for i in range(500)]
    step = P.write_master(P.merge_results(spark.createDataFrame(rows, SCHEMA)), str(tmp_path / "m"), buckets=8)
    retry = spark.createDataFrame([(i, 1, 0, -25.0, -57.0, "r", f"L{i * 3}") for i in range(400)], SCHEMA)
    fresh = P.new_links(step["master"], retry)
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange hashpartitioning(_link_key" in plan      # the retry side
    name = step["master"]._jdf.queryExecution().analyzed().toString()
    assert "listingkit_" in name and _exchanges_above_scan(plan, "listingkit_") == 0
    assert {r.link for r in fresh.collect()} == {f"L{i * 3}" for i in range(400) if i * 3 >= 500}
    merged = P.retry_merge(step, retry)
    assert _exchanges_above_scan(merged._jdf.queryExecution().executedPlan().toString(), "listingkit_") == 0
    ids = sorted(r.num_id for r in merged.collect())
    assert ids == list(range(1, len(ids) + 1))


def test_ids_come_from_files_and_stay(spark, tmp_path):
    """No checkpoint; ids equal the window's, also where a file is read in several parts and read again."""
    rows = [(random.Random(i).randint(0, 9), i, "x" * 50) for i in range(20_000)]
    df = spark.createDataFrame(rows, "k int, t int, pad string").repartition(5)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        table = O.write_sorted(df, ["k", "t"], str(tmp_path / "s"), num_partitions=13)
        ids = O.file_ids(table)
        got = [(r.num_id, r.k, r.t) for r in ids.select("num_id", "k", "t").collect()]
        again = [(r.num_id, r.k, r.t) for r in ids.where("t % 7 = 0").select("num_id", "k", "t").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = [(i + 1, k, t) for i, (k, t, _) in enumerate(sorted(rows))]
    assert sorted(got) == want and sorted(again) == [w for w in want if w[2] % 7 == 0]
    assert "Checkpoint" not in ids._jdf.queryExecution().analyzed().toString()
    assert O.assign_ids(df.limit(0), ["k"]).collect() == []


@pytest.mark.parametrize("n", [1, 3, 7, 50])
def test_chunks_equal_ntile_without_a_sort(spark, n):
    rng = random.Random(n)
    keys = rng.sample(range(-10**15, 10**18), 400) + list(range(5000, 5100)) + [-2**63, 2**63 - 1]
    width = 2**64 // O.PARTS                                              # keys on both sides of a part's edge
    keys += [-2**63 + width * k + d for k in (1, 2, 700) for d in (-1, 0, 1)]
    df = spark.createDataFrame([(k,) for k in keys], "job_idx long").repartition(6)
    out = O.balanced_chunks(df, n, ["job_idx"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Window" not in plan and "rangepartitioning" not in plan
    df.createOrReplaceTempView("keys_to_cut")
    want = spark.sql(f"select job_idx, ntile({n}) over (order by job_idx) - 1 as chunk from keys_to_cut").collect()
    assert {(r.job_idx, r.chunk) for r in out.collect()} == {(r.job_idx, r.chunk) for r in want}


def test_keys_at_ranks(spark):
    df = spark.createDataFrame([(k,) for k in [7, 7, 7, 3, None, 9]], "k long")
    assert O.keys_at_ranks(df, "k", [0, 1, 3, 4]) == [3, 7, 7, 9]
    assert O.keys_at_ranks(df.limit(0), "k", [0]) == [] and O.keys_at_ranks(df, "k", []) == []
