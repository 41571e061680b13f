"""Post-processing, jobs, sinks and the driver contract."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listingkit import constants as K
from listingkit import schemas
from listingkit.operators import jobs as J
from listingkit.plans import grid as G
from listingkit.plans import listings as P
from listingkit.sources import io, steps

# Three invented result rows in the interchange CSV form (quoted comma in an address,
# empty rating and price, amenity list literals).
RESULTS_CSV = '''latitude,longitude,keyword,name,link,rating,price,category,address,amenities
-25.101,-57.201,Supermercado,Kiosco Uno,https://www.google.com/maps/place/D/data=!3d-25.101!4d-57.201!19sChIJuno?authuser=0,,,Tienda de alimentación,Calle Uno 1,"['Wi-Fi', ""d'a""]"
-25.102,-57.202,Restaurante,Bar Dos,https://www.google.com/maps/place/A/data=!3d-25.102!4d-57.202!19sChIJdos?authuser=0,4.5(2),,Restaurante,"Calle Dos 2, Piso 3","['a', ' ', '']"
-25.103,-57.203,Store,Tienda Tres,https://www.google.com/maps/place/M/data=!3d-25.103!4d-57.203,"5,0(1)",,Comercio,Calle Tres 3,
'''


@pytest.fixture()
def results(spark, tmp_path):
    path = tmp_path / "results.csv"
    path.write_text(RESULTS_CSV, encoding="utf-8")
    df = io.read_table(spark, str(path), schemas.RESULTS_CSV)
    return df.withColumn("_ord", F.monotonically_increasing_id())


def test_csv_read_quotes(results):
    rows = results.orderBy("_ord").collect()
    assert rows[1].address == "Calle Dos 2, Piso 3"
    assert rows[0].rating is None and rows[0].price is None
    assert rows[0].amenities == "['Wi-Fi', \"d'a\"]"


def test_postprocess_rules_and_idempotence(results):
    listings, amen = P.postprocess(results, ["_ord"])
    rows = listings.orderBy("num_id").collect()
    assert listings.columns == schemas.LISTING_COLUMNS
    assert [r.num_id for r in rows] == [1, 2, 3]
    assert rows[0].prop_id == "ChIJuno" and rows[2].prop_id is None
    assert [(r.rating, r.num_rating) for r in rows] == [(None, 0), (4.5, 2), (0.0, 1)]
    got = sorted((a.prop_id, a.amenity) for a in amen.collect())
    assert got == [("ChIJdos", "a"), ("ChIJuno", "Wi-Fi"), ("ChIJuno", "d'a")]
    twice, _ = P.postprocess(listings)
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, listings.collect()))


@pytest.mark.parametrize("text,n", [("['a', \"d'a\"]", 2), (None, 0), ("[]", 0),
                                    ("['a', ' ', '']", 1), ("[' a ']", 1)])
def test_amenities_explode(spark, text, n):
    df = spark.createDataFrame([("p", text)], "prop_id string, amenities string")
    out = P.explode_amenities(df.withColumn("amenities", P.parse_amenities("amenities", "string")))
    vals = [r.amenity for r in out.collect()]
    assert len(vals) == n
    if text == "[' a ']":
        assert vals == [" a "]                              # stored value stays untrimmed


def test_amenities_malformed_fails(spark):
    df = spark.createDataFrame([("p", "['a', ")], "prop_id string, amenities string")
    with pytest.raises(Exception):
        df.select(P.parse_amenities("amenities", "string")).collect()


def test_generate_jobs(spark):
    grid = spark.createDataFrame([(i, -25.3 - i / 100, -57.6) for i in range(5)],
                                 "point_idx long, latitude double, longitude double")
    jobs = G.make_jobs(grid).collect()
    assert len(jobs) == 5 * len(K.KEYWORDS)
    assert {j.keyword for j in jobs} == set(K.KEYWORDS)
    assert len({(j.latitude, j.longitude, j.keyword) for j in jobs}) == len(jobs)
    first = sorted(jobs, key=lambda j: j.job_idx)[: len(K.KEYWORDS)]
    assert [j.keyword for j in first] == K.KEYWORDS          # points outer, keywords inner
    with pytest.raises(ValueError):
        G.make_jobs(spark.createDataFrame([], "latitude double, longitude double"))
    with pytest.raises(ValueError):
        G.make_jobs(grid.drop("longitude"))


def test_retry_jobs_filter(spark):
    failed = spark.createDataFrame(
        [(0, -25.0, -57.0, None), (1, None, -57.0, "k"), (2, float("nan"), -57.0, "k")],
        "job_idx long, latitude double, longitude double, keyword string")
    assert [r.job_idx for r in J.retry_jobs(failed).collect()] == [0]


def test_write_table_keep_uses_existing(spark, tmp_path):
    path = str(tmp_path / "jobs")
    a = spark.createDataFrame([(1, "a")], "id long, v string")
    b = spark.createDataFrame([(2, "b")], "id long, v string")
    assert [r.id for r in io.write_table(a, path, "keep").collect()] == [1]
    assert [r.id for r in io.write_table(b, path, "keep").collect()] == [1]     # kept + used
    assert [r.id for r in io.write_table(b, path, "overwrite").collect()] == [2]
    with pytest.raises(Exception):
        io.write_table(a, path, "error")


def test_failure_and_result_sinks(spark, tmp_path):
    failed = spark.createDataFrame([(1, 2.0, 3.0, "k", "no results")], schemas.FAILED_JOBS)
    path = str(tmp_path / "failed")
    assert io.write_failures(failed, path) == 1 and io.read_table(spark, path).count() == 1
    assert io.write_failures(failed.limit(0), path) == 0 and io.read_table(spark, path).count() == 0     # no stale file
    lst = spark.createDataFrame([], schemas.LISTINGS)
    amen = spark.createDataFrame([], schemas.AMENITIES)
    done = io.write_results(lst, amen, str(tmp_path / "results"))
    assert done["listings"].columns == schemas.LISTING_COLUMNS and done.rows("listings_amenities") == 0
    assert os.path.isdir(done.path("listings_amenities"))


def test_a_stop_between_two_tables_leaves_the_old_pair(spark, tmp_path):
    path = str(tmp_path / "pair")
    one, two = spark.range(3).toDF("a"), spark.range(5).toDF("b")
    steps.write_step({"x": one, "y": two}, path)
    broken = two.select(F.raise_error(F.lit("stop")).alias("b"))
    with pytest.raises(Exception, match="stop"):
        steps.write_step({"x": one.where("a > 0"), "y": broken}, path)
    old = steps.read_step(spark, path)
    assert (old["x"].count(), old["y"].count(), old.rows("x"), old.rows("y")) == (3, 5, 3, 5)
    with pytest.raises(ValueError, match="y is empty"):
        steps.write_step({"x": one.where("a > 0"), "y": two.limit(0)}, path, non_empty=("y",))
    assert steps.read_step(spark, path).rows("x") == 3
    new = steps.write_step({"x": one.where("a > 0"), "y": two}, path)
    assert new.rows("x") == 2 and old["x"].count() == 3                    # readers of the old pair go on
    assert steps.write_step({"x": two.toDF("a"), "y": two}, path, "keep").rows("x") == 2
    with pytest.raises(FileExistsError):
        steps.write_step({"x": one, "y": two}, path, "error")
    assert steps.read_step(spark, str(tmp_path / "none")) is None


def test_half_written_folder_is_not_kept(spark, tmp_path):
    whole, half = str(tmp_path / "whole"), str(tmp_path / "half")
    df = spark.range(1000).toDF("id")
    for p in (whole, half):
        df.repartition(4).write.parquet(p)
    os.remove(f"{half}/_SUCCESS")
    for name in [f for f in os.listdir(half) if f.endswith(".parquet")][1:]:
        os.remove(f"{half}/{name}")                                       # what a writer that stopped leaves
    other = spark.range(7).toDF("id")
    assert io.write_table(other, whole, "keep", "parquet").count() == 1000
    assert io.write_table(other, half, "keep", "parquet").count() == 7
    assert io.write_table(df, half, "keep", "parquet").count() == 7       # now committed
    one_file = tmp_path / "t.csv"
    one_file.write_text("id\n5\n")
    assert [r.id for r in io.write_table(other, str(one_file), "keep").collect()] == [5]


def test_counts_ride_on_the_write(spark, tmp_path):
    """Every row is computed once, although the table is counted and checked."""
    seen = spark.sparkContext.accumulator(0)
    def mark(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.range(100, numPartitions=4).mapInArrow(mark, "id long")
    assert steps.write_step({"t": df}, str(tmp_path / "t"), non_empty=("t",)).rows("t") == 100 and seen.value == 100
    grid = df.selectExpr("id point_idx", "0d + id latitude", "0d longitude")
    jobs = G.make_jobs(grid, ["k"], out_path=str(tmp_path / "jobs"))
    assert seen.value == 200 and jobs.count() == 100
    with pytest.raises(ValueError, match="empty"):
        G.make_jobs(grid.where("point_idx < 0"), ["k"], out_path=str(tmp_path / "none"))


CSV = """id,lat,name
1,2.5,ok
2,3.5
3,4.5,a,b
4,x,"bad, lat"
y,1.0,bad id
5,,"quoted, ""text"" 2"
6,1.0,
"""


def test_malformed_csv_rows_are_told_apart(spark, tmp_path):
    file = tmp_path / "m.csv"
    file.write_text(CSV, encoding="utf-8")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("lat", T.DoubleType()), T.StructField("name", T.StringType())])
    read = io.read_csv_checked(spark, str(file), schema, required=("name",))
    assert sorted(map(tuple, read.good.collect())) == [(1, 2.5, "ok"), (5, None, 'quoted, "text" 2')]
    assert sorted(map(tuple, read.rejects.collect())) == sorted([
        ("2,3.5", "too few fields"), ("3,4.5,a,b", "too many fields"), ('4,x,"bad, lat"', "not a double: lat"),
        ("y,1.0,bad id", "not a bigint: id"), ("6,1.0,", "no name")])
    assert read.good.select("lat").count() == 2                            # a pruned read rejects the same rows
    kept = io.read_csv_checked(spark, str(file), schema, quarantine=str(tmp_path / "q"))
    assert kept.good.count() == 3 and steps.read_step(spark, str(tmp_path / "q")).rows("rows") == 7
    empty = tmp_path / "e.csv"
    empty.write_text("id,lat,name\n")
    none = io.read_csv_checked(spark, str(empty), schema)
    assert none.good.collect() == [] and none.rejects.collect() == []


@pytest.mark.parametrize("polygons,what", [
    ([], "no polygons"), (None, "no polygons"), ([[]], "no rings"), ([[[(1.0, 2.0), (3.0, 4.0), (1.0, 2.0)]]], "three corners"),
    ([[[(1.0, 2.0), (3.0, float("nan")), (1.0, 5.0)]]], "finite"), ([[[(1.0, 2.0), (None, 4.0), (1.0, 5.0)]]], "finite"),
    ([[[(1.0, 2.0), (200.0, 4.0), (1.0, 5.0)]]], "finite")])
def test_broken_boundaries_fail_the_job_that_reads_them(spark, tmp_path, polygons, what):
    ok = [[[(1.0, 2.0), (3.0, 4.0), (1.0, 5.0)]]]
    spark.createDataFrame([(0, "A", "x", ok), (1, "B", "y", polygons)], schemas.AREAS).write.parquet(str(tmp_path / "a"))
    with pytest.raises(Exception, match=what):
        io.read_boundaries(spark, str(tmp_path / "a")).collect()


def test_boundary_schema_is_checked(spark, tmp_path):
    spark.createDataFrame([(0, "A", "x")], "area_ord int, area_code string, area_name string").write.parquet(str(tmp_path / "a"))
    with pytest.raises(ValueError, match="polygons"):
        io.read_boundaries(spark, str(tmp_path / "a"))


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == schemas.LISTING_COLUMNS
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_results_csv_round_trip(spark, tmp_path):
    hard = ["it's", 'a "b", c', "x\ny", "[z]", "", "é, ñ"]
    df = spark.createDataFrame([(1.0, 2.0, "k", 'n, "m"', "l1", "4.5(2)", "", None, "a", hard), (1.0, 2.0, "k", "n", "l2", None, None, None, None, [])],
                               "latitude double, longitude double, keyword string, name string, "
                               "link string, rating string, price string, category string, address string, amenities array<string>")
    back = io.write_results_csv(df, str(tmp_path / "r.csv"))
    got = {r.link: r for r in back.withColumn("amenities", P.parse_amenities("amenities", "string")).collect()}
    assert got["l1"].amenities == hard and got["l2"].amenities == [] and got["l1"].name == 'n, "m"'


def test_boundaries_and_csv_options(spark, tmp_path):
    ring = [(1.0, 2.0), (3.0, 4.0), (5.0, 2.0)]
    areas = spark.createDataFrame([(0, "A", "x", [[ring]]), (1, "B", "y", [[ring + ring[:1]]])], schemas.AREAS)
    for fmt in ("json", "parquet"):
        areas.write.format(fmt).save(str(tmp_path / fmt))
        back = io.read_boundaries(spark, str(tmp_path / fmt), fmt).orderBy("area_ord").collect()
        assert back[0] == areas.first() and back[1].polygons == back[0].polygons       # closed rings are opened
    text = spark.createDataFrame([("a\nb",)], "t string")
    assert io.write_table(text, str(tmp_path / "t.csv"), multi_line=True).first().t == "a\nb"


def _own_tables(spark, folder):
    """Two customers, an order of each and three lines, one of an order that is not there."""
    spark.createDataFrame([(1, "a"), (2, "b")], "c_custkey long, c_name string").write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame([(10, 1, "O"), (11, 2, "P")], "o_orderkey long, o_custkey long, o_orderstatus string").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(10, 5, 6, 1, 7.0, "N", "O"), (11, 5, 6, 1, 7.0, "R", "F"), (12, 5, 6, 1, 7.0, "A", "F")],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, "
                          "l_linestatus string").write.parquet(f"{folder}/lineitem.parquet")


def _joins(df):
    """Names of the joins in a plan, before it runs."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    return {name for name in ("BroadcastHashJoin [job_idx", "SortMergeJoin [job_idx") if name in plan}


def test_haversine_does_not_broadcast_the_jobs(spark, tmp_path):
    """However small the files of the job table are."""
    from listingkit.plans import catalog as C
    _own_tables(spark, tmp_path)
    df = C.q_haversine(spark, str(tmp_path))
    assert _joins(df) == {"SortMergeJoin [job_idx"}
    assert sorted(r.page_id for r in df.collect()) == [160, 176]


def test_radius_filter_does_not_broadcast_the_jobs(spark, tmp_path):
    from listingkit.plans import catalog as C
    _own_tables(spark, tmp_path)
    df = C.q_radius_filter(spark, str(tmp_path))
    assert _joins(df) == {"SortMergeJoin [job_idx"}
    assert df.count() <= 2


def _shuffle_files(spark):
    """Names of the shuffle files that lie in this machine's scratch folders."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while files.hasNext():
        names.add(files.next().getName())
    return {n for n in names if n.startswith("shuffle_")}


@pytest.mark.parametrize("kind", ["step", "bucketed", "landed", "sorted"])
def test_written_tables_leave_no_shuffle_files(spark, tmp_path, kind):
    import time
    import pyarrow.parquet as pq
    from listingkit.operators import ordering as O
    from listingkit.sources import testdata as td
    df, path = spark.range(5000).repartition(5, "id"), f"{tmp_path}/t"
    before = _shuffle_files(spark)
    if kind == "landed":
        td.land(lambda: df, spark, path)
    elif kind == "sorted":
        O.write_sorted(df, ["id"], path)
    else:
        steps.write_step({"t": df}, path, buckets={"t": ("id", 3)} if kind == "bucketed" else None)
    for _ in range(50):                                    # files go a moment after the write
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) in (None, "false")
    parts = list(tmp_path.rglob("part-*.parquet"))
    assert sum(pq.read_metadata(p).num_rows for p in parts) == 5000
    assert {pq.read_metadata(p).row_group(0).column(0).compression for p in parts if pq.read_metadata(p).num_rows} == {"ZSTD"}


def test_coordinates_are_read_after_the_join_where_asked(spark):
    links = [(1, 0, 0, "x!3d-25.0!4d-57.0"), (1, 0, 1, "x!3d-25.1!4d-57.0"), (2, 1, 0, "none"), (9, 1, 0, "x!3d-25.0!4d-57.0")]
    anchors = spark.createDataFrame(links, "job_idx long, page_id long, pos long, href string")
    jobs = spark.createDataFrame([(1, -25.0, -57.0, "a"), (2, -25.0, -57.0, "b")], "job_idx long, latitude double, longitude double, keyword string")
    early, late = (J.anchors_with_distance(anchors, jobs, late=x) for x in (False, True))
    key = ["job_idx", "page_id", "pos", "href", "latitude", "longitude", "keyword", "dist_m"]
    assert sorted(early.select(key).collect(), key=str) == sorted(late.select(key).collect(), key=str) and late.count() == 3
    moved = late._jdf.queryExecution().sparkPlan().toString().split("Join")[1]
    assert "regexp" not in moved.split("job_lat")[0]       # nothing but the rows themselves


def test_ids_are_sorted_without_other_columns(spark, tmp_path):
    import glob
    from listingkit.plans import catalog as C
    _own_tables(spark, tmp_path)
    kept = f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/sorted-*"
    before = set(glob.glob(kept))
    assert C.q_assign_ids(spark, str(tmp_path)).columns == ["num_id", "link"]
    [new] = set(glob.glob(kept)) - before
    assert set(spark.read.parquet(new).columns) == {"link", "longitude", "latitude", *P.CAPTURE_ORDER}


def test_master_leaves_no_sorted_table_beside_it(spark, tmp_path):
    import glob
    rows = [(k, 0, 0, -25.0 - k, -57.0, f"L{k}") for k in range(50)] + [(99, 0, 0, None, None, None)]
    df = spark.createDataFrame(rows, "job_idx long, page_id long, pos long, latitude double, longitude double, link string")
    kept = f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/sorted-*"
    before = set(glob.glob(kept))
    step = P.write_master(df, f"{tmp_path}/master", buckets=3)
    assert set(glob.glob(kept)) == before and step.rows("master") == 51
    got = {r.num_id: r.link for r in step["master"].collect()}
    assert got == {**{50 - k: f"L{k}" for k in range(50)}, 51: None}
