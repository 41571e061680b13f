"""Column rules: link fields, rating split, price/category/address, URLs, distance."""

from urllib.parse import quote_plus

import pytest
from pyspark.sql import functions as F

from listingkit.functions import fields, geo

from fixed_values import LINKS  # noqa: E402


def _one(spark, rows, schema, expr):
    df = spark.createDataFrame(rows, schema)
    return [tuple(r) for r in df.select(*expr).collect()]


def test_link_coords_and_place_id(spark):
    rows = [(u,) for u, *_ in LINKS] + [("https://x/place/no-coords",), ("x!3d1.2.3!4d5",),
                                        ("https://x/data=!19sChIJabc",), (None,)]
    lat, lon = fields.link_coords("link")
    got = _one(spark, rows, "link string", [lat, lon, fields.place_id("link")])
    for (u, la, lo, pid), (gla, glo, gpid) in zip(LINKS, got):
        assert (gla, glo, gpid) == (la, lo, pid)
    assert got[2] == (None, None, None)          # no !3d -> row skipped later
    assert got[3][:2] == (None, None)            # 1.2.3 is not a number
    assert got[4][2] == "ChIJabc"                # id without '?' runs to the end
    assert got[5] == (None, None, None)


@pytest.mark.parametrize("text,rating,count", [
    ("4.5(2)", 4.5, 2), ("4,5(12)", 5.0, 12), ("4,5(1.234)", None, 0), ("", None, 0),
    (None, None, 0), ("4.5", None, 0), ("x 4.0(7) y", 4.0, 7), ("4.5.1(3)", None, 3),
])
def test_rating_split(spark, text, rating, count):
    value, n = fields.rating_split("r")
    assert _one(spark, [(text,)], "r string", [value, n]) == [(rating, count)]


def test_price_choice(spark):
    rows = [("Moderado", ["·", "₲ 10.000"]), (None, ["·", "₲ 10.000", "₲ 9"]),
            (None, ["·", "x"]), (None, []), ("", ["₲ 1"])]
    got = _one(spark, rows, "label string, spans array<string>",
               [fields.price_choice("label", "spans")])
    assert [g[0] for g in got] == ["Moderado", "₲ 10.000", "", "", ""]


def test_category_and_address(spark):
    got = _one(spark, [("Tienda 24 horas2", ["Tienda", "· Av. 1"]), ("Bar", ["Bar"]),
                       (" 7 Hotel ", ["a", "b", "·  Calle 3"])],
               "c string, spans array<string>",
               [fields.category_clean("c"), fields.address_clean("spans")])
    assert got == [("Tienda  horas", "Av. 1"), ("Bar", ""), ("Hotel", "Calle 3")]


def test_coerce_double(spark):
    got = _one(spark, [("1.5",), ("abc",), ("",), (None,), (" 2 ",)], "v string",
               [fields.coerce_double("v")])
    assert [g[0] for g in got] == [1.5, None, None, None, 2.0]


def test_haversine(spark):
    rows = [(-25.34371, -57.66687, -25.3365, -57.66665),
            (-25.3146958, -57.670338, -25.3040161, -57.6681902),
            (-25.0, -57.0, -25.0, -57.0)]
    got = _one(spark, rows, "a double, b double, c double, d double",
               [geo.haversine("a", "b", "c", "d")])
    assert [round(g[0], 4) for g in got] == [802.0202, 1206.9949, 0.0]


def test_request_url_matches_quote_plus(spark):
    kws = ["Centro Comercial", "Galería*~ 24/7", "Café & Bar"]
    rows = [(k, -25.34371, -57.66687) for k in kws]
    got = _one(spark, rows, "k string, lat double, lon double",
               [fields.request_url("k", "lat", "lon", 1000)])
    for k, (url,) in zip(kws, got):
        assert url == (f"https://www.google.com/maps/search/{quote_plus(k)}/"
                       f"@-25.34371,-57.66687,1000m/data=!3m1!4b1?hl=es-419&gl=PY")


def test_py_strip_matches_python(spark):
    texts = ["  a b  ", "\x1c x \x1f", "plain", "　"]
    got = _one(spark, [(t,) for t in texts], "t string", [fields.py_strip("t")])
    assert [g[0] for g in got] == [t.strip() for t in texts]


def test_jobs_are_landed_by_several_tasks(spark, tmp_path):
    """A file of points that one task reads becomes jobs in several."""
    from listingkit import constants as K
    from listingkit.plans import catalog as C
    n = 2 * C.POINTS_PER_PART + 1
    spark.range(n).selectExpr("id c_custkey").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    jobs = C._jobs(spark, str(tmp_path))
    tasks = jobs.select(F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1)).distinct().count()
    assert tasks == 3 and jobs.select("job_idx").distinct().count() == jobs.count() == n * len(K.KEYWORDS)


def test_link_coordinates_take_one_search(spark):
    links = ["x!3d-25.1!4d-57.2!16s", "!3d1.2.3!4d5", "!3d1!4d-", "a!4d7!3d1!4d2", "!3d!3d4!4d5", "!3d-!3d1!4d2!4d3", "", None, "!3d1!4d2!3d3!4d4"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(links)], "i int, link string")
    lat, lon = fields.link_coords("link")
    got = {r.i: (r.lat, r.lon) for r in df.select("i", lat.alias("lat"), lon.alias("lon")).collect()}
    none = (None, None)
    assert [got[i] for i in range(len(links))] == [(-25.1, -57.2), none, none, (1.0, 2.0), (4.0, 5.0), (1.0, 2.0), none, none, (1.0, 2.0)]
