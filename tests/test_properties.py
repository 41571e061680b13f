"""Property tests: Spark column rules against plain-Python statements of the rules.

Each property draws a batch of inputs with hypothesis and evaluates the whole
batch in one Spark job, so examples are many and jobs are few.
"""

import re

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from listingkit.functions import fields
from listingkit.operators import ordering as O
from listingkit.plans import listings as P

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.too_slow, HealthCheck.data_too_large])

RATING_ALPHABET = "0123456789.,() x"
LINK_PARTS = st.sampled_from(["!3d", "!4d", "-", ".", "1", "25", "57", "3", "x", "?", "ChIJ",
                              "a_b", "!19s", "/", "&"])


def _float_or_none(s):
    try:
        return float(s)
    except ValueError:
        return None


def py_rating(s):
    """First ``([\\d.]+)\\((\\d+)\\)`` match: (value or None, count or 0)."""
    m = re.search(r"([0-9.]+)\(([0-9]+)\)", s) if s is not None else None
    if not m:
        return None, 0
    return _float_or_none(m.group(1)), int(m.group(2))


def py_coords(link):
    m = re.search(r"!3d([-0-9.]+)!4d([-0-9.]+)", link) if link is not None else None
    if not m:
        return None, None
    a, b = _float_or_none(m.group(1)), _float_or_none(m.group(2))
    return (a, b) if a is not None and b is not None else (None, None)


@SETTINGS
@given(st.lists(st.text(alphabet=RATING_ALPHABET, max_size=14), min_size=1, max_size=200))
def test_rating_split_property(spark, texts):
    value, count = fields.rating_split("r")
    got = [tuple(r) for r in spark.createDataFrame([(t,) for t in texts], "r string")
           .select(value, count).collect()]
    assert got == [py_rating(t) for t in texts]


@SETTINGS
@given(st.lists(st.lists(LINK_PARTS, max_size=12).map("".join), min_size=1, max_size=200))
def test_link_fields_property(spark, links):
    lat, lon = fields.link_coords("l")
    got = [tuple(r) for r in spark.createDataFrame([(s,) for s in links], "l string")
           .select(lat, lon).collect()]
    assert got == [py_coords(s) for s in links]


@SETTINGS
@given(st.lists(st.tuples(st.text(alphabet="abc/!?1", max_size=8), st.text(alphabet="abcXYZ-_019!", min_size=1, max_size=12),
                          st.sampled_from(["", "?x=1", "?"])), min_size=1, max_size=100))
def test_place_id_property(spark, parts):
    """A link built around an id gives that id, one without gives none."""
    rows = [(head + "ChIJ" + key + tail, "ChIJ" + key) for head, key, tail in parts] + [(head + tail, None) for head, _, tail in parts]
    got = spark.createDataFrame(rows, "l string, want string").select(fields.place_id("l"), "want").collect()
    assert all(found == want for found, want in got)


@SETTINGS
@given(st.lists(st.text(alphabet="ab 12·\t", max_size=10), min_size=1, max_size=6)
       .flatmap(lambda xs: st.lists(st.just(xs), min_size=1, max_size=1)),
       st.lists(st.text(alphabet="Tienda 0123 ", max_size=16), min_size=1, max_size=100))
def test_category_and_address_property(spark, span_lists, cats):
    rows = [(c, span_lists[0]) for c in cats]
    got = [tuple(r) for r in spark.createDataFrame(rows, "c string, s array<string>")
           .select(fields.category_clean("c"), fields.address_clean("s")).collect()]
    spans = span_lists[0]
    want_addr = re.sub(r"^[·\s]+", "", spans[-1]) if len(spans) >= 2 else ""
    assert got == [(re.sub(r"\d+", "", c).strip(), want_addr) for c in cats]


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(0, 3), st.integers(0, 50),
                          st.one_of(st.none(), st.sampled_from(["A", "B", "C", "D", "E"]))),
                min_size=1, max_size=300, unique_by=lambda t: t[:3]))
def test_keep_first_matches_pandas(spark, rows):
    df = spark.createDataFrame([(j, p, q, 0.0, 0.0, "k", link) for j, p, q, link in rows],
                               "job_idx long, page_id long, pos long, latitude double, "
                               "longitude double, keyword string, link string")
    got = sorted((r.job_idx, r.page_id, r.pos) for r in P.dedupe_keep_first(df).collect())
    pdf = pd.DataFrame(rows, columns=["job_idx", "page_id", "pos", "link"])
    want = (pdf.sort_values(["job_idx", "page_id", "pos"], kind="stable")
            .drop_duplicates(subset=["link"]))
    assert got == sorted(map(tuple, want[["job_idx", "page_id", "pos"]].values.tolist()))


def test_chunks_are_contiguous_and_balanced(spark):
    for n in range(1, 6):
        for total in range(1, 30):
            got = [r.c for r in spark.range(total).select(
                O.chunk_of(F.col("id"), total, n).alias("c")).orderBy("id").collect()]
            assert got == sorted(got) and set(got) <= set(range(n))
            sizes = [got.count(c) for c in range(n)]
            assert max(sizes) - min(sizes) <= 1 and sizes == sorted(sizes, reverse=True)


def test_no_chunks_is_an_error(spark):
    with pytest.raises(ValueError):
        O.balanced_chunks(spark.range(3), 0, ["id"])
