"""Unicode rules and area-name repair."""

import pytest

from listingkit import constants as K
from listingkit.functions.text import clean_text, normalize_key
from listingkit.operators import areas as A

KEY_CASES = [("ASUNCIÓN", "asuncion"), ("ALTO PARANÁ", "alto parana"),
             ("ALTO PARANÃ\x81", "alto parana"), ("  Ñeembucú\t x ", "neembucu x"),
             ("ITAPÃ\x9aA", "itapaa"), ("\ufb01 \u00ba \u00df", "fi o"), ("\u6771\u4eac", ""), (None, None)]

CLEAN_CASES = [("a\tb", "ab"), ("Wi\xa0Fi", "Wi Fi"), ("\u200bx ", "x"), ("\ufb01n", "fin"),
               ("\u2028", ""), ("Wi\u2011Fi", "Wi\u2010Fi"), (None, "")]


def test_text_udfs_on_spark(spark):
    df = spark.createDataFrame([(t,) for t, _ in KEY_CASES], "t string")
    assert [r[0] for r in df.select(normalize_key("t")).collect()] == [k for _, k in KEY_CASES]
    df = spark.createDataFrame([(t,) for t, _ in CLEAN_CASES], "t string")
    assert [r[0] for r in df.select(clean_text("t")).collect()] == [o for _, o in CLEAN_CASES]


def test_canonical_names(spark):
    rows = [(0, "ALTO PARANÃ\x81"), (1, "ITAPÃ\x9aA"), (2, "PARAGUARÃ\x8d"), (3, "PARAGUARÍ"),
            (4, "ASUNCIÓN"), (5, None)]
    df = spark.createDataFrame(rows, "area_ord int, ADM1_ES string")
    out = {r.area_ord: r.cleaned_name
           for r in A.canonical_names(df, K.CLEAN_NAMES, "ADM1_ES").collect()}
    assert out == {0: "ALTO PARANÁ", 1: "ITAPÚA", 2: "PARAGUARÁ", 3: "PARAGUARÍ",
                   4: "ASUNCIÓN", 5: None}


def test_name_map_last_entry_wins(spark):
    df = spark.createDataFrame([(0, "Cafe")], "area_ord int, dep_name string")
    out = A.canonical_names(df, {"CAFÉ": "first", "cafe": "second"}).collect()
    assert out[0].cleaned_name == "second"


def test_name_map_of_any_size(spark):
    names = spark.range(120_000).selectExpr("cast(id as int) ord", "concat('Raw ', id) raw_name", "concat('Clean ', id) clean_name")
    df = spark.createDataFrame([(0, "RAW  119999"), (1, "other")], "area_ord int, name string")
    assert [r.cleaned_name for r in A.canonical_names(df, names).orderBy("area_ord").collect()] == ["Clean 119999", "other"]


def test_column_choice():
    assert A.guess_name_column(["id", "geometry", "NAME_1"]) == "NAME_1"
    assert A.guess_name_column(["id", "Dep_Nombre"]) == "Dep_Nombre"
    assert A.guess_name_column(["a", "b"]) == "a"
    assert A.guess_name_column(["a", "b"], "b") == "b"
    assert A.label_column(["ADM1_ES", "Cleaned_Name"]) == "Cleaned_Name"
    assert A.label_column(["ADM1_ES"]) == "ADM1_ES"


def test_select_areas_and_errors(spark):
    rows = [(0, "PY01", "ASUNCIÓN", None), (1, "PY02", "Central", None),
            (2, "PY01", "asuncion", None)]
    df = spark.createDataFrame(
        rows, "area_ord int, area_code string, area_name string, polygons string")
    sel = A.select_areas(df, "Asunción", "name", "area_name")
    assert sorted(r.area_ord for r in sel.collect()) == [0, 2]
    assert A.first_label(sel, "area_name") == "ASUNCIÓN"
    assert sorted(r.area_ord for r in A.select_areas(df, "py02", "code").collect()) == [1]
    with pytest.raises(ValueError):
        A.select_areas(df, "nowhere", "name", "area_name")


def test_long_texts_are_normalised_by_slices():
    """A batch of long texts: beside it and its result, the task holds a slice."""
    import tracemalloc
    import unicodedata

    import pyarrow as pa

    from listingkit.functions.text import SLICE_ROWS, _normal_form
    texts = [f"Ａﬁ {i} " + "é" * 5_000 for i in range(8 * SLICE_ROWS)] + [None, ""]
    batch = pa.array(texts)
    want = [None if t is None else unicodedata.normalize("NFKC", t) for t in texts]
    tracemalloc.start()
    got = _normal_form(batch, "NFKC")
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.to_pylist() == want and peak < sum(len(t or "") for t in texts)
    assert len(_normal_form(batch.slice(0, 0), "NFKD")) == 0
