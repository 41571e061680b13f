"""Registered queries against their DuckDB oracle on sf0.001 (a fast subset of
the driver's check; ``tools/run_queries.py`` runs all keys on any scale)."""

import duckdb
import pytest

import __spark_entry__ as E
from listingkit.plans.catalog import QUERIES
from tools.run_queries import TABLES, digest

SMOKE = "/root/testdata/sf0.001"
KEYS = ["rating_split", "haversine", "generate_jobs", "failed_jobs", "extract_listings",
        "postprocess", "retry_merge", "canonical_names", "lattice_in_area", "page_anchors"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SMOKE}/{t}.parquet'")
    yield c
    c.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())
    assert set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SMOKE)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)
