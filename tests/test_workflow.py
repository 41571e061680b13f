"""End-to-end workflow on derived sf0.001 inputs."""

from listingkit.plans import catalog as C
from listingkit.plans.workflow import job_chunks, prepare_jobs, process_pages
from listingkit.sources import testdata as td

SMOKE = "/root/testdata/sf0.001"


def test_prepare_jobs(spark, tmp_path):
    areas = td.areas(spark, SMOKE)
    res = prepare_jobs(areas, "Asunción", str(tmp_path), radius_m=1000)
    assert res.city == "ASUNCIÓN"
    n_grid = res.grid.count()
    assert n_grid > 0 and res.jobs.count() == 16 * n_grid
    again = prepare_jobs(areas, "Asunción", str(tmp_path), radius_m=1000)   # kept and used
    assert again.jobs.count() == res.jobs.count()
    chunks = job_chunks(res.jobs, 3).groupBy("chunk").count().collect()
    sizes = sorted(r["count"] for r in chunks)
    assert sizes[-1] - sizes[0] <= 1


def test_process_pages_with_retry(spark, tmp_path):
    jobs = C._jobs(spark, SMOKE)
    pages = td.result_pages(spark, SMOKE)
    retry = td.result_pages(spark, SMOKE, "retry")
    res = process_pages(jobs, pages, str(tmp_path), retry)
    want = C.q_retry_merge(spark, SMOKE)
    got = sorted(map(tuple, res.listings.collect()))
    assert got == sorted(map(tuple, want.collect()))
    assert res.counts["failed"] > res.counts["still_failed"] >= 0
    assert res.counts["amenities"] > 0


def test_process_pages_no_retry(spark, tmp_path):
    jobs = C._jobs(spark, SMOKE)
    res = process_pages(jobs, td.result_pages(spark, SMOKE), str(tmp_path))
    want = C.q_postprocess(spark, SMOKE)
    assert sorted(map(tuple, res.listings.collect())) == sorted(map(tuple, want.collect()))


def test_run_totals(spark):
    from listingkit.plans import listings as P
    from listingkit.plans.workflow import run_totals
    jobs = C._jobs(spark, SMOKE)
    ext = P.extract_listings(td.result_pages(spark, SMOKE), jobs, 1000.0)
    tot = run_totals(jobs, ext.listings, ext.failed, 3).collect()
    assert [t.chunk for t in tot] == [0, 1, 2]
    assert sum(t.jobs for t in tot) == jobs.count()
    assert sum(t.rows for t in tot) == ext.listings.count()
    assert sum(t.failed for t in tot) == ext.failed.count()
    assert max(t.jobs for t in tot) - min(t.jobs for t in tot) <= 1
    ext.discard()


def test_process_pages_counts_by_its_writes(spark, tmp_path, monkeypatch):
    """No table is counted by reading it, cached, or checkpointed; totals equal the tables'."""
    from pyspark.sql import DataFrame
    jobs, pages, retry = C._jobs(spark, SMOKE), td.landed_pages(spark, SMOKE), td.landed_pages(spark, SMOKE, "retry")
    def forbidden(*_a, **_k):
        raise AssertionError("not in process_pages")
    with monkeypatch.context() as m:
        for name in ("count", "cache", "persist", "checkpoint", "localCheckpoint"):
            m.setattr(type(jobs), name, forbidden)
            m.setattr(DataFrame, name, forbidden)
        res = process_pages(jobs, pages, str(tmp_path), retry)
    assert res.counts["listings"] == res.listings.count() and res.counts["amenities"] == res.amenities.count()
    assert res.counts["still_failed"] == res.failed.count()
    totals = C.q_run_totals(spark, SMOKE).collect()
    assert res.counts["failed"] == sum(t.failed for t in totals)
    assert res.counts["results"] == C.q_merge_results(spark, SMOKE).count()


def test_prepare_jobs_refuses_an_empty_grid(spark, tmp_path):
    import pytest
    areas = td.areas(spark, SMOKE)
    with pytest.raises(ValueError):
        prepare_jobs(areas, "Asunción", str(tmp_path), radius_m=10**8)
    assert prepare_jobs(areas, "Asunción", str(tmp_path)).jobs.count() > 0       # nothing half done was kept
