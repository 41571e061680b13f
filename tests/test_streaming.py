"""Incremental extraction equals the batch extraction."""

from listingkit.plans import catalog as C
from listingkit.plans import listings as P
from listingkit.sources import testdata as td
from listingkit.streaming.pages import pages_for_stream, read_outputs, start_page_stream

SMOKE = "/root/testdata/sf0.001"


def test_stream_matches_batch(spark, tmp_path):
    pages = td.result_pages(spark, SMOKE)
    jobs = C._jobs(spark, SMOKE)
    # land job-complete slices as separate files; one file per micro-batch
    flat = str(tmp_path / "landing")
    for i, part in enumerate(pages_for_stream(pages, 3)):
        part.coalesce(1).write.mode("append").parquet(flat)

    q = start_page_stream(spark, flat, jobs, str(tmp_path / "out"), str(tmp_path / "ckpt"),
                          max_files_per_trigger=1, available_now=True)
    q.awaitTermination(300)
    out = read_outputs(spark, str(tmp_path / "out"))

    batch = P.extract_listings(pages, jobs, 1000.0)
    key = ["job_idx", "page_id", "pos", "link", "name", "rating", "price", "category", "address"]
    got = sorted(tuple(r) for r in out["listings"].select(*key).collect())
    want = sorted(tuple(r) for r in batch.listings.select(*key).collect())
    assert got == want and len(got) > 0
    # failures: per batch only jobs whose pages arrived; all have anchors or not
    streamed_failed = {r.job_idx for r in out["failed"].collect()}
    batch_failed_with_pages = {r.job_idx for r in batch.failed.join(
        pages.select("job_idx").distinct(), "job_idx", "left_semi").collect()}
    assert streamed_failed == batch_failed_with_pages
