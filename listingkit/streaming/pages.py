"""Incremental extraction of captured result pages (Structured Streaming).

Captured pages land in a folder as collection runs, a job's pages together.
``start_page_stream`` runs the batch extraction on every micro-batch of new
pages and appends the listings, failed jobs and per-job counts under
``out_dir``.  Each micro-batch writes to its own ``epoch=<id>`` folder with
overwrite, so a batch replayed after a failure rewrites the same files
(exactly-once output with the stream's checkpoint).  The keep-first merge
stays a batch step over everything landed (``plans.listings.merge_results``),
because which row is first depends on all passes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from listingkit import schemas
from listingkit.plans.listings import extract_listings


def _write_epoch(df: DataFrame, path: str, epoch: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")


def extract_batch(pages: DataFrame, jobs: DataFrame, out_dir: str, epoch: int,
                  radius_m: float = 1000) -> None:
    """Extract one batch of pages and write its three outputs for ``epoch``."""
    batch_jobs = jobs.join(pages.select("job_idx").distinct(), "job_idx", "left_semi")
    ext = extract_listings(pages, batch_jobs, radius_m)
    try:
        _write_epoch(ext.listings, f"{out_dir}/listings", epoch)
        _write_epoch(ext.failed, f"{out_dir}/failed", epoch)
        _write_epoch(ext.summary(), f"{out_dir}/summary", epoch)
    finally:
        ext.discard()


def start_page_stream(spark: SparkSession, pages_dir: str, jobs: DataFrame, out_dir: str,
                      checkpoint_dir: str, radius_m: float = 1000,
                      max_files_per_trigger: int | None = None,
                      available_now: bool = False) -> StreamingQuery:
    """Start the incremental extraction; returns the running query."""
    reader = spark.readStream.schema(schemas.PAGES)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    pages = reader.parquet(pages_dir)

    def run(batch: DataFrame, epoch: int) -> None:
        extract_batch(batch, jobs, out_dir, epoch, radius_m)

    writer = (pages.writeStream.foreachBatch(run)
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def read_outputs(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """The outputs over all epochs landed so far: listings, one summary row per
    job, and failed jobs.  A job whose pages came in several epochs is failed
    only if none of them had an anchor."""
    listings, failed, parts = (spark.read.parquet(f"{out_dir}/{name}").drop("epoch")
                               for name in ("listings", "failed", "summary"))
    counts = ["anchors", "no_coords", "outside_radius", "within_radius", "accepted", "card_errors"]
    summary = parts.groupBy("job_idx", "keyword").agg(
        *(F.sum(c).alias(c) for c in counts), F.min("no_results").alias("no_results"), F.min("failed").alias("failed"))
    hit = summary.where(~F.col("failed")).select("job_idx")
    return {"listings": listings, "summary": summary,
            "failed": failed.dropDuplicates(["job_idx"]).join(hit, "job_idx", "left_anti")}


def pages_for_stream(pages: DataFrame, n_slices: int) -> list[DataFrame]:
    """Split a page table into job-complete slices (all pages of a job together),
    e.g. to land them one by one in tests or replays."""
    slice_of = F.pmod(F.xxhash64("job_idx"), F.lit(n_slices))
    return [pages.where(slice_of == i) for i in range(n_slices)]
