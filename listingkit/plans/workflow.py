"""The end-to-end workflow: areas -> jobs, then captured pages -> listings.

``prepare_jobs`` covers name repair, lattice and job generation (P1-P3) and
persists the cleaned areas, the grid and the job table.  Page collection
happens outside Spark; ``process_pages`` then takes the captured pages and
runs extraction, merge, the failure table, the optional retry pass and the
post-processing (P4-P7) with the original flow gate: post-process right
after the first pass only when nothing failed, otherwise after the retry
merge.  Every output is a committed table under ``out_dir`` (``sources.steps``),
and every count is taken by the write of its table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingkit import constants as K
from listingkit.operators import jobs as J
from listingkit.operators.ordering import balanced_chunks
from listingkit.plans import grid as G
from listingkit.plans import listings as P
from listingkit.sources import io, steps


@dataclass
class JobsResult:
    city: str
    grid: DataFrame
    jobs: DataFrame
    paths: dict = field(default_factory=dict)


def prepare_jobs(areas: DataFrame, area_key: str, out_dir: str, by: str = "name",
                 radius_m: int = K.DEFAULT_RADIUS_M, keywords=K.KEYWORDS,
                 clean_names=K.CLEAN_NAMES, if_exists: str = "keep") -> JobsResult:
    """P1-P3: cleaned areas, the lattice of the chosen area, and its jobs.

    Existing grid / job tables are kept and used unless ``if_exists`` says
    otherwise (the original asked before overwriting).
    """
    paths = {"areas": f"{out_dir}/areas_cleaned"}
    cleaned = G.clean_areas(areas, clean_names, out_path=paths["areas"])
    spacing = radius_m * K.LATTICE_SPACING_FACTOR
    grid, city = G.build_grid(cleaned, area_key, by, spacing, label="cleaned_name")
    paths["grid"] = f"{out_dir}/grid"
    grid = io.write_table(grid, paths["grid"], if_exists=if_exists, fmt="parquet", non_empty=True)
    paths["jobs"] = f"{out_dir}/jobs"
    jobs = G.make_jobs(grid, keywords, out_path=paths["jobs"], if_exists=if_exists)
    return JobsResult(city, grid, jobs, paths)


@dataclass
class PagesResult:
    listings: DataFrame
    amenities: DataFrame
    failed: DataFrame
    counts: dict
    paths: dict


def process_pages(jobs: DataFrame, pages: DataFrame, out_dir: str,
                  retry_pages: DataFrame | None = None,
                  radius_m: float = K.DEFAULT_RADIUS_M, layout="loc1") -> PagesResult:
    """P4-P7 with sinks: extraction, keep-first merge, failures, retry, post-process.

    Pages are parsed once a pass, into a written extraction table.  The merged
    pass and its failures are committed together, as are listings and amenities;
    a run that stops in between leaves the pair that was there."""
    ext = P.extract_listings(pages, jobs, radius_m, layout=layout, path=f"{out_dir}/extraction")
    master = P.write_master(P.merge_results(ext.listings), f"{out_dir}/results")
    first = steps.write_step({"failed": ext.failed, "summary": ext.summary()}, f"{out_dir}/pass1")
    failed = first["failed"]
    counts = {"results": master.rows("master"), "failed": first.rows("failed")}
    paths = {"results": master.path("master"), "failed": first.path("failed"), "summary": first.path("summary")}
    if counts["failed"] == 0 or retry_pages is None:
        # post-process after the first pass when nothing failed (or when no
        # second capture is given to retry with)
        combined, still_failed = master["master"].drop(P.LINK_KEY), failed
    else:
        todo = J.retry_jobs(failed).select("job_idx", "latitude", "longitude", "keyword")
        rext = P.extract_listings(retry_pages, todo, radius_m, layout=layout, path=f"{out_dir}/extraction_retry")
        combined = P.retry_merge(master, rext.listings)
        retried = steps.write_step({"still_failed": rext.failed}, f"{out_dir}/pass2")
        still_failed = retried["still_failed"]
        counts["still_failed"], paths["still_failed"] = retried.rows("still_failed"), retried.path("still_failed")
    listings, amenities = P.postprocess(combined)
    done = io.write_results(listings, amenities, f"{out_dir}/listings", fmt="parquet")
    paths |= {"listings": done.path("listings"), "amenities": done.path("listings_amenities")}
    counts |= {"listings": done.rows("listings"), "amenities": done.rows("listings_amenities")}
    return PagesResult(done["listings"], done["listings_amenities"], still_failed, counts, paths)


def job_chunks(jobs: DataFrame, n: int = K.NUM_CHUNKS) -> DataFrame:
    """Jobs tagged with their contiguous chunk (for handing work to n collectors)."""
    return balanced_chunks(jobs, n, ["job_idx"])


def run_totals(jobs: DataFrame, listings: DataFrame, failed: DataFrame,
               n: int = K.NUM_CHUNKS) -> DataFrame:
    """Per-chunk totals of a pass: jobs, extracted rows and failed jobs per
    contiguous job chunk (the counts the original logged per worker chunk).
    Rows and failures are pre-aggregated per job before meeting the chunk map."""
    chunks = job_chunks(jobs.select("job_idx"), n)
    rows = listings.groupBy("job_idx").agg(F.count(F.lit(1)).alias("_rows"))
    fails = failed.select("job_idx").distinct().withColumn("_failed", F.lit(1))
    per_job = chunks.join(rows, "job_idx", "left").join(fails, "job_idx", "left")
    return (per_job.groupBy("chunk")
            .agg(F.count(F.lit(1)).alias("jobs"),
                 F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("rows"),
                 F.coalesce(F.sum("_failed"), F.lit(0)).cast("bigint").alias("failed"))
            .orderBy("chunk"))
