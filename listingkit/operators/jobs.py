"""Search jobs: generation, coordinate checks, radius filter, failures, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingkit.functions import fields, geo


def valid_coords(lat: Column | str, lon: Column | str) -> Column:
    """Both coordinates present and not NaN (Spark orders NaN above +inf, so a
    NaN distance would otherwise fail every ``<=`` test in a different way than
    Python does)."""
    lat = F.col(lat) if isinstance(lat, str) else lat
    lon = F.col(lon) if isinstance(lon, str) else lon
    return lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)


def coerce_grid(grid: DataFrame) -> DataFrame:
    """Grid table with numeric coordinates; unparseable text becomes null."""
    return grid.withColumns({
        "latitude": fields.coerce_double(F.col("latitude").cast("string"))
        if dict(grid.dtypes)["latitude"] == "string" else F.col("latitude").cast("double"),
        "longitude": fields.coerce_double(F.col("longitude").cast("string"))
        if dict(grid.dtypes)["longitude"] == "string" else F.col("longitude").cast("double"),
    })


def generate_jobs(grid: DataFrame, keywords: Sequence[str],
                  point_col: str = "point_idx") -> DataFrame:
    """Every grid point x every keyword (points outer, keywords inner).

    The keyword list is a fixed parameter, so the fan-out is a generator over
    a literal array (no join at all); ``job_idx = point_idx * n_kw + kw_idx``
    keeps the original job order without a global row number.
    """
    kws = list(keywords)
    if not kws:
        raise ValueError("keyword list is empty")
    n = len(kws)
    g = coerce_grid(grid)
    exploded = g.select(point_col, "latitude", "longitude",
                        F.posexplode(F.array(*[F.lit(k) for k in kws])).alias("kw_idx", "keyword"))
    return exploded.select(
        (F.col(point_col).cast("bigint") * F.lit(n) + F.col("kw_idx")).alias("job_idx"),
        "latitude", "longitude", "keyword")


def with_request_url(jobs: DataFrame, radius_m: int) -> DataFrame:
    """Search URL of every job; null without coordinates."""
    url = fields.request_url("keyword", "latitude", "longitude", radius_m)
    return jobs.withColumn("url", F.when(valid_coords("latitude", "longitude"), url))


def retry_jobs(failed: DataFrame) -> DataFrame:
    """Failed jobs worth retrying: both coordinates present (keyword unchecked)."""
    return failed.where(valid_coords("latitude", "longitude"))


def anchors_with_distance(anchors: DataFrame, jobs: DataFrame, late: bool = False) -> DataFrame:
    """Join result anchors to their own job and measure the distance.

    ``anchors`` carries ``job_idx`` and ``href``.  The job is the loop variable
    of the capture, so this is an equi-join on ``job_idx``: a sort-merge join,
    whose skewed jobs AQE splits.  The job table is never broadcast by the size
    of its files, which are a small part of what its rows take in memory.

    With ``late``, the coordinates are read off the link after the join, and not
    shuffled beside it; a filter by distance would read them again.
    """
    lat, lon = fields.link_coords("href")
    coords = {"latitude": lat, "longitude": lon}
    a = anchors if late else anchors.withColumns(coords)
    j = jobs.select("job_idx", F.col("latitude").alias("job_lat"),
                    F.col("longitude").alias("job_lon"), "keyword")
    joined = a.join(j.hint("merge"), "job_idx")
    joined = joined.withColumns(coords) if late else joined
    ok = valid_coords("job_lat", "job_lon") & valid_coords("latitude", "longitude")
    return joined.withColumn(
        "dist_m", F.when(ok, geo.haversine("job_lat", "job_lon", "latitude", "longitude")))


def radius_filter(with_dist: DataFrame, radius_m: float) -> DataFrame:
    """Keep anchors within ``radius_m`` (inclusive); rows without coordinates drop."""
    return with_dist.where(F.col("dist_m").isNotNull() & (F.col("dist_m") <= F.lit(float(radius_m))))


def failed_jobs(jobs: DataFrame, anchors: DataFrame, reason: str = "no results") -> DataFrame:
    """Jobs without a single result anchor (a job whose anchors all fall outside
    the radius is *not* failed)."""
    hit = anchors.select("job_idx").distinct()
    return (jobs.join(hit, "job_idx", "left_anti")
                .select("job_idx", "latitude", "longitude", "keyword",
                        F.lit(reason).alias("reason")))


#: What can become of a result anchor.
KINDS = ("listing", "broken", "bare", "far", "nowhere")


def anchor_kind(complete: Column, has_card: Column, radius_m: float) -> Column:
    """``nowhere``: no distance to the job; ``far``: beyond the radius; within it
    ``listing``: a complete card, ``broken``: a card that is not, ``bare``: none."""
    dist = F.col("dist_m")
    return (F.when(dist.isNull(), F.lit("nowhere")).when(dist > F.lit(float(radius_m)), F.lit("far"))
            .when(complete, F.lit("listing")).when(has_card, F.lit("broken")).otherwise(F.lit("bare")))


def job_summary(jobs: DataFrame, anchors: DataFrame) -> DataFrame:
    """Per job: anchors found, anchors without coordinates, outside / within the
    radius, accepted listings, cards within the radius that lack what the layout
    requires, whether the job yielded none, and whether it failed (no anchors at
    all).  ``anchors`` has ``job_idx`` and ``kind``; it is pre-aggregated per job
    before the join back, so a hot job never moves as raw rows."""
    kind = F.col("kind")
    counts = {"anchors": F.count(F.lit(1)), "no_coords": F.count_if(kind == "nowhere"),
              "outside_radius": F.count_if(kind == "far"), "within_radius": F.count_if(kind.isin("listing", "broken", "bare")),
              "accepted": F.count_if(kind == "listing"), "card_errors": F.count_if(kind == "broken")}
    per_job = anchors.groupBy("job_idx").agg(*(c.alias(n) for n, c in counts.items()))
    out = jobs.select("job_idx", "keyword").join(per_job, "job_idx", "left")
    return out.select(
        "job_idx", "keyword", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in counts],
        (F.coalesce("accepted", F.lit(0)) == 0).alias("no_results"),
        F.col("anchors").isNull().alias("failed"))
