"""Registered queries: one per operator / pipeline key, over the driver tables.

Every query reads whole driver tables (or tables Spark derives from them, see
``sources.testdata``) so its work grows with the scale factor.  Array columns
are flattened with ``array_join`` where a query returns them, so results
compare as plain values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingkit import constants as K
from listingkit import schemas
from listingkit.functions import fields, geo
from listingkit.functions.text import clean_text, normalize_key
from listingkit.operators import areas as A
from listingkit.operators import jobs as J
from listingkit.operators import lattice as L
from listingkit.operators import ordering as O
from listingkit.operators.pages import page_anchors as _page_anchors
from listingkit.operators.pages import page_titles as _page_titles
from listingkit.operators.pages import result_anchors as _result_anchors
from listingkit.plans import grid as G
from listingkit.plans import workflow as WF
from listingkit.plans import listings as P
from listingkit.sources import io, steps
from listingkit.sources import testdata as td

RADIUS_M = float(K.DEFAULT_RADIUS_M)
SPACING_M = K.DEFAULT_RADIUS_M * K.LATTICE_SPACING_FACTOR
SELECTED_AREA = "Asunción"
N_CHUNKS = K.NUM_CHUNKS
#: Grid points that a task makes jobs of, about; jobs of a landed file, at most.
POINTS_PER_PART, JOBS_PER_FILE = 10_000, 50_000
#: Projected vertices are rounded to the millimetre here, so that engines agree.
VERTEX_DECIMALS = 3

Query = Callable[[SparkSession, str], DataFrame]


# ------------------------------------------------------------------ shared inputs

def _jobs(spark, d):
    """The job table, landed once: joins then plan with its measured size.

    The points are few bytes, so that one task may read them all: they are dealt
    out in ranges before each becomes many jobs."""
    path = td.derived_path(spark, d, "jobs", td.GRID_SQL)

    def jobs():
        points = td.grid_points(spark, d)
        parts = -(-points.count() // POINTS_PER_PART) or 1
        return J.generate_jobs(points.repartitionByRange(parts, "point_idx"), K.KEYWORDS)
    return td.land(jobs, spark, path, JOBS_PER_FILE)


def _cards(spark, d, which="pass1"):
    return td.card_fields(spark, d, which)


def _extracted(spark, d, name, pages, jobs, **options):
    """The extraction table of a pass, written once: pages are parsed once, and
    listings, failures and summaries read what they need of it."""
    path = td.derived_path(spark, d, f"extraction-{name}")
    step = steps.read_step(spark, path)
    if step is not None:
        return P.Extraction(step["anchors"], jobs, path)
    return P.extract_listings(pages, jobs, RADIUS_M, path=path, **options)


def _extraction(spark, d):
    return _extracted(spark, d, "pass1", td.landed_pages(spark, d), _jobs(spark, d))


def _retry_extraction(spark, d):
    """The retry pass: its pages meet the failed jobs only."""
    todo = J.retry_jobs(_extraction(spark, d).failed).select("job_idx", "latitude", "longitude", "keyword")
    return _extracted(spark, d, "retry", td.landed_pages(spark, d, "retry"), todo)


def _flat(df: DataFrame) -> DataFrame:
    """Raw listing with its amenity array joined into one text."""
    return df.withColumn("amenities", F.array_join("amenities", "|"))


def _pass1(spark, d):
    """Pass-1 listings, from the extraction table."""
    return _extraction(spark, d).listings


def _retry_listings(spark, d):
    return _retry_extraction(spark, d).listings


def _master(spark, d):
    """The merged results with their ids, committed once by link (the hand-off
    between merge and post-processing)."""
    path = td.derived_path(spark, d, "master")
    return steps.read_step(spark, path) or P.write_master(P.merge_results(_pass1(spark, d)), path)


def _merged(spark, d):
    return _master(spark, d)["master"].drop(P.LINK_KEY)


# ------------------------------------------------------------------ B: projections

def q_coerce_numeric(spark, d):
    c = _cards(spark, d)
    return c.select("page_id", "pos",
                    fields.coerce_double(F.regexp_extract("rating_text", "^[0-9.]*", 0))
                    .alias("rating_num"),
                    fields.coerce_double("rating_text").alias("rating_bad"))


def q_link_coords(spark, d):
    c = _cards(spark, d)
    lat, lon = fields.link_coords("link")
    return c.select("page_id", "pos", lat.alias("lat"), lon.alias("lon"))


def q_place_id(spark, d):
    return _cards(spark, d).select("page_id", "pos", fields.place_id("link").alias("prop_id"))


def _rating_input():
    return (F.when(F.col("rating_kind") == 2, F.col("rating_text"))
            .when(F.col("rating_kind") == 1, F.lit("")))


def q_rating_split(spark, d):
    value, count = fields.rating_split(_rating_input())
    return _cards(spark, d).select("page_id", "pos", value.alias("rating"),
                                   count.alias("num_rating"))


def q_price_choice(spark, d):
    c = _cards(spark, d)
    label = F.when(F.col("price_kind") == 0, F.lit("Moderado"))
    spans = (F.when(F.col("price_kind") == 0, F.array(F.lit("·"), F.lit("₲₲")))
             .when(F.col("price_kind") == 1, F.array(F.lit("·"), F.col("price_text")))
             .otherwise(F.array().cast("array<string>")))
    return c.select("page_id", "pos", fields.price_choice(label, spans).alias("price"))


def q_category_clean(spark, d):
    return _cards(spark, d).select("page_id", "pos",
                                   fields.category_clean("category_raw").alias("category"))


def q_address_clean(spark, d):
    spans = F.when(F.col("addr_kind") == 1,
                   F.array("category_raw", F.concat(F.lit("· "), F.col("address_text")))
                   ).otherwise(F.array("category_raw"))
    return _cards(spark, d).select("page_id", "pos", fields.address_clean(spans).alias("address"))


def q_haversine(spark, d):
    c = _cards(spark, d)
    j = _jobs(spark, d).select("job_idx", F.col("latitude").alias("jlat"),
                               F.col("longitude").alias("jlon"))
    # no broadcast: the files of the jobs are a small part of what they take in memory
    return c.join(j.hint("merge"), "job_idx").select(
        "page_id", "pos",
        F.round(geo.haversine("jlat", "jlon", "latitude", "longitude"), 3).alias("dist_m"))


def q_request_url(spark, d):
    return J.with_request_url(_jobs(spark, d), K.DEFAULT_RADIUS_M).select("job_idx", "url")


def q_normalize_key(spark, d):
    return td.text_rows(spark, d).select("doc_id", normalize_key("text").alias("key"))


def q_clean_text(spark, d):
    return td.text_rows(spark, d).select("doc_id", clean_text("text").alias("cleaned"))


# ------------------------------------------------------------------ jobs, filters, joins

def q_generate_jobs(spark, d):
    return J.generate_jobs(td.grid_points(spark, d), K.KEYWORDS)


def q_grid_jobs(spark, d):
    """Lattice of the chosen area x keywords."""
    grid, _city = G.build_grid(_areas(spark, d), SELECTED_AREA, "name", SPACING_M, vertex_decimals=VERTEX_DECIMALS)
    # the write finds out whether there are points: the lattice runs once
    return G.make_jobs(grid, out_path=td.derived_path(spark, d, "grid-jobs"), if_exists="overwrite")


def q_run_totals(spark, d):
    return WF.run_totals(_jobs(spark, d), _pass1(spark, d), _extraction(spark, d).failed, N_CHUNKS)


def q_balanced_chunks(spark, d):
    return O.balanced_chunks(_jobs(spark, d), N_CHUNKS, ["job_idx"]).select("job_idx", "chunk")


def q_radius_filter(spark, d):
    c = _cards(spark, d).select("job_idx", "page_id", "pos", F.col("link").alias("href"))
    kept = J.radius_filter(J.anchors_with_distance(c, _jobs(spark, d)), RADIUS_M)
    return kept.select("job_idx", "page_id", "pos", F.round("dist_m", 3).alias("dist_m"))


def q_failed_jobs(spark, d):
    return _extraction(spark, d).failed


def q_retry_jobs(spark, d):
    return J.retry_jobs(_extraction(spark, d).failed).select(
        "job_idx", "latitude", "longitude", "keyword")


def q_job_summary(spark, d):
    return _extraction(spark, d).summary()


# ------------------------------------------------------------------ pages

def q_page_anchors(spark, d):
    return _page_anchors(td.headed_pages(spark, d)).select("page_id", "pos", "href", "label")


def q_card_anchors(spark, d):
    """Result anchors of the derived pages, by the scan inside the JVM."""
    return _result_anchors(td.landed_pages(spark, d)).select("page_id", "pos", "href", "label")


def q_page_titles(spark, d):
    t = _page_titles(td.table(spark, d, "pages").select("page_id", "html"))
    return t.select("page_id", clean_text("title").alias("title"), clean_text("h1").alias("h1"))


def q_extract_listings(spark, d):
    return _flat(_extraction(spark, d).listings)


def q_custom_layout(spark, d):
    """Pages of a second layout, whose rules are handed in as data."""
    ext = _extracted(spark, d, "list", td.list_pages(spark, d), _jobs(spark, d), layout=td.LIST_LAYOUT,
                     clean={"category": F.upper})
    return _flat(ext.listings)


# ------------------------------------------------------------------ merge, ids, post-process

def q_dedupe_keep_first(spark, d):
    return _flat(P.dedupe_keep_first(_pass1(spark, d)))


def q_concat_results(spark, d):
    p1 = _pass1(spark, d).withColumn("src", F.lit(0))
    # the retry pass of the original also carries phone/hours/services columns
    rt = (_retry_listings(spark, d).withColumn("src", F.lit(1))
          .withColumns({c: F.lit(None).cast("string") for c in ("phone", "hours", "services")}))
    both = P.concat_results(p1, rt)
    return both.select("src", "job_idx", "page_id", "pos", "link", "phone")


def q_merge_results(spark, d):
    """The merged table with each row's position in its order."""
    merged = P.merge_results(_pass1(spark, d))
    return _flat(O.assign_ids(merged, P.sorted_order(), "position"))


def q_csv_roundtrip(spark, d):
    """Merged results written as the results CSV, read and parsed again."""
    path = td.derived_path(spark, d, "results-csv")
    back = io.write_results_csv(P.dedupe_keep_first(_pass1(spark, d)), path)
    amenities = P.parse_amenities("amenities", "string")
    return back.withColumn("amenities", F.array_join(amenities, "|"))


def q_dedupe_stats(spark, d):
    return P.dedupe_stats(_pass1(spark, d))


def q_assign_ids(spark, d):
    # the link and what orders the rows: the others are not sorted with them
    merged = P.merge_results(_pass1(spark, d).select("link", "longitude", "latitude", *P.CAPTURE_ORDER))
    return O.assign_ids(merged, P.sorted_order(), "num_id").select("num_id", "link")


def q_postprocess(spark, d):
    listings, _ = P.postprocess(_merged(spark, d))
    return listings


def q_postprocess_idempotent(spark, d):
    once, _ = P.postprocess(_merged(spark, d))
    twice, _ = P.postprocess(once)
    return twice


def q_amenities_explode(spark, d):
    _, amenities = P.postprocess(_merged(spark, d))
    return amenities


def q_amenities_parse(spark, d):
    lit = td.amenity_literals(spark, d)
    arr = P.parse_amenities("amenities", "string")
    return lit.select("row_id", F.size(arr).cast("bigint").alias("n"),
                      F.array_join(arr, "|").alias("joined"))


def q_retry_merge(spark, d):
    merged = P.retry_merge(_master(spark, d), _retry_listings(spark, d))
    listings, _ = P.postprocess(merged)
    return listings


# ------------------------------------------------------------------ sources and sinks

def q_sink_roundtrip(spark, d):
    """Listings and amenities committed together, then read as a pair.

    Before they are read, a second run writes another table beside them and
    stops, and a third one is told to keep what is there: neither shows."""
    path = td.derived_path(spark, d, "sink")
    listings, amenities = P.postprocess(_merged(spark, d))
    io.write_results(listings, amenities, path, fmt="parquet")
    listings.limit(1).write.mode("overwrite").parquet(f"{path}/{steps.RUNS}/stopped/listings")
    steps.write_step({"listings": listings.limit(0)}, path, if_exists="keep")
    done = steps.read_step(spark, path)
    per_place = done["listings_amenities"].groupBy("prop_id").agg(F.count("*").alias("n"))
    return (done["listings"].join(per_place, "prop_id", "left")
            .select("num_id", "prop_id", "link", F.coalesce("n", F.lit(0)).alias("n_amenities"),
                    F.lit(done.rows("listings")).cast("bigint").alias("rows_written")))


def q_failure_sink(spark, d):
    """The failure table as its sink leaves it, with the count the write took."""
    path = td.derived_path(spark, d, "failures")
    n = io.write_failures(_extraction(spark, d).failed, path, fmt="parquet")
    return io.read_table(spark, path, fmt="parquet").select("job_idx", "keyword", F.lit(n).cast("bigint").alias("n_failed"))


def q_csv_quarantine(spark, d):
    """A CSV with rows that do not fit: the good rows, typed, and the rejects."""
    read = io.read_csv_checked(spark, td.csv_folder(spark, d), schemas.JOBS, required=("keyword",))
    good = read.good.select("*", F.lit(None).cast("string").alias("record"), F.lit(None).cast("string").alias("reason"))
    return good.unionByName(read.rejects, allowMissingColumns=True)


def q_cleaned_boundaries(spark, d):
    """Boundaries read, checked and cleaned, persisted, and labelled by the
    column that the label rule picks."""
    path = td.derived_path(spark, d, "areas-cleaned")
    cleaned = G.clean_areas(_areas(spark, d), col=A.guess_name_column(["area_ord", "area_name", "area_code"]), out_path=path)
    label = A.label_column(cleaned.columns)
    corners = F.aggregate(F.flatten("polygons"), F.lit(0), lambda n, ring: n + F.size(ring))
    return cleaned.select("area_ord", F.lit(label).alias("label_column"), F.col(label).alias("label"),
                          F.size("polygons").cast("bigint").alias("n_polygons"), corners.cast("bigint").alias("n_corners"))


# ------------------------------------------------------------------ areas and grid

def _areas(spark, d):
    return td.landed_areas(spark, d)


def q_canonical_names(spark, d):
    return G.clean_areas(_areas(spark, d)).select("area_ord", "area_name", "cleaned_name")


def q_area_select(spark, d):
    return A.select_areas(_areas(spark, d), SELECTED_AREA, "name", "area_name").select(
        "area_ord", "area_code", "area_name")


def q_area_listing(spark, d):
    return A.area_listing(_areas(spark, d), "area_name", "area_code")


def q_distinct_names(spark, d):
    return A.distinct_names(_areas(spark, d), "area_name")


def q_project_forward(spark, d):
    v = td.area_vertices(spark, d)
    x, y = geo.project_forward("lon", "lat")
    return v.select(F.col("area_ord").cast("int").alias("area_ord"), "poly_idx", "ring_idx",
                    "v_idx", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


def q_project_inverse(spark, d):
    g = td.grid_points(spark, d)
    x, y = geo.project_forward("longitude", "latitude")
    g = g.select("point_idx", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))
    g = geo.with_inverse(g, "x", "y", "_lon", "_lat")
    return g.select("point_idx", F.round("_lat", 7).alias("lat"), F.round("_lon", 7).alias("lon"))


def q_area_bounds(spark, d):
    rings = L.project_rings(_areas(spark, d), ["area_code"], VERTEX_DECIMALS)
    b = L.group_bounds(rings, ["area_code"], SPACING_M)
    return b.select("area_code", "minx", "maxx", "miny", "maxy", "nx", "ny")


def q_lattice(spark, d):
    rings = L.project_rings(_areas(spark, d), ["area_ord"], VERTEX_DECIMALS)
    b = L.group_bounds(rings, ["area_ord"], SPACING_M)
    cells = L.bare_lattice(b, ["area_ord"])
    return cells.select("area_ord", "point_idx", F.round("x", 3).alias("x"),
                        F.round("y", 3).alias("y"))


def q_point_in_polygon(spark, d):
    """Every bounding-box lattice cell of each boundary row, flagged inside/outside."""
    grp = ["area_ord"]
    rings = L.project_rings(_areas(spark, d), grp, VERTEX_DECIMALS)
    b = L.group_bounds(rings, grp, SPACING_M)
    inside = L.inside_points(L.row_crossings(L.ring_edges(rings, grp), b, grp), grp).select(
        *grp, (F.col("i") * F.col("_box.ny") + F.col("j")).alias("point_idx"), F.lit(True).alias("inside"))
    cells = L.bare_lattice(b, grp).select(*grp, "point_idx")
    return cells.join(inside, [*grp, "point_idx"], "left").select(
        *grp, "point_idx", F.coalesce("inside", F.lit(False)).alias("inside"))


def q_lattice_in_area(spark, d):
    return G.grid_by_area(_areas(spark, d), SPACING_M, "area_code", VERTEX_DECIMALS)


def q_build_grid(spark, d):
    grid, city = G.build_grid(_areas(spark, d), SELECTED_AREA, "name", SPACING_M, vertex_decimals=VERTEX_DECIMALS)
    return grid.withColumn("city", F.lit(city))


QUERIES: dict[str, Query] = {
    "coerce_numeric": q_coerce_numeric,
    "normalize_key": q_normalize_key,
    "clean_text": q_clean_text,
    "link_coords": q_link_coords,
    "place_id": q_place_id,
    "rating_split": q_rating_split,
    "price_choice": q_price_choice,
    "category_clean": q_category_clean,
    "address_clean": q_address_clean,
    "haversine": q_haversine,
    "request_url": q_request_url,
    "postprocess_idempotent": q_postprocess_idempotent,
    "area_select": q_area_select,
    "radius_filter": q_radius_filter,
    "retry_jobs": q_retry_jobs,
    "point_in_polygon": q_point_in_polygon,
    "generate_jobs": q_generate_jobs,
    "canonical_names": q_canonical_names,
    "failed_jobs": q_failed_jobs,
    "lattice_in_area": q_lattice_in_area,
    "area_listing": q_area_listing,
    "distinct_names": q_distinct_names,
    "area_bounds": q_area_bounds,
    "job_summary": q_job_summary,
    "dedupe_stats": q_dedupe_stats,
    "dedupe_keep_first": q_dedupe_keep_first,
    "assign_ids": q_assign_ids,
    "balanced_chunks": q_balanced_chunks,
    "concat_results": q_concat_results,
    "retry_merge": q_retry_merge,
    "project_forward": q_project_forward,
    "project_inverse": q_project_inverse,
    "lattice": q_lattice,
    "build_grid": q_build_grid,
    "amenities_parse": q_amenities_parse,
    "amenities_explode": q_amenities_explode,
    "page_anchors": q_page_anchors,
    "extract_listings": q_extract_listings,
    "page_titles": q_page_titles,
    "merge_results": q_merge_results,
    "postprocess": q_postprocess,
    "grid_jobs": q_grid_jobs,
    "run_totals": q_run_totals,
    "card_anchors": q_card_anchors,
    "csv_roundtrip": q_csv_roundtrip,
    "custom_layout": q_custom_layout,
    "sink_roundtrip": q_sink_roundtrip,
    "failure_sink": q_failure_sink,
    "csv_quarantine": q_csv_quarantine,
    "cleaned_boundaries": q_cleaned_boundaries,
}

#: Landed inputs that several queries read, in the order they build on each other.
PREPARE: dict[str, Query] = {
    "jobs": _jobs,
    "pages": td.landed_pages,
    "retry_pages": lambda spark, d: td.landed_pages(spark, d, "retry"),
    "list_pages": td.list_pages,
    "areas": _areas,
    "extraction": lambda spark, d: _extraction(spark, d).table,
    "retry_extraction": lambda spark, d: _retry_extraction(spark, d).table,
    "list_extraction": q_custom_layout,
    "master": _merged,
}
