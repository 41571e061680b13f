"""Listing pipelines: extract (P4), merge (P5), post-process (P6), retry (P7).

Capture order is the column triple ``(job_idx, page_id, pos)``: jobs run in
``job_idx`` order, a job's pages in ``page_id`` order and a page's anchors in
document order.  It is carried from extraction to ``num_id`` so results never
depend on file or partition order.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingkit import schemas
from listingkit.functions import fields
from listingkit.functions.text import seen_text
from listingkit.operators import jobs as J
from listingkit.operators import ordering as O
from listingkit.operators.layouts import LayoutSpec
from listingkit.operators.pages import parse_result_pages
from listingkit.session import ensure_checkpoint_dir
from listingkit.sources import steps

CAPTURE_ORDER = ["job_idx", "page_id", "pos"]


def sorted_order() -> list[Column]:
    """Total order of a merged result table (the F2 sort plus capture ties)."""
    return [F.col("longitude").asc_nulls_last(), F.col("latitude").asc_nulls_last(),
            *[F.col(c).asc() for c in CAPTURE_ORDER]]


@dataclass
class Extraction:
    """What one parse of the pages gave: a written table with a row for every
    result anchor, split by ``kind`` (see ``jobs.anchor_kind``).  Listings read
    one kind's folder; failures and summaries read two columns."""
    table: DataFrame         # RAW_LISTINGS columns and kind
    jobs: DataFrame
    path: str

    @property
    def listings(self) -> DataFrame:
        return self.table.where(F.col("kind") == "listing").select(schemas.RAW_LISTINGS.fieldNames())

    @property
    def failed(self) -> DataFrame:
        return J.failed_jobs(self.jobs, self.table)

    def summary(self) -> DataFrame:
        return J.job_summary(self.jobs, self.table)

    def discard(self) -> None:
        """Removes the table, where nothing will read it again."""
        steps.remove(self.table.sparkSession, self.path)


def extract_listings(pages: DataFrame, jobs: DataFrame, radius_m: float = 1000,
                     missing_rating: str = "drop", layout: str | LayoutSpec = "loc1",
                     clean: Mapping[str, Callable[[Column], Column]] | None = None,
                     path: str | None = None) -> Extraction:
    """Captured result pages -> listing rows within each job's radius, failed jobs,
    per-job counts: all from one parse.

    The parse runs where the pages lie and emits small rows; only these meet
    their jobs (equi-join) and the radius test.  They are written once, at
    ``path`` (default: a folder of their own in the shared folder), split by
    kind; HTML is read once and a lost executor does not mean parsing again.

    ``missing_rating='drop'`` keeps the original behaviour of losing a card
    without a rating block; ``'null'`` keeps such rows.  ``layout`` is a
    registered name or a ``LayoutSpec``; ``clean`` holds further functions for
    listing columns, applied after the standard rules.
    """
    if missing_rating not in ("drop", "null"):
        raise ValueError("missing_rating must be 'drop' or 'null'")
    whole = F.col("has_card") & F.col("has_rating") if missing_rating == "drop" else F.col("has_card")
    standard = {
        "name": seen_text(F.col("name")),
        "rating": F.when(F.col("has_rating"), seen_text(F.col("rating"))),
        "price": fields.price_choice("price_label", "price_spans"),
        "category": fields.category_clean("category_raw"),
        "address": fields.address_clean("address_spans"),
        "amenities": F.transform("amenities", seen_text)}
    # the standard rules leave less of a card than its parse: they go before the join
    cards = parse_result_pages(pages, layout).select(
        "job_idx", "page_id", "pos", "href", *[v.alias(c) for c, v in standard.items()],
        whole.alias("_whole"), (F.col("has_card") | F.col("card_error")).alias("_carded"))
    anchors = J.anchors_with_distance(cards, jobs, late=True)
    kind = J.anchor_kind(F.col("_whole"), F.col("_carded"), radius_m)
    values = {c: F.col(c) for c in ("job_idx", "page_id", "pos", "latitude", "longitude", "keyword", *standard)}
    values |= {"link": F.col("href")}
    for column, function in (clean or {}).items():
        if column not in values:
            raise ValueError(f"no listing column {column!r}; columns: {sorted(values)}")
        values[column] = function(values[column])
    rows = anchors.withColumn("kind", kind).select(
        *[values[f].alias(f) for f in schemas.RAW_LISTINGS.fieldNames()], "kind")
    path = path or f"{ensure_checkpoint_dir(pages.sparkSession)}/extraction-{uuid.uuid4().hex}"
    step = steps.write_step({"anchors": rows}, path, partition_by={"anchors": "kind"})
    return Extraction(step["anchors"], jobs, path)


def concat_results(*parts: DataFrame) -> DataFrame:
    """Bag union by column name; columns missing from a part become null."""
    if not parts:
        raise ValueError("nothing to concatenate")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def dedupe_keep_first(df: DataFrame, order: list | None = None) -> DataFrame:
    """One row per ``link``: the first in capture order (null links form one group)."""
    return O.keep_first(df, "link", order or CAPTURE_ORDER)


def merge_results(*parts: DataFrame) -> DataFrame:
    """Concat -> keep-first on link -> sort by longitude, latitude (nulls last)."""
    deduped = dedupe_keep_first(concat_results(*parts))
    return O.sort_results(deduped, CAPTURE_ORDER)


def dedupe_stats(*parts: DataFrame) -> DataFrame:
    """Rows before / after the keep-first and how many were removed (one row)."""
    merged = concat_results(*parts)
    # after = distinct links, with all null links counting as one value
    stats = merged.agg(F.count(F.lit(1)).alias("rows_before"),
                       (F.count_distinct("link")
                        + F.max(F.col("link").isNull().cast("int"))).alias("rows_after"))
    return stats.select("rows_before", F.coalesce("rows_after", F.lit(0)).cast("bigint")
                        .alias("rows_after"),
                        (F.col("rows_before") - F.coalesce("rows_after", F.lit(0)))
                        .cast("bigint").alias("removed"))


def parse_amenities(c: Column | str, dtype: str) -> Column:
    """Amenity list column: native arrays pass through; CSV text ``['a', "b'c"]``
    is parsed strictly (malformed text fails the job); null/'' -> []."""
    c = F.col(c) if isinstance(c, str) else c
    empty = F.array().cast("array<string>")
    if dtype.startswith("array"):
        return F.coalesce(c, empty)
    parsed = F.from_json(c, "array<string>",
                         {"allowSingleQuotes": "true", "mode": "FAILFAST"})
    return F.when(c.isNull() | (F.trim(c) == ""), empty).otherwise(parsed)


def amenities_literal(c: Column | str) -> Column:
    """Amenity array as the list literal of the results CSV, which
    ``parse_amenities`` reads back: ``["a", "b"]``; null stays null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNotNull(), F.to_json(c))


def explode_amenities(df: DataFrame, id_col: str = "prop_id") -> DataFrame:
    """One row per non-blank amenity (value kept untrimmed); no dedupe."""
    return (df.select(id_col, F.explode("amenities").alias("amenity"))
              .where(F.col("amenity").isNotNull() & F.col("amenity").rlike(f"[^{_ws()}]")))


def _ws() -> str:
    return fields.PY_SPACE[1:-1]


def postprocess(results: DataFrame, order: list | None = None,
                ids: bool = True) -> tuple[DataFrame, DataFrame]:
    """Ids, place id, rating split, amenity table, final column order.

    Each derived column is added only when absent, so running it twice gives
    the same listings.  ``order`` is the total order ids follow (default: the
    merged-result sort); ``ids=False`` leaves them out.
    """
    df = results
    cols = set(df.columns)
    if "prop_id" not in cols:
        df = df.withColumn("prop_id", fields.place_id("link"))
    if "num_rating" not in cols:
        value, count = fields.rating_split("rating")
        df = df.withColumns({"rating": value, "num_rating": count})
    amenities = None
    if "amenities" in cols:              # needs no ids, so it is taken before they are
        df = df.withColumn("amenities", parse_amenities("amenities",
                                                        dict(results.dtypes)["amenities"]))
        amenities = explode_amenities(df)
        df = df.drop("amenities")
    if "num_id" not in cols and ids:
        df = O.assign_ids(df, order or sorted_order(), "num_id")
    if all(c in df.columns for c in schemas.LISTING_COLUMNS):
        df = df.select(*schemas.LISTING_COLUMNS)
    if amenities is None:
        amenities = df.sparkSession.createDataFrame([], schemas.AMENITIES)
    return df, amenities


#: The name a master's link is hashed and sorted under; null links are one key.
LINK_KEY = "_link_key"


def link_key(link: Column | str = "link") -> Column:
    """A link as a join key: null is a key of its own, unlike any link."""
    link = F.col(link) if isinstance(link, str) else link
    return F.coalesce(F.concat(F.lit("="), link), F.lit(""))


def write_master(merged: DataFrame, path: str, buckets: int = 32, id_col: str = "num_id") -> steps.Step:
    """Commits a merged table (one row per link) with its dense ids, hashed and
    sorted by link, so that later passes meet it where it lies.  The table in
    order, which the ids are read off, is removed."""
    spark = merged.sparkSession
    aside = f"{ensure_checkpoint_dir(spark)}/sorted-{uuid.uuid4().hex}"
    numbered = O.assign_ids(merged, sorted_order(), id_col, path=aside).withColumn(LINK_KEY, link_key())
    step = steps.write_step({"master": numbered}, path, buckets={"master": (LINK_KEY, buckets)})
    steps.remove(spark, aside)
    return step


def new_links(master: DataFrame, retry: DataFrame) -> DataFrame:
    """The first retry row, in capture order, of every link the master lacks.

    The master is read by its link alone and, if it was written by
    ``write_master``, not exchanged: retry rows move to its buckets."""
    first = dedupe_keep_first(retry).withColumn(LINK_KEY, link_key())
    known = master if LINK_KEY in master.columns else master.withColumn(LINK_KEY, link_key())
    return first.hint("merge").join(known.select(LINK_KEY).hint("merge"), LINK_KEY, "left_anti").drop(LINK_KEY)


def retry_merge(master: steps.Step, retry: DataFrame, id_col: str = "num_id") -> DataFrame:
    """Master rows first, in their order, then retry rows in capture order;
    keep-first on link, so a master row wins; not re-sorted.

    Master rows keep their ids; new rows are numbered after them.  Nothing of
    the master moves; the retry pass, which only holds failed jobs, is what is
    shuffled and sorted."""
    table = master["master"]
    fresh = O.assign_ids(new_links(table, retry), CAPTURE_ORDER, id_col, start=master.rows("master") + 1)
    return table.drop(LINK_KEY).unionByName(fresh, allowMissingColumns=True)
