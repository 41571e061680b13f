"""Area tables: name repair, listing, selection."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingkit import constants as K
from listingkit.functions.text import normalize_key, normalize_key_distinct


def pick_column(columns: Sequence[str], pattern: str, default: str) -> str:
    """First column whose name matches ``pattern`` in any case, else ``default``."""
    return next(filter(re.compile(pattern, re.IGNORECASE).search, columns), default)


def guess_name_column(columns: Sequence[str], explicit: str | None = None) -> str:
    """Explicit choice, else a column named like a name or department, else the
    first column."""
    if explicit and explicit not in columns:
        raise ValueError(f"column {explicit!r} not in {list(columns)}")
    return explicit or pick_column(columns, "name|dep", columns[0])


def label_column(columns: Sequence[str], default: str = K.AREA_LABEL_COLUMN) -> str:
    """The cleaned label if there is one, else the default label."""
    return pick_column(columns, "^cleaned", default)


def name_map_frame(spark: SparkSession, clean_names: Mapping[str, str] | DataFrame) -> DataFrame:
    """Name map as a table keyed by the normalised raw name; on a key collision
    the later entry wins.  Takes a mapping, or for maps of any size a table
    (ord, raw_name, clean_name)."""
    if not isinstance(clean_names, DataFrame):
        rows = [(i, raw, clean) for i, (raw, clean) in enumerate(clean_names.items())]
        clean_names = spark.createDataFrame(rows, "ord int, raw_name string, clean_name string")
    return (clean_names.withColumn("_key", normalize_key("raw_name"))
            .groupBy("_key").agg(F.max_by("clean_name", "ord").alias("_mapped")))


def canonical_names(areas: DataFrame, clean_names: Mapping[str, str] | DataFrame,
                    col: str | None = None, out: str = "cleaned_name") -> DataFrame:
    """Add ``cleaned_name``: the mapped spelling when the normalised name is a
    map key, else the original; null stays null."""
    name_col = guess_name_column(areas.columns, col)
    mp = name_map_frame(areas.sparkSession, clean_names)
    keyed = normalize_key_distinct(areas, name_col, "_key")
    joined = keyed.join(mp, "_key", "left")          # AQE broadcasts a map that measures small
    return (joined.withColumn(out, F.when(F.col(name_col).isNull(), F.lit(None))
                              .otherwise(F.coalesce(F.col("_mapped"), F.col(name_col))))
                  .drop("_key", "_mapped"))


def distinct_names(areas: DataFrame, col: str) -> DataFrame:
    """Non-null distinct values, ascending."""
    return areas.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def area_listing(areas: DataFrame, label: str, code: str) -> DataFrame:
    """Distinct (label, code) pairs, geometry dropped."""
    return areas.select(label, code).distinct()


def matching_areas(areas: DataFrame, value: str, by: str = "name",
                   label: str | None = None, code: str = "area_code") -> DataFrame:
    """Rows whose normalised label (``by='name'``) or code matches ``value``."""
    label = label or label_column(areas.columns, "area_name")
    col = label if by == "name" else code
    keyed = normalize_key_distinct(areas.withColumn("_sel", F.col(col).cast("string")),
                                   "_sel", "_sel_key")
    return keyed.where(F.col("_sel_key") == normalize_key(F.lit(value))).drop("_sel", "_sel_key")


def some_areas(found: DataFrame, value: str) -> DataFrame:
    """``found``, or ``ValueError`` when it is empty."""
    if found.isEmpty():
        raise ValueError(f"no area matching {value!r}")
    return found


def select_areas(areas: DataFrame, value: str, by: str = "name",
                 label: str | None = None, code: str = "area_code") -> DataFrame:
    """``matching_areas``; raises ``ValueError`` when nothing matches."""
    return some_areas(matching_areas(areas, value, by, label, code), value)


def first_label(selected: DataFrame, label: str, order_col: str = "area_ord") -> str:
    """Label of the first selected row in input order (the run's city name)."""
    return selected.agg(F.min_by(label, order_col)).first()[0]
