"""Table sources and sinks (CSV interchange, Parquet/JSON boundaries).

CSV files written by pandas double embedded quotes, so reads use
``escape='"'``.  Line feeds inside quoted values need ``multi_line``, which
makes every file one task; without it large files are split.
The text ``NA`` stays text (no pandas-style null sentinels).

Sinks commit through ``sources.steps``: readers see whole tables only.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listingkit import schemas
from listingkit.sources import steps


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               fmt: str = "csv", multi_line: bool = False) -> DataFrame:
    """Read a committed table (``write_table``), a CSV (header, RFC-4180 quoting)
    or any other Spark format.  Malformed CSV rows keep what can be read of them;
    ``read_csv_checked`` tells them apart."""
    step = steps.read_step(spark, path) if steps.path_exists(spark, path) else None
    if step is not None:
        return step["table"]
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        return reader.csv(path, header=True, quote='"', escape='"', multiLine=multi_line,
                          nullValue="", emptyValue="", mode="PERMISSIVE")
    return reader.format(fmt).load(path)


@dataclass
class CheckedRead:
    good: DataFrame          # the schema's columns
    rejects: DataFrame       # record, reason


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType, required: tuple[str, ...] = (),
                     quarantine: str | None = None, multi_line: bool = False) -> CheckedRead:
    """CSV rows that fit the schema, and the others with the reason they do not.

    A row is rejected if it has too few or too many fields, if a value cannot be
    read as its column's type, or if a ``required`` column is null; the first
    that applies, columns from the left, is its reason.  ``record`` is the line
    as it stands in the file (for required columns: the row as CSV).

    The file is parsed once: what was read is landed (in ``quarantine``, or the
    shared folder), split into good rows and rejects, and both are read from
    there."""
    from listingkit.session import ensure_checkpoint_dir
    names = schema.fieldNames()
    as_read = T.StructType([*schema.fields, T.StructField("_record", T.StringType())])
    options = dict(quote='"', escape='"', nullValue="", emptyValue="")
    rows = spark.read.schema(as_read).csv(
        path, header=True, multiLine=multi_line, mode="PERMISSIVE", columnNameOfCorruptRecord="_record",
        enforceSchema=True, **options).select(*names, "_record")
    # without quoted parts, separators are what counts the fields
    bare = F.regexp_replace("_record", '"(?:[^"]|"")*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    texts = F.from_csv(F.col("_record"), ", ".join(f"`{n}` string" for n in names), options)
    reason = F.when(F.col("_record").isNull(), _missing([F.col(n) for n in names], names, required))
    reason = reason.when(fields < len(names), F.lit("too few fields")).when(fields > len(names), F.lit("too many fields"))
    for f in schema.fields:
        if not isinstance(f.dataType, T.StringType):
            bad = texts[f.name].isNotNull() & (texts[f.name] != "") & texts[f.name].try_cast(f.dataType).isNull()
            reason = reason.when(bad, F.lit(f"not a {f.dataType.simpleString()}: {f.name}"))
    reason = reason.otherwise(F.lit("malformed"))
    out = rows.withColumns({"_reason": reason, "_kind": F.when(reason.isNull(), F.lit("good")).otherwise(F.lit("reject"))})
    place = quarantine or f"{ensure_checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    landed = steps.write_step({"rows": out}, place, partition_by={"rows": "_kind"})["rows"]
    text = F.coalesce("_record", F.to_csv(F.struct(*names), {"quote": '"', "escape": '"'}))
    return CheckedRead(landed.where("_kind = 'good'").select(names),
                       landed.where("_kind = 'reject'").select(text.alias("record"), F.col("_reason").alias("reason")))


def _missing(values: list[Column], names: list[str], required: tuple[str, ...]) -> Column:
    """Reason of the first required column that is null, else null."""
    return F.coalesce(F.lit(None).cast("string"), *(
        F.when(v.isNull(), F.lit(f"no {n}")) for v, n in zip(values, names) if n in required))


def require(df: DataFrame, cols: list[str] | set[str] | tuple[str, ...] = (),
            non_empty: bool = True, what: str = "table") -> DataFrame:
    """Raise ``ValueError`` when required columns are missing or the table is empty.

    Emptiness is looked up, which computes a plan up to its first row; steps
    that write the table anyway leave it to ``write_step(non_empty=...)``."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what} must contain columns {sorted(cols)}; missing {missing}")
    if non_empty and df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def asserted(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """The rows, each checked by the job that reads them: a rule that is not true
    for a row fails that job with the rule's name."""
    checks = [F.when(~F.coalesce(rule, F.lit(False)), F.raise_error(F.lit(name)).cast("boolean")).otherwise(F.lit(True))
              for name, rule in rules.items()]
    checked = df
    for check in checks:
        checked = checked.where(check)
    return checked


def read_boundaries(spark: SparkSession, path: str, fmt: str = "parquet", max_lat: float = 90.0) -> DataFrame:
    """Boundary table: (area_ord, area_code, area_name, polygons nested rings).

    Columns are read by name and must have the schema's types.  A job that reads
    a row without polygons, a polygon without rings, a ring of under three
    corners, or a corner without finite degrees fails with what is wrong.  A
    ring may repeat its first corner at the end; the repetition is dropped, so
    that open and closed rings are the same.  ``max_lat`` is the largest latitude
    either way; tables laid out on a plane beyond the poles name a larger one."""
    if fmt == "json":
        rows = spark.read.schema(schemas.AREAS).json(path)
    else:
        rows = read_table(spark, path, fmt=fmt)
        have, want = dict(rows.dtypes), {f.name: f.dataType.simpleString() for f in schemas.AREAS}
        wrong = {n: have.get(n) for n, t in want.items() if have.get(n) != t}
        if wrong:
            raise ValueError(f"boundary columns {wrong} must be {({n: want[n] for n in wrong})}")
        rows = rows.select(*want)

    def opened(ring: Column) -> Column:
        closed = (F.size(ring) > 1) & (F.element_at(ring, 1) == F.element_at(ring, -1))
        return F.when(closed, F.slice(ring, F.lit(1), F.size(ring) - 1)).otherwise(ring)

    def finite(v: Column) -> Column:
        return (v["lon"].between(-180.0, 180.0) & v["lat"].between(-float(max_lat), float(max_lat)))

    p = F.col("polygons")
    rules = {"a boundary has no polygons": F.size(p) > 0,
             "a polygon has no rings": F.forall(p, lambda poly: F.size(poly) > 0),
             "a ring has fewer than three corners": F.forall(p, lambda poly: F.forall(poly, lambda r: F.size(opened(r)) > 2)),
             "a corner has no finite degrees": F.forall(p, lambda poly: F.forall(poly, lambda r: F.forall(
                 r, lambda v: F.coalesce(finite(v), F.lit(False)))))}
    checked = asserted(rows, rules)
    return checked.withColumn("polygons", F.transform(p, lambda poly: F.transform(poly, opened)))


def write_table(df: DataFrame, path: str, if_exists: str = "keep", fmt: str = "csv",
                multi_line: bool = False, non_empty: bool = False) -> DataFrame:
    """Write ``df`` as the committed table at ``path``; 'keep' leaves a table that
    is there and *uses it*.

    Only whole tables are kept: what was committed here, a plain file, or a
    folder that its writer finished.  A folder without either mark is left by a
    writer that stopped, and the table is written anew beside it.  Returns the
    table now at ``path``, so downstream steps see what was persisted, as the
    interactive original did when told not to overwrite an existing file."""
    spark = df.sparkSession
    if if_exists not in steps.MODES:
        raise ValueError(f"if_exists must be one of {sorted(steps.MODES)}")
    if steps.read_step(spark, path) is None and steps.is_committed_folder(spark, path):
        if if_exists == "keep":
            return read_table(spark, path, df.schema if fmt == "csv" else None, fmt, multi_line)
        if if_exists == "error":
            raise FileExistsError(f"{path} exists")
    return steps.write_step({"table": df}, path, if_exists, fmt, ("table",) if non_empty else (),
                            multi_line=multi_line)["table"]


def write_failures(failed: DataFrame, path: str, fmt: str = "csv") -> int:
    """Commit the failure table, an empty one where nothing failed, so that a
    stale one is never read.  Returns the failure count, taken by the write."""
    return steps.write_step({"table": failed}, path, fmt=fmt).rows("table")


def write_results_csv(results: DataFrame, path: str) -> DataFrame:
    """Merged results with their amenities as a CSV, the amenities as a list
    literal; returns the table now at ``path`` (RESULTS_CSV columns)."""
    from listingkit.plans.listings import amenities_literal
    out = results.withColumn("amenities", amenities_literal("amenities")).select(schemas.RESULTS_CSV.fieldNames())
    return write_table(out, path, "overwrite").select(schemas.RESULTS_CSV.fieldNames())


def write_results(listings: DataFrame, amenities: DataFrame, path: str, fmt: str = "csv") -> steps.Step:
    """The two result tables, ``listings`` and ``listings_amenities``, committed
    together: a run that stops between them leaves the earlier pair."""
    return steps.write_step({"listings": listings, "listings_amenities": amenities}, path, fmt=fmt)
