"""Committed outputs: all tables of a step become visible together.

A step is a folder.  Tables are written aside, in a run folder of their own;
one manifest then names every table of the run, and replacing the manifest by
a rename is the only switch.  Readers follow the manifest, so they see either
the old tables or the new ones, never a mixture and never half a table; a run
that stopped leaves files that nothing refers to.

Row counts and checks ride on the write itself (``DataFrame.observe``): no
table is read again to count it, and a table that must not be empty is refused
before the switch.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listingkit.session import shuffles_removed

MANIFEST, RUNS = "_manifest.json", "_runs"
MODES = ("keep", "overwrite", "error")


@dataclass(frozen=True)
class StepTable:
    """One committed table: where it lies, how it is read, how many rows it has.

    ``buckets`` (column, number) marks a table that is hashed and sorted by a
    column, which joins on it can use without an exchange."""
    path: str
    fmt: str
    schema: str
    rows: int
    buckets: tuple[str, int] | None = None
    multi_line: bool = False

    def read(self, spark: SparkSession) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(self.schema))
        if self.buckets:
            return spark.table(_declare(spark, self, schema))
        if self.fmt == "csv":
            from listingkit.sources.io import read_table
            return read_table(spark, self.path, schema, multi_line=self.multi_line)
        return spark.read.schema(schema).format(self.fmt).load(self.path)


@dataclass(frozen=True)
class Step:
    """The committed tables of a step."""
    spark: SparkSession
    tables: Mapping[str, StepTable]

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name].read(self.spark)

    def rows(self, name: str) -> int:
        return self.tables[name].rows

    def path(self, name: str) -> str:
        return self.tables[name].path


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    _, p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def is_committed_folder(spark: SparkSession, path: str) -> bool:
    """A plain file, or a folder whose writer finished (``_SUCCESS``)."""
    _, p, fs = _fs(spark, path)
    if not fs.exists(p):
        return False
    return bool(fs.getFileStatus(p).isFile()) or path_exists(spark, f"{path}/_SUCCESS")


def _read_text(spark: SparkSession, path: str) -> str:
    jvm, p, fs = _fs(spark, path)
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file beside ``path`` and renames it over it."""
    aside = f"{path}.{uuid.uuid4().hex}"
    jvm, p, fs = _fs(spark, aside)
    stream = fs.create(p, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), conf).rename(
        p, jvm.org.apache.hadoop.fs.Path(path), options)


def read_step(spark: SparkSession, path: str) -> Step | None:
    """The tables committed at ``path``; None where nothing was committed."""
    if not path_exists(spark, f"{path}/{MANIFEST}"):
        return None
    tables = json.loads(_read_text(spark, f"{path}/{MANIFEST}"))["tables"]
    return Step(spark, {name: StepTable(f"{path}/{t['path']}", t["fmt"], t["schema"], t["rows"],
                                        tuple(t["buckets"]) if t.get("buckets") else None, t.get("multi_line", False))
                        for name, t in tables.items()})


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a step of the caller's own making, all runs of it."""
    _, p, fs = _fs(spark, path)
    fs.delete(p, True)


def _declare(spark: SparkSession, table: StepTable, schema: T.StructType) -> str:
    """Names a bucketed folder in the session's catalog, so that the planner
    knows its buckets; dropping the name leaves the files."""
    column, n = table.buckets
    name = f"listingkit_{uuid.uuid5(uuid.NAMESPACE_URL, table.path).hex}"
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING {table.fmt} CLUSTERED BY (`{column}`) "
                  f"SORTED BY (`{column}`) INTO {n} BUCKETS LOCATION '{table.path}'")
    return name


def _write_bucketed(writer: DataFrameWriter, path: str, fmt: str, column: str, n: int, spark: SparkSession) -> None:
    name = f"listingkit_new_{uuid.uuid4().hex}"
    writer.format(fmt).bucketBy(n, column).sortBy(column).option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")                     # an external table: its files stay


def write_step(tables: Mapping[str, DataFrame], path: str, if_exists: str = "overwrite", fmt: str = "parquet",
               non_empty: tuple[str, ...] = (), buckets: Mapping[str, tuple[str, int]] | None = None,
               partition_by: Mapping[str, str] | None = None, multi_line: bool = False) -> Step:
    """Writes the tables, then makes them the step's committed ones, together.

    ``keep`` uses what is committed already, if anything is; ``error`` refuses
    to replace it; what is there without a manifest counts as not committed.
    Tables named in ``non_empty`` raise ``ValueError`` without rows, and the
    step stays as it was.  ``buckets`` hashes and sorts a table by a column into
    a number of files, ``partition_by`` splits it into folders by a column."""
    if if_exists not in MODES:
        raise ValueError(f"if_exists must be one of {sorted(MODES)}")
    spark = next(iter(tables.values())).sparkSession
    old = read_step(spark, path)
    if old is not None and if_exists == "error":
        raise FileExistsError(f"{path} already holds committed tables")
    if old is not None and if_exists == "keep":
        return old
    run = f"{RUNS}/{uuid.uuid4().hex}"
    entries = {}
    for name, df in tables.items():
        seen = Observation(f"{name}-{uuid.uuid4().hex}")
        place = f"{path}/{run}/{name}"
        bucket = (buckets or {}).get(name)
        if bucket:
            df = df.repartition(bucket[1], bucket[0])
        writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write
        if (partition_by or {}).get(name):
            writer = writer.partitionBy(partition_by[name])
        if fmt == "parquet":
            writer = writer.option("compression", "zstd")
        with shuffles_removed(spark):
            if bucket:
                _write_bucketed(writer, place, fmt, *bucket, spark)
            elif fmt == "csv":
                writer.csv(place, header=True, quote='"', escape='"')
            else:
                writer.format(fmt).save(place)
        rows = int(seen.get.get("rows", 0))
        if name in non_empty and not rows:
            raise ValueError(f"{name} is empty")
        entries[name] = {"path": f"{run}/{name}", "fmt": fmt, "schema": df.schema.json(), "rows": rows,
                         "buckets": list(bucket) if bucket else None, "multi_line": multi_line}
    _replace_text(spark, f"{path}/{MANIFEST}", json.dumps({"tables": entries}))
    return read_step(spark, path)
