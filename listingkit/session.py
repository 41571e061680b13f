"""Session helpers.

The library never creates a session behind the caller's back; ``get_spark``
is a convenience for scripts and tests.  Lineage cuts use reliable
checkpoints in the directory the cluster names in ``spark.checkpoint.dir``;
only when that is unset *and* Spark runs in local mode do we pick a scratch
directory of our own.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_spark(cpus: int | str = "*", shuffle_partitions: int = 8,
              app: str = "listingkit") -> SparkSession:
    """Local session tuned for tests and the bench (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LISTINGKIT_DRIVER_MEM", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting it only if unset.

    Order: an already-set context dir; the session/cluster setting
    ``spark.checkpoint.dir``; and, on a single machine only, a fresh scratch
    directory.  On a cluster without the setting we refuse rather than write
    lineage cuts to a machine-local folder.
    """
    sc = spark.sparkContext
    shared = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: configure a shared (HDFS/S3/...) "
                "folder for lineage cuts")
        shared = tempfile.mkdtemp(prefix="listingkit-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared)
    return sc.getCheckpointDir()


#: Spark setting: a query's shuffle files go when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes inside remove their shuffle files as they end.  Otherwise those of
    all steps before lie there until the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``listingkit`` importable in executor Python workers.

    The package is zipped once per driver process and added with
    ``addPyFile`` (Spark distributes it to every executor), so Arrow UDFs
    and ``mapInArrow`` functions that live in the package resolve on any
    cluster and from any working directory.
    """
    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    sc.addPyFile(_package_zip())
    _SHIPPED.add(key)


_ZIP: list[str] = []


def _package_zip() -> str:
    if _ZIP:
        return _ZIP[0]
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    path = os.path.join(tempfile.mkdtemp(prefix="listingkit-pkg-"), "listingkit.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _dirs, files in os.walk(pkg):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    _ZIP.append(path)
    return path
