"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listingkit.session import ensure_checkpoint_dir, ship_package

#: A word: a run of characters other than ASCII white space.  ``bytes.split()``
#: without argument cuts UTF-8 text at exactly the same places.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Driver table by name, and the package made importable on executors."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise once in the reliable checkpoint folder and cut the lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """``cut`` as a Parquet table in the shared folder: columns that repeat shrink."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def fold_held_out(doc_id: Column, folds: int, held: int) -> Column:
    """True where crc32 of the id's decimal text leaves ``held`` modulo ``folds``.

    A null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == held, F.lit(False))


def word_count(text: Column) -> Column:
    """Number of words; 0 for null.  Native: one regex pass."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(seed: str, *cols: Column) -> Column:
    """Pseudorandom double in [0, 1) of the columns."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11) / F.lit(float(1 << 53)))


#: Parts of the last level that ``most_frequent`` fills by hash.
HASH_PARTS = 4096


def most_frequent(counts: DataFrame, n: str, keep: int, word: str = "word") -> DataFrame:
    """The ``keep`` rows with the greatest counts (all, if there are fewer).

    Counts compare by level, 32 to a doubling; the last level, which does not fit
    whole, is filled up in order of a hash of the word.  Only histograms - of
    levels, and of hashes in the last level - reach the driver."""
    level = F.floor(F.log2(F.col(n).cast("double")) * 32)
    sizes = counts.groupBy(level.alias("level")).agg(F.count("*").alias("c")).collect()    # under 2000 rows
    room, last = keep, None
    for r in sorted(sizes, key=lambda r: -r.level):
        if r.c > room:
            last = r.level
            break
        room -= r.c
    if last is None:
        return counts
    above = counts.where(level > last)
    if not room:
        return above
    part = F.pmod(F.xxhash64(word), F.lit(HASH_PARTS))
    edge = counts.where(level == last)
    shares = {r.part: r.c for r in edge.groupBy(part.alias("part")).agg(F.count("*").alias("c")).collect()}
    full = 0
    while shares.get(full, 0) <= room:
        room -= shares.get(full, 0)
        full += 1
    rest = edge.where(part == full).orderBy(F.xxhash64(word), word).limit(room)            # of one part
    return above.unionByName(edge.where(part < full)).unionByName(rest)
