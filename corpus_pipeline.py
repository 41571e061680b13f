"""Corpus pipeline: toxic documents go, one document of each near-duplicate
group stays, repeated passages are cut, sources are mixed to target weights,
and what is left is packed into sequences.

STAGES lists (name, function); a function takes (spark, docs, sf_dir), ``docs``
having the columns of ``documents`` (others are dropped), and returns a
DataFrame.  All but the last return the columns of ``documents``.  Between
stages the result is written as Parquet in the shared folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingkit.llm.common import table
from listingkit.llm.jaccard import near_duplicates
from listingkit.llm.mixing import taken_words, whole_copies
from listingkit.llm.packing import pack_documents
from listingkit.llm.sentences import dedup_sentences
from listingkit.llm.toxicity import learn_lexicon, score_toxicity
from listingkit.session import ensure_checkpoint_dir, ship_package

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon does not reject.

    The lexicon is learned from the labelled documents of this stage's input.
    Null and blank texts stay."""
    ship_package(spark)
    lexicon = learn_lexicon(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, lexicon, keep=COLUMNS).where("predicted = 0").select(COLUMNS)


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document (smallest id) of each group of near duplicates.

    Of equal rows (same id and text) one stays; texts without words are linked
    with nothing."""
    ship_package(spark)
    docs = docs.select(COLUMNS)
    first = near_duplicates(docs).where("first").select(
        F.col("doc_id").alias("_id"), F.col("row_key").alias("_key")).distinct()
    rows = docs.withColumn("_row", F.xxhash64("doc_id", "text"))
    kept = rows.join(first, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_row") == F.col("_key")), "left_semi")
    return kept.dropDuplicates(["doc_id", "_row"]).select(COLUMNS)


def sentence_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated passages; n_chars is counted anew.

    A document of which nothing is left goes; blank texts that came in stay."""
    ship_package(spark)
    out = dedup_sentences(docs.select(COLUMNS))
    gone = (F.col("n_removed") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return (out.where(~F.coalesce(gone, F.lit(False)))
            .withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long"))
                        .otherwise(F.col("n_chars"))).select(COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix, as documents: each as often as the mix has it whole (see
    ``whole_copies``).  Documents without words stay once."""
    ship_package(spark)
    docs = docs.select(COLUMNS)
    rows = docs.withColumn("_row", F.xxhash64("doc_id", "text"))
    copies = whole_copies(taken_words(docs)).where("times > 0").select(
        F.col("doc_id").alias("_id"), F.col("row_key").alias("_key"), F.col("source").alias("_source"), "times")
    same = (F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_row") == F.col("_key"))
            & F.col("source").eqNullSafe(F.col("_source")))
    return rows.join(copies, same).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("times")))).select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences."""
    ship_package(spark)
    return pack_documents(docs.select(COLUMNS))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicate_groups),
    ("sentence_dedup", sentence_spans),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

#: Learned lexicons, connected components, hashed draws and byte pair encoding
#: have no SQL; tests hold the first three stages' documents against plain versions,
#: the mix against its targets and the packing against its limits.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
