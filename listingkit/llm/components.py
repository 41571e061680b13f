"""Connected components of a large edge table, as a Spark job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingkit.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node reachable over the edges (a, b).

    Each round links every node's neighbours to the smallest of them and
    itself (first the larger neighbours, then the smaller ones), which shortens
    all paths and keeps connectivity; the tables keep the size of the edge
    table, and rounds grow with the logarithm of the longest path.  No node's
    neighbours are gathered: only minima are aggregated and joined back.  Each
    half of a round is written, so that plans stay small: a star reads its
    pairs twice, and what is not written would be planned twice as well."""
    def star(pairs: DataFrame, larger: bool) -> DataFrame:
        low = pairs.groupBy("u").agg(F.min("v").alias("m"))
        low = low.withColumn("m", F.least("u", "m"))
        joined = pairs.join(low, "u")
        if larger:
            moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            moved = joined.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                  F.col("m").alias("v"))
        return moved.where("u <> v").distinct()

    def mark(pairs: DataFrame):
        return pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    now = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .where("u <> v").distinct(), "links")
    seen = mark(now)                                  # links that are stars already need no second round
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        now = written(star(written(star(both, True), "larger"), False), "smaller")
        found = mark(now)
        if found == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = found
