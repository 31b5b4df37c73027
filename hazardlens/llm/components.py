"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlens.llm.staging import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is hung to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are hung to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    hung = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.where("a > b").unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` for every node of an edge that is not the smallest of its component.

    ``component`` is the smallest node that can be reached; a node that is missing from
    the result is its own. The number of rounds grows with the logarithm of the longest
    chain; each round is written to the shared folder. Null ends and loops are left
    out, repeated edges count once, no edges give an empty result.
    """
    now = staged(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct())
    mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    while mark[0]:
        now = staged(_small_star(_large_star(now)))
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
