"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modlens.session import checkpoint_dir


def _kept(df: DataFrame) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root`` (the least node of its component) for every node of an edge that joins two nodes.

    Each round hangs every node's larger neighbours, then its smaller ones, under its least neighbour, until
    every component is one star.  The least neighbour is an aggregate joined back, so a node with very many
    edges is split by adaptive execution; rounds grow with the logarithm of the number of nodes.  Every round
    is a checkpoint.
    """
    now = _kept(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    )
    before = None
    while True:
        size = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.hash("u", "v").cast("long")).alias("h")).first()
        if size == before or size["n"] == 0:
            break
        before = size
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        now = _kept(small.where("u <> v").distinct())
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
