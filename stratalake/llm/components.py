"""Connected components of a large graph by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import remove, stage


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest node of its neighbourhood."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (longs ``u``, ``v``); the root is the smallest node reachable.

    A node's neighbours are only ever reduced to a minimum and joined to it, which adaptive execution splits
    where one node has many. Each round is a table in the shared folder; the one before is removed. Self-links
    and repeated links are allowed, an empty table gives an empty result.
    """
    spark = edges.sparkSession
    start = edges.select(F.col("u").cast("long"), F.col("v").cast("long")).filter("u <> v")
    now, path = stage(start.distinct(), "links")
    seen = None
    while True:
        after, after_path = stage(_small(_large(now)).filter("u <> v").distinct(), "links")
        remove(spark, path)
        now, path = after, after_path
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen:
            break
        seen = state
    # Every remaining link now goes from a node to its root.
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
