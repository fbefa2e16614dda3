"""Set operations on whole frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_aligned(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union of two sources with the same columns, matched by name so that column order cannot mix values."""
    return a.unionByName(b)


def union_padded(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union by name; a column one side lacks is null there."""
    return a.unionByName(b, allowMissingColumns=True)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union that keeps rows both sources deliver."""
    return a.unionByName(b)


def affected_keys(new: DataFrame, changed: DataFrame) -> DataFrame:
    """Keys that are new or changed, once each."""
    return new.unionByName(changed).distinct()


def multiset_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows that occur more often on one side, with the number of surplus copies.

    One union and one aggregate answer both directions: a copy counts +1 or -1 and equal rows cancel in the
    map-side combine already.
    """
    if sorted(expected.dtypes) != sorted(actual.dtypes):
        raise ValueError(f"schemas differ: {sorted(set(expected.dtypes) ^ set(actual.dtypes))}")
    votes = expected.withColumn("_v", F.lit(1)).unionByName(actual.withColumn("_v", F.lit(-1)))
    net = votes.groupBy(*[F.col(f"`{c}`") for c in expected.columns]).agg(F.sum("_v").alias("_net"))
    side = F.when(F.col("_net") > 0, F.lit("missing")).otherwise(F.lit("unexpected"))
    return net.filter("_net <> 0").withColumns({"side": side, "copies": F.abs("_net")}).drop("_net")
