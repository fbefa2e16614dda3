"""Latest-record selection and duplicate removal.

Every selection is total: ties are broken by the columns the caller names. ``row_number() = 1`` is cut down
to one row per key inside each map task before the exchange, so a key with a third of all rows costs one row
per task, not one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions.contract import ACTIVE
from stratalake.functions.keys import as_columns, named

# Order that decides between loads of the same record, newest first.
LOAD_ORDER = ("expected_from", "modified_datetime", "ingested_datetime", "file_id")


def newest_first(cols: Sequence[str]) -> list[Column]:
    return [named(c).desc() for c in cols]


def exact_distinct(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given order; null keys form a key of their own."""
    w = Window.partitionBy(*as_columns(keys)).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The row of every key with the greatest ``by`` columns."""
    return first_per_key(df, keys, newest_first(by))


def latest_load(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest load of every key; load columns a source does not carry are left out of the order."""
    return latest_per_key(df, keys, [c for c in LOAD_ORDER if c in df.columns])


def distinct_on(df: DataFrame, subset: Sequence[str], keep_by: Sequence[str]) -> DataFrame:
    """One row per value of ``subset``: the smallest ``keep_by``, where a plain drop would keep any row."""
    return first_per_key(df, subset, as_columns(keep_by))


def latest_snapshot(df: DataFrame, load_col: str) -> DataFrame:
    """Rows of the newest load. The maximum is a scalar subquery: one aggregate, no join."""
    return df.filter(named(load_col) == df.agg(F.max(named(load_col))).scalar())


def latest_with_ties(df: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """All rows that share the greatest ``by`` of their key.

    A maximum per key and an equi-join rather than a rank: when most rows of a hot key tie, the join can be
    split by row while a window cannot.
    """
    top = df.groupBy(*as_columns(keys)).agg(F.max(named(by)).alias("_top"))
    top = top.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    cond = [named(k).eqNullSafe(named(f"_k_{k}")) for k in keys] + [named(by) == F.col("_top")]
    return df.join(top, reduce(lambda a, b: a & b, cond), "left_semi")


def active_or_latest(df: DataFrame, keys: Sequence[str], by: Sequence[str], active: str = "IsActive") -> DataFrame:
    """Where the table carries an active flag the flag decides; otherwise the newest row of every key."""
    if active in df.columns:
        return df.filter(named(active) == ACTIVE)
    present = [c for c in by if c in df.columns]
    return latest_per_key(df, keys, present) if present else df.dropDuplicates(list(keys))


def by_source_priority(sources: Mapping[int, DataFrame], keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Union of sources; per key the source with the lowest priority number wins, then the newest row."""
    tagged = [df.withColumn("_priority", F.lit(p)) for p, df in sources.items()]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return first_per_key(both, keys, [F.col("_priority"), *newest_first(by)]).drop("_priority")
