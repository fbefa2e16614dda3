"""Join shapes of the layered model.

No side is forced to broadcast: sizes are only known at run time, so the choice is left to adaptive execution,
which also splits a hot key of the big side. Dimensions are reduced to one row per key first, so no join can
multiply rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.keys import as_columns, named
from stratalake.operators.latest import latest_load, latest_per_key


def _on(left: Sequence[Column], right: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, [x == y for x, y in zip(left, right)])


def enrich(df: DataFrame, dim: DataFrame, on: Mapping[str, str], take: Mapping[str, str]) -> DataFrame:
    """Left join to a table with unique keys. ``on``: own column -> key; ``take``: source column -> new name."""
    side = dim.select(
        *[named(k).alias(f"_k{i}") for i, k in enumerate(on.values())],
        *[named(c).alias(n) for c, n in take.items()],
    )
    cond = _on(as_columns(list(on)), [F.col(f"_k{i}") for i in range(len(on))])
    return df.join(side, cond, "left").drop(*[f"_k{i}" for i in range(len(on))])


def enrich_star(
    df: DataFrame, dims: Sequence[tuple[DataFrame, Mapping[str, str], Mapping[str, str]]]
) -> DataFrame:
    """Left joins to several prepared dimensions, one after the other."""
    return reduce(lambda out, d: enrich(out, *d), dims, df)


def enrich_cast(
    df: DataFrame, other: DataFrame, on: Sequence[tuple[str, str, str]], take: Mapping[str, str]
) -> DataFrame:
    """Left join on a composite key whose parts are first brought to one type; a part that does not fit is null."""
    typed = other.select(
        *[named(b).try_cast(t).alias(f"_k{i}") for i, (_, b, t) in enumerate(on)],
        *[named(c).alias(n) for c, n in take.items()],
    )
    cond = _on([named(a).try_cast(t) for a, _, t in on], [F.col(f"_k{i}") for i in range(len(on))])
    return df.join(typed, cond, "left").drop(*[f"_k{i}" for i in range(len(on))])


def enrich_roles(df: DataFrame, dim: DataFrame, key: str, roles: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Join one dimension once per role. ``roles``: own foreign key -> columns to take under role names."""
    return reduce(lambda out, r: enrich(out, dim, {r[0]: key}, r[1]), roles.items(), df)


def flag_exists(
    df: DataFrame, keys: DataFrame, on: Mapping[str, str], name: str, yes: object = "1", no: object = "0"
) -> DataFrame:
    """Literal that tells whether the key occurs in another table."""
    side = keys.select(*[named(k).alias(f"_k{i}") for i, k in enumerate(on.values())]).distinct()
    cond = _on(as_columns(list(on)), [F.col(f"_k{i}") for i in range(len(on))])
    found = F.col("_k0").isNotNull()
    out = df.drop(name).join(side, cond, "left").withColumn(name, F.when(found, F.lit(yes)).otherwise(F.lit(no)))
    return out.drop(*[f"_k{i}" for i in range(len(on))])


def _half_join(df: DataFrame, other: DataFrame, on: Mapping[str, str], how: str) -> DataFrame:
    side = other.select(*[named(k).alias(f"_k{i}") for i, k in enumerate(on.values())])
    return df.join(side, _on(as_columns(list(on)), [F.col(f"_k{i}") for i in range(len(on))]), how)


def without(df: DataFrame, other: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows whose key does not occur in the other table; rows with a null key stay."""
    return _half_join(df, other, on, "left_anti")


def within(df: DataFrame, other: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows whose key occurs in the other table."""
    return _half_join(df, other, on, "left_semi")


def without_from(a: DataFrame, b: DataFrame, key: str, a_time: str, b_time: str) -> DataFrame:
    """Drop rows of ``a`` from the moment their key is first seen in ``b``.

    Only the first time per key matters, so ``b`` shrinks to one row per key and the range test is a filter on
    an equi-join instead of a join over all pairs.
    """
    first = b.groupBy(named(key).alias("_k")).agg(F.min(named(b_time)).alias("_first"))
    joined = a.join(first, named(key) == F.col("_k"), "left")
    keep = F.col("_first").isNull() | named(a_time).isNull() | (named(a_time) < F.col("_first"))
    return joined.filter(keep).drop("_k", "_first")


def attach_constants(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a table that has at most one row; a second row is an error, no row gives nulls.

    The row is a scalar subquery, which Spark fills in as a literal: no join, and a second row fails the query.
    """
    packed = one_row.select(F.struct(*as_columns(one_row.columns)).alias("_row")).scalar()
    return df.withColumn("_row", packed).select(*as_columns(df.columns), "_row.*")


def attach_scalar(df: DataFrame, one_row: DataFrame, col: str, name: str) -> DataFrame:
    """Add one value of a table with at most one row."""
    return df.withColumn(name, one_row.select(named(col)).scalar())


def join_latest(
    base: DataFrame,
    sources: Mapping[str, tuple[DataFrame, Mapping[str, str], Mapping[str, str]]],
    latest_by: Sequence[str] | None = None,
) -> DataFrame:
    """Left joins to many sources, each first reduced to its newest row per key: the row set cannot grow."""
    out = base
    for df, on, take in sources.values():
        keys = list(on.values())
        newest = latest_per_key(df, keys, latest_by) if latest_by else latest_load(df, keys)
        out = enrich(out, newest, on, take)
    return out


def mark_listed(df: DataFrame, refs: DataFrame, on: Mapping[str, str], name: str) -> DataFrame:
    """Row set unchanged, plus whether the key is in a list."""
    return flag_exists(df, refs, on, name, True, False)


def with_calendar(df: DataFrame, calendar: DataFrame, date_col: str, calendar_col: str) -> DataFrame:
    """Full join to a calendar: every date appears, and so does every row."""
    return df.join(calendar, named(date_col) == named(calendar_col), "full")


def reattach(base: DataFrame, computed: Mapping[str, Column]) -> DataFrame:
    """Computed columns are set in place; the row they belong to is never left, so nothing is joined back."""
    return base.withColumns(dict(computed))


def reconcile(df: DataFrame, raw: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Take the listed columns back from a raw table, by key. A key that occurs twice in raw fails the query.

    Unique keys on the raw side are what keeps the row count, so that is what is checked, while joining.
    """
    packed = F.struct(*as_columns(cols))
    ambiguous = F.raise_error(F.lit("reconcile: the key is not unique in the raw table"))
    side = (
        raw.groupBy(*[named(k).alias(f"_k{i}") for i, k in enumerate(keys)])
        .agg(F.count(F.lit(1)).alias("_n"), F.first(packed).alias("_raw"))
        .withColumn("_raw", F.when(F.col("_n") == 1, F.col("_raw")).otherwise(ambiguous))
    )
    cond = reduce(lambda a, b: a & b, [named(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    found = F.col("_raw").isNotNull()
    restored = {c: F.when(found, F.col("_raw").getField(c)).otherwise(named(c)) for c in cols}
    out = df.join(side, cond, "left").withColumns(restored)
    return out.select(*as_columns(df.columns))
