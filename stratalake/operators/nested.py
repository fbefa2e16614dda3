"""Arrays and structs: taking them apart, and folding rows into them.

A folded array is one value in one row, so it is as long as its group; the folds that promise distinct values
drop copies before the exchange. Where a key may have more rows than one value can hold, use the folds in parts: rows
are numbered along their key and folded by key and chunk (:func:`stratalake.operators.ordered.chunk_groups`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions.keys import as_columns, named
from stratalake.functions.text import blank_to_null
from stratalake.functions.types import nullable
from stratalake.operators.ordered import HOT_ROWS, chunk_groups


def explode_flatten(df: DataFrame, array: str, fields: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """One row per element, with the listed struct fields as columns; rows with an empty array disappear."""
    names = dict(fields) if isinstance(fields, Mapping) else {f: f for f in fields}
    rest = [c for c in df.columns if c != array]
    return df.select(*as_columns(rest), F.explode(named(array)).alias("_e")).select(
        *as_columns(rest), *[F.col("_e").getField(f).alias(n) for f, n in names.items()]
    )


def explode_entities(df: DataFrame, array: str) -> DataFrame:
    """One row per element with every field as a column, whatever characters its name holds."""
    return df.select(F.explode(named(array)).alias("_e")).select("_e.*")


def collect_structs(df: DataFrame, keys: Sequence[str], fields: Mapping[str, str], name: str) -> DataFrame:
    """All rows of a key as an array of structs, sorted by the fields."""
    item = F.struct(*[named(c).alias(n) for c, n in fields.items()])
    return df.groupBy(*as_columns(keys)).agg(F.sort_array(F.collect_list(item)).alias(name))


def collect_distinct_structs(df: DataFrame, keys: Sequence[str], fields: Mapping[str, str], name: str) -> DataFrame:
    """Distinct rows of a key as an array of structs, sorted by the fields."""
    picked = df.select(*as_columns(keys), *[named(c).alias(f"_f{i}") for i, c in enumerate(fields)]).distinct()
    item = F.struct(*[F.col(f"_f{i}").alias(n) for i, n in enumerate(fields.values())])
    return picked.groupBy(*as_columns(keys)).agg(F.sort_array(F.collect_list(item)).alias(name))


def attach_array(df: DataFrame, arrays: DataFrame, keys: Mapping[str, str], name: str) -> DataFrame:
    """Left join an array per key; a missing one is the empty array."""
    side = arrays.select(*[named(k).alias(f"_k{i}") for i, k in enumerate(keys.values())], named(name).alias("_arr"))
    cond = None
    for i, own in enumerate(keys):
        c = named(own) == F.col(f"_k{i}")
        cond = c if cond is None else cond & c
    out = df.join(side, cond, "left").withColumn(name, F.coalesce("_arr", F.array().cast(nullable(arrays.schema[name].dataType))))
    return out.drop("_arr", *[f"_k{i}" for i in range(len(keys))])


def collect_sorted(df: DataFrame, keys: Sequence[str], col: str, name: str) -> DataFrame:
    """Sorted distinct values of a key; nulls are left out."""
    return df.groupBy(*as_columns(keys)).agg(F.array_sort(F.collect_set(named(col))).alias(name))


def collect_into(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Replace a scalar by the sorted list of its values per key; the other columns stay, once per state."""
    lists = df.groupBy(*as_columns(keys)).agg(F.array_sort(F.collect_list(named(col))).alias(col))
    return df.drop(col).distinct().join(lists, list(keys))


def join_distinct(df: DataFrame, keys: Sequence[str], col: str, name: str, sep: str = ", ") -> DataFrame:
    """Sorted distinct values that hold text, joined into one string."""
    value = blank_to_null(F.trim(named(col).cast("string")))
    return df.groupBy(*as_columns(keys)).agg(F.concat_ws(sep, F.array_sort(F.collect_set(value))).alias(name))


def collect_over(df: DataFrame, keys: Sequence[str], cols: Mapping[str, str]) -> DataFrame:
    """One row per key with the sorted list of every listed column.

    The lists belong to the key, so they are made once per key. Repeating them on every row of the key would
    write a hot key's lists as often as it has rows.
    """
    aggs = [F.array_sort(F.collect_list(named(c))).alias(a) for c, a in cols.items()]
    return df.groupBy(*as_columns(keys)).agg(*aggs)


def collect_over_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Mapping[str, str], size: int, chunk: str = "chunk", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Every row with the sorted list of every listed column over the rows of its key.

    A list holds at most ``size`` values: the rows of a key are numbered in chunks of so many along ``order``, which
    must name a row of a key, and a row gets the lists of its chunk. A key of up to ``size`` rows has one chunk, so its
    rows get the lists of the key.
    """
    numbered = chunk_groups(df, keys, order, size, chunk, hot_rows)
    over = Window.partitionBy(*as_columns(keys), named(chunk))
    return numbered.withColumns({a: F.array_sort(F.collect_list(named(c)).over(over)) for c, a in cols.items()})


def first_seen(df: DataFrame, keys: Sequence[str], ts: str, name: str) -> DataFrame:
    return df.groupBy(*as_columns(keys)).agg(F.min(named(ts)).alias(name))


def collapse(df: DataFrame, ts: str) -> DataFrame:
    """One row per distinct state, with the first time it was delivered."""
    rest = [c for c in df.columns if c != ts]
    return df.groupBy(*as_columns(rest)).agg(F.min(named(ts)).alias(ts))


def max_or(df: DataFrame, col: str, default: Column, name: str) -> DataFrame:
    """One row: the greatest value, or the default for an empty table."""
    return df.agg(F.coalesce(F.max(named(col)), default).alias(name))


def action_counts(df: DataFrame, action: str, actions: Sequence[str]) -> DataFrame:
    """One row with the number of rows of every action, in one pass."""
    return df.agg(*[F.count_if(named(action) == a).alias(a) for a in actions])


def pivot_counts(df: DataFrame, keys: Sequence[str], label: str, values: Sequence[str]) -> DataFrame:
    """Rows per key and label, labels across. Giving the labels saves the pass that would look for them."""
    return df.groupBy(*as_columns(keys)).pivot(label, list(values)).agg(F.count(F.lit(1)))


def rows_json(df: DataFrame, keys: Sequence[str], fields: Sequence[str], name: str) -> DataFrame:
    """All rows of a key as one JSON array text, sorted by the fields."""
    item = F.struct(*as_columns(fields))
    return df.groupBy(*as_columns(keys)).agg(F.to_json(F.sort_array(F.collect_list(item))).alias(name))


def rows_json_parts(
    df: DataFrame, keys: Sequence[str], fields: Sequence[str], name: str, size: int, part: str = "part", parts: str = "parts", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """All rows of a key as JSON array texts of at most ``size`` rows each, numbered from 1 in the order of the fields.

    The texts of a key, one after the other, hold what :func:`rows_json` puts in one; ``parts`` says how many there are.
    A null key is a key like any other.
    """
    numbered = chunk_groups(df.select(*as_columns([*keys, *fields])), keys, fields, size, "_chunk", hot_rows)
    texts = rows_json(numbered, [*keys, "_chunk"], fields, name)
    counts = df.groupBy(*[named(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.ceil(F.count(F.lit(1)) / size).alias("_parts"))
    same = reduce(lambda a, b: a & b, [named(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return texts.join(counts, same).select(*as_columns(keys), (F.col("_chunk") + 1).alias(part), F.col("_parts").alias(parts), named(name))


def collect_structs_parts(
    df: DataFrame, keys: Sequence[str], fields: Mapping[str, str], name: str, size: int, part: str = "part", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """:func:`collect_structs` in numbered arrays of at most ``size`` structs."""
    numbered = chunk_groups(df.select(*as_columns(list(dict.fromkeys([*keys, *fields])))), keys, list(fields), size, "_chunk", hot_rows)
    out = collect_structs(numbered, [*keys, "_chunk"], fields, name)
    return out.select(*as_columns(keys), (F.col("_chunk") + 1).alias(part), named(name))


def collect_into_parts(df: DataFrame, keys: Sequence[str], col: str, size: int, part: str = "part", hot_rows: int = HOT_ROWS) -> DataFrame:
    """:func:`collect_into` with numbered lists of at most ``size`` values; a state of a key comes with each of its lists."""
    numbered = chunk_groups(df.select(*as_columns([*keys, col])), keys, [col], size, "_chunk", hot_rows)
    lists = numbered.groupBy(*as_columns(keys), "_chunk").agg(F.array_sort(F.collect_list(named(col))).alias(col))
    lists = lists.select(*as_columns(keys), (F.col("_chunk") + 1).alias(part), named(col))
    return df.drop(col).distinct().join(lists, list(keys))


def fold(df: DataFrame, keys: Sequence[str], nested: Sequence[str], name: str) -> DataFrame:
    """Flat rows into one record per key with its distinct nested records."""
    return collect_distinct_structs(df, keys, {c: c for c in nested}, name)


def changed_rows(pairs: Mapping[str, str], df: DataFrame, name: str) -> DataFrame:
    """One row: in how many rows any of the before/after pairs differ; null equals null."""
    differs = None
    for before, after in pairs.items():
        d = ~named(before).eqNullSafe(named(after))
        differs = d if differs is None else differs | d
    return df.agg(F.count_if(F.lit(False) if differs is None else differs).alias(name))
