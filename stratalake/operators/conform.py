"""Shape rules: headers, junk columns, types, defaults, lineage. Each call is one projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions import text
from stratalake.functions.contract import ACTIVE
from stratalake.functions.keys import as_columns, json_hash, named
from stratalake.functions.types import nullable


# --- headers -------------------------------------------------------------------------------------


def clean_headers(df: DataFrame) -> DataFrame:
    """Lower snake case headers; names that become equal are all numbered."""
    return df.toDF(*text.number_repeats([text.snake_header(c) for c in df.columns]))


def light_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[text.light_header(c) for c in df.columns])


def number_repeated_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*text.number_repeats(df.columns))


def camel_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[text.camel_header(c) for c in df.columns])


def first_of_repeated(df: DataFrame) -> DataFrame:
    """Keep the first of the columns whose names differ in case only."""
    order: dict[str, int] = {}
    for i, c in enumerate(df.columns):
        order.setdefault(c.lower(), i)
    unique = df.toDF(*[f"_p{i}" for i in range(len(df.columns))])
    return unique.select(*[F.col(f"_p{i}").alias(df.columns[i]) for i in order.values()])


def drop_junk(df: DataFrame, prefixes: Sequence[str] = ("Unnamed", "@odata"), blank: bool = False) -> DataFrame:
    """Drop columns by name prefix and, where asked for, unnamed ones (blank or ``_c<number>``)."""

    def junk(name: str) -> bool:
        if name.startswith(tuple(prefixes)):
            return True
        return blank and (not name.strip() or name.startswith("_c"))

    return df.select(*[named(c) for c in df.columns if not junk(c)])


# --- types ---------------------------------------------------------------------------------------


def relax_arrays(schema: T.StructType) -> T.StructType:
    """Schema with array fields as text, for sources that deliver arrays as text."""
    return T.StructType(
        [
            T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.ArrayType) else f.dataType, f.nullable)
            for f in schema.fields
        ]
    )


def _cast_to(col: Column, have: T.DataType, want: T.DataType) -> Column:
    if have == want:
        return col
    if isinstance(want, T.StringType) and isinstance(have, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(col)
    return col.try_cast(nullable(want))


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the columns a schema declares, names compared without case; values that do not fit become null."""
    want = {f.name.lower(): f.dataType for f in schema.fields}
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = [
        _cast_to(named(c), have[c], want[c.lower()]).alias(c) if c.lower() in want else named(c) for c in df.columns
    ]
    return df.select(*cols)


def align_types(source: DataFrame, target: T.StructType) -> DataFrame:
    """Types of the target where it has the column; own columns stay, columns of the target only are ignored."""
    types = {f.name: nullable(f.dataType) for f in target.fields}
    return source.select(*[named(c).try_cast(types[c]).alias(c) if c in types else named(c) for c in source.columns])


def project_padded(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fixed output order; missing columns are null."""
    return df.select(*[named(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


def declared_first(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Declared columns first, missing ones as null text, then every other column in its own order."""
    extra = [c for c in df.columns if c not in columns]
    return project_padded(df, [*columns, *extra])


def all_text(df: DataFrame, constants: Mapping[str, object] | None = None) -> DataFrame:
    """Every column as text, plus constant columns."""
    added = [F.lit(v).alias(k) for k, v in (constants or {}).items()]
    return df.select(*[named(c).cast("string").alias(c) for c in df.columns], *added)


# --- values --------------------------------------------------------------------------------------


def trim_text(df: DataFrame, lower: Sequence[str] = ()) -> DataFrame:
    """Trim every text column; the listed ones are lower-cased as well."""
    text_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.lower(F.trim(named(c))) if c in lower else F.trim(named(c)) for c in text_cols})


def with_defaults(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Add the columns a source does not carry; present ones are kept as they are."""
    return df.withColumns({k: v for k, v in defaults.items() if k not in df.columns})


def drop_bad_keys(df: DataFrame, key: str) -> DataFrame:
    return df.filter(text.usable_key(key))


def with_json_key(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    return df.withColumn(name, json_hash(cols))


def pad_sources(df: DataFrame, constants: Mapping[str, object], placeholders: Mapping[str, str]) -> DataFrame:
    """Constant columns and typed nulls that bring one source into the shape of another."""
    cols = {k: F.lit(v) for k, v in constants.items()}
    cols.update({k: F.lit(None).cast(t) for k, t in placeholders.items()})
    return df.withColumns(cols)


# --- rows ----------------------------------------------------------------------------------------


def active_only(
    df: DataFrame, columns: Sequence[str], distinct: bool = False, active: str = "IsActive"
) -> DataFrame:
    """Active rows, projected; the filter reaches the scan and prunes partitions written by the flag."""
    out = df.filter(named(active) == ACTIVE).select(*as_columns(columns))
    return out.distinct() if distinct else out


def search(df: DataFrame, cols: Sequence[str], term: str) -> DataFrame:
    return df.filter(text.any_contains(cols, term))


def add_lineage(
    df: DataFrame,
    *,
    now: Column,
    process: str,
    entity: str,
    file: Column,
    expected_from: Column,
    expected_to: Column,
) -> DataFrame:
    """Columns that say when, by what and from which file a row was loaded."""
    stamped = {
        "ingested_datetime": now,
        "ingested_by_process_name": F.lit(process),
        "expected_from": expected_from,
        "expected_to": expected_to,
        "input_file": file,
        "modified_datetime": now,
        "modified_by_process_name": F.lit(process),
        "entity_name": F.lit(entity),
        "file_ID": F.sha2(F.concat(file, now.cast("string")), 256),
    }
    return df.withColumns(stamped)
