"""Which files and messages are new, and the columns a message load adds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.keys import as_columns, named
from stratalake.functions.temporal import file_time, load_window
from stratalake.functions.types import nullable
from stratalake.operators.joins import without


def missing_files(landed: DataFrame, loaded: DataFrame, path: str = "path", file_col: str = "input_file") -> DataFrame:
    """Landed files that no row of the table came from. Both sides stay distributed."""
    seen = loaded.select(named(file_col)).distinct()
    return without(landed, seen, {path: file_col})


def max_file_time(df: DataFrame, file_col: str = "input_file", name: str = "max_file_time") -> DataFrame:
    """One row: the greatest time written in a file name."""
    return df.agg(F.max(file_time(file_col)).alias(name))


def files_after(files: DataFrame, cutoff: Column, path: str = "path") -> DataFrame:
    """Files whose name carries a time strictly after the cut-off; names without a time are left out."""
    return files.filter(file_time(path) > cutoff)


def add_message_columns(df: DataFrame, now: Column, file: Column, enqueued: str) -> DataFrame:
    """Load window of one day from now on, the enqueue time as load time, and the file of the message."""
    return df.withColumns(
        {
            "expected_from": now,
            "expected_to": now + F.expr("INTERVAL 1 DAY"),
            "ingested_datetime": named(enqueued).try_cast("timestamp"),
            "input_file": file,
        }
    )


# Columns that differ between two deliveries of the same message.
DELIVERY_COLUMNS = ("expected_from", "expected_to", "ingested_datetime")


def dedupe_ignoring(df: DataFrame, ignore: Sequence[str] = DELIVERY_COLUMNS) -> DataFrame:
    """One row per message content; of equal ones the smallest values of the ignored columns stay."""
    rest = [c for c in df.columns if c not in ignore]
    ignored = [c for c in df.columns if c in ignore]
    if not ignored:
        return df.dropDuplicates()
    first = F.min(F.struct(*as_columns(ignored)))
    out = df.groupBy(*as_columns(rest)).agg(first.alias("_first"))
    return out.select(*[F.col("_first").getField(c).alias(c) if c in ignored else named(c) for c in df.columns])


def add_load_window(df: DataFrame, load_date: str | Column, days: int) -> DataFrame:
    start, end = load_window(load_date, days)
    return df.withColumns({"expected_from": start, "expected_to": end})


def new_messages(standardised: DataFrame, harmonised: DataFrame, message_id: str = "message_id") -> DataFrame:
    """Messages that did not reach the harmonised table; messages without an id count as new."""
    seen = harmonised.select(named(message_id)).filter(named(message_id).isNotNull()).distinct()
    return without(standardised, seen, {message_id: message_id})


def lacking_rows(rows: DataFrame, have: DataFrame) -> DataFrame:
    """Rows that the other frame has not, counting equal ones, in its types; columns that it lacks are null there."""
    types = {f.name: nullable(f.dataType) for f in have.schema.fields}
    shaped = rows.select(*[named(c).cast(types[c]).alias(c) if c in types else named(c) for c in rows.columns])
    other = have.select(*[named(c) if c in types else F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns])
    return shaped.exceptAll(other)
