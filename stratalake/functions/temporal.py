"""Date and time rules as column expressions. Text is read with the ``try_`` variants, never with a failing cast."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalake.functions.keys import as_columns

ONE_MICROSECOND = "INTERVAL 1 MICROSECOND"


def _c(col: str | Column) -> Column:
    return as_columns([col])[0]


def utc_to_local(col: str | Column, zone: str = "Europe/London") -> Column:
    """UTC instant (timestamp or ISO text with milliseconds) as local wall-clock time."""
    return F.from_utc_timestamp(_c(col).try_cast("timestamp"), zone)


def not_before(col: str | Column, first: str = "1900-01-01") -> Column:
    """Predicate: nulls and everything from the boundary on are kept."""
    c = _c(col)
    return c.isNull() | (c >= F.lit(first).cast("timestamp"))


def minute_text(col: str | Column) -> Column:
    """``yyyy-MM-dd HH:mm`` text of a time; unreadable text gives null."""
    return F.date_format(_c(col).try_cast("timestamp"), "yyyy-MM-dd HH:mm")


def iso_midnight(col: str | Column) -> Column:
    """Date text with the ISO midnight suffix; null stays null."""
    return F.concat(_c(col).cast("string"), F.lit("T00:00:00.000Z"))


def iso_micros(col: str | Column) -> Column:
    """ISO text with microseconds and a UTC offset."""
    return F.concat(F.date_format(_c(col), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+0000"))


def load_window(load_date: str | Column, days: int) -> tuple[Column, Column]:
    """Window a snapshot of ``load_date`` covers: from the day before, for ``days`` days."""
    start = F.date_sub(_c(load_date).cast("date"), 1)
    return start.cast("timestamp"), F.date_add(start, days).cast("timestamp")


# Fixed value: the time stamp that message files carry in their name.
FILE_TIME_PATTERN = r"(\d{4}-\d{2}-\d{2}T\d{2}[:_]\d{2}[:_]\d{2}\.\d{6})(?:\+\d{4})?"


def file_time(path: str | Column) -> Column:
    """Time written in a file name, with ``:`` or ``_`` between its parts; null if there is none."""
    text = F.regexp_extract(_c(path), FILE_TIME_PATTERN, 1)
    return F.replace(text, F.lit("_"), F.lit(":")).try_cast("timestamp")


def folder_date(path: str | Column) -> Column:
    """Date of a ``/yyyy-MM-dd/`` folder in a path; null if the folder is no date."""
    return F.regexp_extract(_c(path), r"/(\d{4}-\d{2}-\d{2})/", 1).try_cast("date")


def microsecond_after(col: str | Column) -> Column:
    return _c(col) + F.expr(ONE_MICROSECOND)
