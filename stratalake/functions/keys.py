"""Deterministic row identities: every function builds one ``Column`` and never touches a row in Python."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """Column reference that is safe for reserved words, spaces and dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_columns(cols: Sequence[str | Column]) -> list[Column]:
    return [named(c) if isinstance(c, str) else c for c in cols]


def row_id(cols: Sequence[str | Column], null: str = ".") -> Column:
    """md5 over the plain concatenation, each null written as ``null``."""
    return F.md5(F.concat(*[F.coalesce(c.cast("string"), F.lit(null)) for c in as_columns(cols)]))


def row_id_ws(cols: Sequence[str | Column], sep: str = "", null: str | None = None) -> Column:
    """md5 over a joined string. Nulls are skipped, or written as ``null`` where it is given."""
    parts = [c.cast("string") for c in as_columns(cols)]
    if null is not None:
        parts = [F.coalesce(p, F.lit(null)) for p in parts]
    return F.md5(F.concat_ws(sep, *parts))


def state_hash(cols: Sequence[str | Column], sep: str = "||") -> Column:
    """sha256 of the state; nulls count as empty so that null and blank are the same state."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in as_columns(cols)]
    return F.sha2(F.concat_ws(sep, *parts), 256)


def business_key(cols: Sequence[str | Column]) -> Column:
    """sha256 of a composite key, parts joined with ``~``."""
    return state_hash(cols, sep="~")


def json_hash(cols: Sequence[str | Column]) -> Column:
    """sha256 of the JSON text of the columns; works for arrays and structs as well."""
    return F.sha2(F.to_json(F.struct(*as_columns(cols))), 256)


def composite_key(cols: Sequence[str | Column]) -> Column:
    """md5 of the parts written one after the other, nulls as empty text.

    Parts are cast to string before the null default: the default must not drag a text id into a number.
    """
    return F.md5(F.concat(*[F.coalesce(c.cast("string"), F.lit("")) for c in as_columns(cols)]))


def incremental_key(primary_key: str | Column, enqueued: str | Column) -> Column:
    """Non-negative 64-bit key from the 32-bit Murmur3 hash of two strings.

    The hash is widened before ``abs`` so that its smallest value cannot overflow.
    """
    parts = [c.cast("string") for c in as_columns([primary_key, enqueued])]
    return F.abs(F.hash(*parts).cast("bigint"))


def order_row_id(col: str | Column) -> Column:
    """Blank or null row id becomes ``~`` so that it sorts after every hexadecimal id."""
    c = as_columns([col])[0]
    return F.when(c.isNull() | (c == ""), F.lit("~")).otherwise(c)


def absolute(col: str | Column) -> Column:
    """Absolute value of whole numbers as 64 bit; anything that is not a whole number gives null."""
    return F.abs(as_columns([col])[0].try_cast("bigint"))
