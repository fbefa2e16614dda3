"""Scalar cleaning rules as column expressions, and header rules as plain string functions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from stratalake.functions.keys import as_columns


# --- headers (driver side, one call per column name) ---------------------------------------------


def snake_header(name: str) -> str:
    """Runs of characters that are neither letter nor digit become one underscore; lower case."""
    return re.sub(r"[^A-Za-z0-9]+", "_", name).lower().rstrip("_")


def light_header(name: str) -> str:
    """Only blank ``# . ( ) /`` become underscores; runs collapse, one trailing underscore goes, case stays."""
    collapsed = re.sub(r"_+", "_", re.sub(r"[ #.()/]", "_", name))
    return collapsed[:-1] if collapsed.endswith("_") else collapsed


def camel_header(name: str) -> str:
    """Words joined in camel case; the first word is lower-cased, the others get a capital."""
    words = name.split()
    if not words:
        return ""
    return words[0][:1].lower() + words[0][1:].lower() + "".join(w[:1].upper() + w[1:].lower() for w in words[1:])


def number_repeats(names: Sequence[str]) -> list[str]:
    """Every occurrence of a repeated name gets its running number; unique names are kept."""
    totals: dict[str, int] = {}
    for n in names:
        totals[n] = totals.get(n, 0) + 1
    seen: dict[str, int] = {}
    out = []
    for n in names:
        if totals[n] == 1:
            out.append(n)
        else:
            seen[n] = seen.get(n, 0) + 1
            out.append(f"{n}{seen[n]}")
    return out


# --- values --------------------------------------------------------------------------------------


def _c(col: str | Column) -> Column:
    return as_columns([col])[0]


def blank_to_null(col: str | Column) -> Column:
    """Null where only blanks are left, otherwise the value untouched."""
    c = _c(col)
    return F.when(F.trim(c) != "", c)


def or_default(col: str | Column, default: str = "") -> Column:
    """Null or blank becomes ``default``."""
    return F.coalesce(blank_to_null(col), F.lit(default))


def map_codes(col: str | Column, codes: Mapping[str, object], default: Column | None = None) -> Column:
    """Look a value up in a fixed dictionary; the default is the value itself.

    One literal map probe per row, so the plan does not grow with a chain of branches.
    """
    c = _c(col)
    pairs = [F.lit(x) for kv in codes.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), c if default is None else default)


def map_groups(
    col: str | Column,
    groups: Sequence[tuple[Sequence[str], object]],
    default: Column | None = None,
) -> Column:
    """First group that contains the value decides; the default is the lower-cased value."""
    c = _c(col)
    branches = [(c.isin(*members), F.lit(result)) for members, result in groups]
    start = F.when(*branches[0])
    return reduce(lambda acc, b: acc.when(*b), branches[1:], start).otherwise(F.lower(c) if default is None else default)


def slug(col: str | Column, specials: Mapping[str, str] | None = None) -> Column:
    """Special values first; everything else lower-cased with blanks and hyphens as underscores."""
    plain = F.regexp_replace(F.lower(_c(col)), "[- ]", "_")
    return map_codes(col, specials, plain) if specials else plain


def first_present(cols: Sequence[str | Column]) -> Column:
    """First value that is not null. A blank counts as present and stops the search."""
    return F.coalesce(*as_columns(cols))


def strip_trailing(col: str | Column, chars: str = " .") -> Column:
    """Remove any run of the given characters at the end."""
    return F.regexp_replace(_c(col), f"[{re.escape(chars)}]+$", "")


def to_boolean(col: str | Column) -> Column:
    """Boolean from text; text that is no boolean gives null instead of an error."""
    return _c(col).try_cast("boolean")


def tri_state(col: str | Column, yes: Sequence[str], no: Sequence[str]) -> Column:
    """True, false, or null for any other status."""
    c = _c(col)
    return F.when(c.isin(*yes), F.lit(True)).when(c.isin(*no), F.lit(False))


def prefix_short(col: str | Column, width: int = 8, prefix: str = "00") -> Column:
    """Put the prefix once before values shorter than ``width``; this is no full padding."""
    c = _c(col)
    return F.when(F.length(c) < width, F.concat(F.lit(prefix), c)).otherwise(c)


def joined(cols: Sequence[str | Column], sep: str = " ", skip_blank: bool = True) -> Column:
    """Join the parts that hold text; null when none does."""
    parts = [blank_to_null(F.trim(c.cast("string"))) if skip_blank else c.cast("string") for c in as_columns(cols)]
    return blank_to_null(F.concat_ws(sep, *parts))


def reference_of(first: str | Column, second: str | Column, sep: str = "-") -> Column:
    """``first-second``; null as soon as one part is null."""
    return F.concat(_c(first).cast("string"), F.lit(sep), _c(second).cast("string"))


def unescape_apostrophe(col: str | Column) -> Column:
    """The numeric HTML entity of the apostrophe back to the character."""
    return F.replace(_c(col), F.lit("&#039;"), F.lit("'"))


def any_contains(cols: Sequence[str | Column], term: str) -> Column:
    """True where any column holds the term, ignoring case; a null column does not match."""
    needle = F.upper(F.lit(term))
    hits = [F.coalesce(F.contains(F.upper(c.cast("string")), needle), F.lit(False)) for c in as_columns(cols)]
    return reduce(lambda a, b: a | b, hits)


def usable_key(col: str | Column) -> Column:
    """Predicate: a key that is not null, not blank and not a stray quote."""
    c = F.trim(_c(col))
    return _c(col).isNotNull() & (c != "") & ~c.isin('"', "'")


def quoted_json(col: str | Column, schema: str | DataType) -> Column:
    """Parse text that writes JSON with single quotes."""
    return F.from_json(F.regexp_replace(_c(col), "'", '"'), schema)
