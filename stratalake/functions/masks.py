"""Deterministic masks for personal columns.

Seeded masks draw their numbers from a hash of the seed. ``murmur`` keeps the values of existing masked
data; ``md5`` gives numbers any SQL engine can recompute.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.keys import named

# Identity columns that may seed the masks, best first.
SEED_CANDIDATES = ("Staff Number", "PersNo", "PersNo.", "Personnel Number", "Employee ID", "EmployeeID")
# Letters and final letters of a made-up insurance number, and the salts of its four parts.
NUMBER_LETTERS = "ABCDEFGHJKLMNPQRSTUVWXYZ"
NUMBER_FINALS = "ABCD"
NUMBER_SALTS = ("_ni1", "_ni2", "_nid", "_nil")
# Ranges of made-up dates, ages and salaries.
BIRTH_RANGE = ("1955-01-01", "2005-12-31")
AGE_RANGE = (18, 70)
SALARY_RANGE = (20_000, 100_000)
REDACTED = "REDACTED"


def seed_for(columns: Sequence[str], seed_column: str | None = None) -> Column:
    """Seed: the named column, else the first filled identity column, else a hash of the whole row."""
    if seed_column and seed_column in columns:
        return named(seed_column).cast("string")
    known = [named(c).cast("string") for c in SEED_CANDIDATES if c in columns]
    if known:
        return F.coalesce(*known)
    parts = [F.coalesce(named(c).cast("string"), F.lit("<NULL>")) for c in sorted(columns)]
    return F.sha2(F.concat_ws("|", *parts), 256)


def draw(seed: Column, n: int, salt: str = "", flavour: str = "murmur") -> Column:
    """Number in ``[0, n)`` that depends on seed and salt only."""
    text = F.concat(seed, F.lit(salt)) if salt else seed
    if flavour == "murmur":
        return F.abs(F.hash(text).cast("bigint")) % n
    if flavour == "md5":
        return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % n
    raise ValueError(f"unknown flavour {flavour!r}")


def keep_null(original: Column, masked: Column) -> Column:
    return F.when(original.isNotNull(), masked)


def fake_number(col: Column, seed: Column, flavour: str = "murmur") -> Column:
    """Made-up insurance number: two letters, six digits, one final letter."""
    s1, s2, s3, s4 = NUMBER_SALTS

    def letter(letters: str, salt: str) -> Column:
        return F.substring(F.lit(letters), (draw(seed, len(letters), salt, flavour) + 1).cast("int"), F.lit(1))

    digits = F.lpad(draw(seed, 1_000_000, s3, flavour).cast("string"), 6, "0")
    number = F.concat(letter(NUMBER_LETTERS, s1), letter(NUMBER_LETTERS, s2), digits, letter(NUMBER_FINALS, s4))
    return keep_null(col, number)


def hashed_email(col: Column) -> Column:
    """sha256 of the lower-cased address: equal addresses stay joinable."""
    return F.sha2(F.lower(col.cast("string")), 256)


def redacted(col: Column) -> Column:
    return keep_null(col, F.lit(REDACTED))


def fake_birth_date(col: Column, seed: Column, flavour: str = "murmur") -> Column:
    """Made-up date in the fixed range; a missing date stays missing."""
    first, last = (date.fromisoformat(d) for d in BIRTH_RANGE)
    offset = draw(seed, (last - first).days, "", flavour).cast("int")
    return keep_null(col, F.date_add(F.lit(first), offset))


def fake_int(col: Column, seed: Column, bounds: tuple[int, int], flavour: str = "murmur") -> Column:
    """Made-up whole number within the bounds, both included; a missing value stays missing."""
    low, high = bounds
    return keep_null(col, (draw(seed, high - low + 1, "", flavour) + low).cast("int"))


def outward_code(col: Column) -> Column:
    """First part of a postcode."""
    return F.get(F.split(F.trim(col.cast("string")), r"\s+"), F.lit(0))


def redacted_address(col: Column, dtype: T.DataType) -> Column:
    """Text is redacted; of a struct every field is, except that the postcode keeps its outward code."""
    if not isinstance(dtype, T.StructType):
        return redacted(col)
    fields = [
        (outward_code(col.getField(f.name)) if f.name.lower() == "postcode" else F.lit(REDACTED)).alias(f.name)
        for f in dtype.fields
    ]
    return keep_null(col, F.struct(*fields))


def keep_ends(col: Column) -> Column:
    """First and last character stay, every character between becomes ``*``."""
    return F.regexp_replace(col.cast("string"), r"(?<=.).(?=.)", "*")


def looks_masked_in_place(col: Column) -> Column:
    """True for values in the older style: one visible character, then asterisks."""
    return col.cast("string").rlike(r"^[A-Za-z\d_-]\*+")
