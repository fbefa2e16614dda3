"""Raw drops to standardised tables, as compositions of the operators."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions import text
from stratalake.functions.keys import as_columns, named
from stratalake.operators import conform, ingest, joins, nested
from stratalake.operators.latest import latest_load

Mask = Callable[[DataFrame], DataFrame]


def messages(raw: DataFrame, loaded: DataFrame | None, now: Column, enqueued: str, mask: Mask | None = None) -> DataFrame:
    """Message files that were not loaded yet: stamped, one row per message, masked. Needs ``input_file``."""
    fresh = raw
    if loaded is not None:
        pending = ingest.missing_files(raw.select("input_file").distinct(), loaded, "input_file")
        fresh = raw.join(pending, "input_file", "left_semi")
    once = ingest.dedupe_ignoring(ingest.add_message_columns(fresh, now, F.col("input_file"), enqueued))
    return mask(once) if mask else once


def dated_drop(
    raw: DataFrame,
    declared: T.StructType,
    *,
    now: Column,
    load_date: Column,
    lateness_days: int,
    process: str,
    entity: str,
    file: Column,
    mask: Mask | None = None,
) -> DataFrame:
    """One CSV or JSON drop: junk columns out, lineage in, clean headers, declared types (arrays as text), masks."""
    from stratalake.functions.temporal import load_window

    start, end = load_window(load_date, lateness_days)
    stamped = conform.add_lineage(
        conform.drop_junk(raw), now=now, process=process, entity=entity, file=file, expected_from=start, expected_to=end
    )
    typed = conform.cast_to_schema(conform.clean_headers(stamped), conform.relax_arrays(declared))
    return mask(typed) if mask else typed


def directory_users(
    snapshot: DataFrame, now: Column, load_date: Column, lateness_days: int, array: str = "value"
) -> DataFrame:
    """Directory snapshot documents: one row per user with its load window."""
    users = nested.explode_entities(snapshot, array)
    return ingest.add_load_window(users, load_date, lateness_days).withColumn("ingested_datetime", now)


def attribute_matrix(raw: DataFrame, key: str = "attribute", as_text: Sequence[str] = ("s78",)) -> DataFrame:
    """Matrix rows with a usable attribute; unnamed columns go, headers in camel case."""
    kept = conform.drop_bad_keys(conform.drop_junk(raw, prefixes=("_c",), blank=True), key)
    out = conform.camel_headers(kept)
    return out.withColumns({c: named(c).cast("string") for c in as_text if c in out.columns})


def listed_entities(raw: DataFrame, array: str = "entities") -> DataFrame:
    """Entities of all landed documents; equal entities are kept."""
    return nested.explode_entities(raw, array)


@dataclass(frozen=True)
class Related:
    """A table joined to the cases by its newest load. ``on``: case column -> key; ``take``: column -> new name."""

    df: DataFrame
    on: Mapping[str, str]
    take: Mapping[str, str]


# Spellings of the three procedures; any other spelling means that none is known.
PROCEDURES = {"Written Reps": "WR", "Hearing": "IH", "Inquiry": "LI", "Public Inquiry": "LI"}


def procedure_code(appellant: str | Column, authority: str | Column) -> Column:
    """The procedure of the appellant, or that of the authority where the appellant's is null (blank is not null)."""
    return text.map_codes(text.first_present([appellant, authority]), PROCEDURES, F.lit(None).cast("string"))


def cases(
    base: DataFrame,
    key: str,
    related: Sequence[Related],
    lists: Mapping[str, tuple[DataFrame, str, str]] | None = None,
    renames: Mapping[str, str] | None = None,
    procedure: tuple[str, str, str] | None = None,
) -> DataFrame:
    """One row per case from many tables, each reduced to its newest load before it is joined.

    ``lists``: output column -> (table, its key, its value): distinct values as sorted text.
    ``procedure``: output column and the two columns it is chosen from.
    """
    out = latest_load(base, [key])
    for r in related:
        out = joins.join_latest(out, {"r": (r.df, r.on, r.take)})
    for name, (df, other_key, value) in (lists or {}).items():
        joined = nested.join_distinct(df, [other_key], value, "_list")
        out = joins.enrich(out, joined, {key: other_key}, {"_list": name})
    if procedure:
        name, appellant, authority = procedure
        out = out.withColumn(name, procedure_code(appellant, authority)).drop(appellant, authority)
    renames = renames or {}
    return out.select(*[c.alias(renames.get(n, n)) for n, c in zip(out.columns, as_columns(out.columns))])


def appeal_grounds(df: DataFrame, key: str, letter: str, start: str, name: str) -> DataFrame:
    """Grounds of a case as an array: every distinct pair of letter and start date."""
    fields = {letter: "appealGroundLetter", start: "groundForAppealStartDate"}
    return nested.collect_distinct_structs(df.filter(named(letter).isNotNull()), [key], fields, name)
