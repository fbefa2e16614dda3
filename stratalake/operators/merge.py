"""Change application: label, reconcile, merge. Everything is a keyed join that returns the new table state."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.contract import ACTIVE, HISTORY, INACTIVE, HistoryColumns
from stratalake.functions.keys import as_columns, json_hash, named
from stratalake.functions.types import nullable
from stratalake.operators.joins import within, without
from stratalake.session import materialise

# Spellings of the three row actions.
CREATE = ("create", "created")
UPDATE = ("update", "updated")
DELETE = ("delete", "deleted")

# Message types that create or update a record; any other type deletes it.
CREATE_MESSAGES = ("Create",)
UPDATE_MESSAGES = ("update", "Update", "Publish", "Unpublish")


def message_action(message_type: str | Column) -> Column:
    c = as_columns([message_type])[0]
    return (
        F.when(c.isin(*CREATE_MESSAGES), F.lit("create"))
        .when(c.isin(*UPDATE_MESSAGES), F.lit("update"))
        .otherwise(F.lit("delete"))
    )


def checked_action(action: str | Column) -> Column:
    """Lower-cased action; a value outside the list fails the query."""
    c = F.lower(as_columns([action])[0])
    problem = F.raise_error(F.concat(F.lit("merge: unknown row action "), F.coalesce(c, F.lit("null"))))
    return F.when(c.isin(*CREATE, *UPDATE, *DELETE), c).otherwise(problem)


def merge_actions(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    action: str,
    update_cols: Sequence[str] | None = None,
) -> DataFrame:
    """State of ``target`` after the changes: matched updates and deletes, unmatched creates.

    An unmatched update or delete and a matched create change nothing. Two updates or deletes that hit one row
    fail the query. Columns that only the changes carry are added, null where nothing was changed.

    The target is the left side of a left join, and its keys are cut down to those of the creates before they
    are compared. A small batch is therefore broadcast and the target is not moved at all; with a large one,
    adaptive execution can split a hot key of the target.
    """
    kept, added = merge_parts(target, changes, keys, action, update_cols)
    return kept.unionByName(added(target.select(*as_columns(keys))))


def merge_parts(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    action: str,
    update_cols: Sequence[str] | None = None,
    mark: str | None = None,
) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The two halves of :func:`merge_actions`: what becomes of the target's rows, and the rows to add for given keys.

    With ``mark`` the rows that go stay in the first half, marked; written, it tells the target's keys, so that the
    target is read once.
    """
    _require(keys, target.columns, "target")
    _require([*keys, action], changes.columns, "changes")
    fields = {f.name: nullable(f.dataType) for f in changes.schema.fields if f.name != action}
    fields.update({f.name: nullable(f.dataType) for f in target.schema.fields})
    values = [c for c in changes.columns if c != action]
    checked = changes.withColumn("_action", checked_action(action))
    filled = reduce(lambda a, b: a & b, [named(k).isNotNull() for k in keys])
    edits = (
        checked.filter(F.col("_action").isin(*UPDATE, *DELETE) & filled)
        .groupBy(*[named(k).alias(f"_k{i}") for i, k in enumerate(keys)])
        .agg(
            F.count(F.lit(1)).alias("_changes"),
            F.first("_action").alias("_action"),
            F.first(F.struct(*as_columns(values))).alias("_src"),
        )
    )
    same = reduce(lambda a, b: a & b, [named(k) == F.col(f"_k{i}") for i, k in enumerate(keys)])
    twice = F.raise_error(F.lit("merge: more than one change for a row")).cast("boolean")
    act = F.col("_action")
    stays = F.when(F.col("_changes") > 1, twice).otherwise(act.isNull() | ~act.isin(*DELETE))
    updates = act.isin(*UPDATE)
    joined = target.join(edits, same, "left")
    joined = joined.withColumn(mark, ~stays) if mark else joined.filter(stays)
    kept = []
    for name, dtype in fields.items():
        old = (named(name) if name in target.columns else F.lit(None)).cast(dtype)
        touched = name in values and (not update_cols or name in update_cols)
        new = F.col("_src").getField(name).cast(dtype) if touched else None
        kept.append((old if new is None else F.when(updates, new).otherwise(old)).alias(name))

    creates = checked.filter(F.col("_action").isin(*CREATE)).drop(action, "_action")
    on = {k: k for k in keys}

    def added(of_target: DataFrame) -> DataFrame:
        known = within(of_target, creates, on).distinct()
        return without(creates, known, on).select(
            *[(named(n).cast(d) if n in values else F.lit(None).cast(d)).alias(n) for n, d in fields.items()]
        )

    return joined.select(*kept, *([named(mark)] if mark else [])), added


def _require(wanted: Sequence[str], present: Sequence[str], where: str) -> None:
    missing = [c for c in wanted if c not in present]
    if missing:
        raise ValueError(f"merge: columns {missing} are missing in the {where}")


def reconcile_messages(
    existing: DataFrame,
    messages: DataFrame,
    key: str,
    action: str,
    cols: HistoryColumns = HISTORY,
) -> DataFrame:
    """History after a batch of change messages.

    Creates and updates are appended as active rows. An active row of a key that got an update or a delete ends
    at the first such message; rows that ended before keep their end. A message that came twice counts once;
    the history itself is not sorted through again, since it has no copies to begin with.

    The messages are reduced to one row per key before the join, so a key with many rows on both sides is never
    multiplied out, and a small batch is broadcast to a history that stays where it is.
    """
    closing = messages.filter(named(action).isin("update", "delete"))
    first = closing.groupBy(named(key).alias("_key")).agg(F.min(named(cols.valid_from)).alias("_closed"))
    ends = F.col("_closed").isNotNull() & (named(cols.active) == ACTIVE)
    end_type = existing.schema[cols.valid_to].dataType
    old = existing.join(first, named(key) == F.col("_key"), "left").withColumns(
        {
            cols.valid_to: F.when(ends, F.col("_closed").cast(end_type)).otherwise(named(cols.valid_to)),
            cols.active: F.when(ends, F.lit(INACTIVE)).otherwise(named(cols.active)),
        }
    )
    new = messages.filter(named(action) != "delete").drop(action).dropDuplicates()
    return new.unionByName(old.drop("_key", "_closed"), allowMissingColumns=True)


def label_changes(
    new: DataFrame, existing: DataFrame, key: str, action: str, value_cols: Sequence[str] | None = None
) -> DataFrame:
    """Rows of ``new`` that are not in ``existing`` (create) or differ there (update); equal rows are dropped.

    Values are compared by the hash of their JSON text, so arrays and structs count. Null keys are dropped.
    """
    values = [c for c in (value_cols or new.columns) if c != key]
    left = new.filter(named(key).isNotNull()).withColumn("_new_hash", json_hash(values))
    right = existing.select(named(key).alias("_key"), json_hash(values).alias("_old_hash"))
    out = left.join(right, named(key) == F.col("_key"), "left").filter(
        F.col("_old_hash").isNull() | (F.col("_old_hash") != F.col("_new_hash"))
    )
    label = F.when(F.col("_old_hash").isNull(), F.lit("create")).otherwise(F.lit("update"))
    return out.withColumn(action, label).drop("_key", "_new_hash", "_old_hash")


def hash_upsert(new: DataFrame, existing: DataFrame | None, key: str) -> DataFrame:
    """State of a table after upserting the rows that differ. Without a table the rows are the table.

    Rows with an unknown key are all added; a known key may come more than once only with the values that the table has.
    Null keys are dropped. See :func:`upserted` for the plan.
    """
    rows = new.filter(named(key).isNotNull())
    return rows if existing is None else upserted(rows, existing, key, [c for c in new.columns if c != key])


def upserted(new: DataFrame, existing: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """The table's rows, those that differ from the new ones by the hash of ``values`` replaced, and the rows to add.

    The new rows are written once, with their hashes, and reduced to one per key. The table is the left side of a left
    join, where a row is compared and replaced at once, so a small batch is broadcast and the table stays where it is;
    of a second read, which tells the keys to add, only the key is taken.
    """
    fields = {f.name: nullable(f.dataType) for f in new.schema.fields}
    fields.update({f.name: nullable(f.dataType) for f in existing.schema.fields})
    once = materialise(new.select(F.struct(*as_columns(new.columns)).alias("_row"), named(key).alias("_key"), json_hash(values).alias("_hash")), "upsert")
    edits = once.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), F.min("_hash").alias("_low"), F.max("_hash").alias("_high"), F.first("_row").alias("_row"))
    differs = F.col("_n").isNotNull() & ((F.col("_low") != F.col("_now")) | (F.col("_high") != F.col("_now")))
    twice = F.raise_error(F.lit("merge: more than one change for a row")).cast("boolean")
    replaced = F.when(differs & (F.col("_n") > 1), twice).otherwise(differs)
    joined = existing.withColumn("_now", json_hash(values)).join(edits, named(key) == F.col("_key"), "left")

    def value(name: str, dtype: T.DataType) -> Column:
        old = (named(name) if name in existing.columns else F.lit(None)).cast(dtype)
        return F.when(replaced, F.col("_row").getField(name).cast(dtype)).otherwise(old) if name in new.columns else old

    kept = joined.select(*[value(n, d).alias(n) for n, d in fields.items()])
    known = existing.select(named(key).alias("_key"))
    added = once.join(known, "_key", "left_anti")
    blank = F.lit(None)
    return kept.unionByName(added.select(*[(F.col("_row").getField(n) if n in new.columns else blank).cast(d).alias(n) for n, d in fields.items()]))


def aligned_upsert(new: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Upsert restricted to the columns both tables have, in the types of the existing one."""
    common = [c for c in existing.columns if c in new.columns]
    shaped = new.select(*[named(c).cast(nullable(existing.schema[c].dataType)).alias(c) for c in common])
    return upserted(shaped.filter(named(key).isNotNull()), existing, key, [c for c in common if c != key])


def split_changes(changes: DataFrame, action: str) -> Mapping[str, DataFrame]:
    """Created and updated rows as two frames."""
    return {a: changes.filter(named(action) == a).drop(action) for a in ("create", "update")}
