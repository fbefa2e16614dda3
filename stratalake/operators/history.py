"""Versioned histories.

A history row says which state a key had from ``valid_from`` to ``valid_to``; the newest row of a key is
active. All timelines run on :func:`stratalake.operators.ordered.along`, so a key with a third of all rows is
cut into slices instead of being sorted in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions.contract import ACTIVE, HISTORY, INACTIVE, HistoryColumns
from stratalake.functions.keys import as_columns, named, order_row_id, row_id, state_hash
from stratalake.functions.temporal import microsecond_after
from stratalake.functions.types import nullable
from stratalake.functions.text import blank_to_null
from stratalake.operators.joins import flag_exists, within, without
from stratalake.operators.latest import first_per_key
from stratalake.operators.ordered import HOT_ROWS, ID_SLICE_ROWS, SLICE, Timeline, along, count_rows, global_id, global_id_along
from stratalake.session import materialise

#: Keys of a table that a batch may affect to be broadcast: some 100 MB.
BROADCAST_KEYS = 1_500_000


def _flag(active: Column) -> Column:
    return F.when(active, F.lit(ACTIVE)).otherwise(F.lit(INACTIVE))


def _existing_end(df: DataFrame, cols: HistoryColumns) -> Column | None:
    """Validity end a source already carries; blank text means none."""
    if cols.valid_to not in df.columns:
        return None
    text = df.schema[cols.valid_to].dataType.typeName() == "string"
    return blank_to_null(cols.valid_to) if text else named(cols.valid_to)


def rank_history(
    df: DataFrame,
    keys: Sequence[str],
    tie: Sequence[str],
    id_name: str | None = None,
    existence: tuple[DataFrame, Mapping[str, str]] | None = None,
    hash_cols: Sequence[str] | None = None,
    hash_null: str = ".",
    cols: HistoryColumns = HISTORY,
    hot_rows: int = HOT_ROWS,
    id_slice_rows: int | None = ID_SLICE_ROWS,
) -> DataFrame:
    """History by rank: the newest row of a key is active, every other row ends where the next one begins.

    ``tie`` makes the order within one instant total. An end the source already carries wins. Adds a dense id
    ordered by time and key, a flag whether the key exists in another table, and a row id, where asked for.

    The rows are looked at several times (hot keys, cut points, the history itself), column by column: hand in a
    table, or a frame that was written, rather than the end of a long lineage. Ids depend on the order alone, so they
    are given to the plain rows first: their cut points are drawn from them and the timeline is windowed once.
    """
    time = cols.valid_from
    if id_name is not None:
        order = [time, *keys, *[t for t in tie if t not in keys]]
        df = global_id(df, order, id_name, slice_rows=id_slice_rows)
    ahead = along(df, keys, [time, *tie], following={"_until": time, "_has_next": F.lit(True)}, hot_rows=hot_rows)
    time_type = df.schema[time].dataType
    given = _existing_end(df, cols)
    until = F.col("_until") if given is None else F.coalesce(given.cast(time_type), F.col("_until"))
    out = ahead.withColumns({cols.valid_to: until, cols.active: _flag(F.col("_has_next").isNull())})
    out = out.drop("_until", "_has_next")
    if id_name is not None:
        out = out.select(*[named(c) for c in [*[c for c in out.columns if c != id_name], id_name]])
    if existence is not None:
        out = flag_exists(out, existence[0], existence[1], cols.migrated)
    if hash_cols is not None:
        out = out.withColumn(cols.row_id, row_id(hash_cols, hash_null))
    return out


def snapshot_history(
    snapshot: DataFrame,
    current: DataFrame,
    key: str,
    hash_cols: Sequence[str],
    constants: Mapping[str, Column] | None = None,
    closed_at: Column | None = None,
    cols: HistoryColumns = HISTORY,
) -> DataFrame:
    """New state of a history after a full snapshot of its source.

    A new key is inserted; a changed key is inserted and its active row ends the day before the snapshot (or at
    ``closed_at``); an unchanged key and all past rows stay. A key missing from the snapshot stays active: use
    :func:`close_deleted` where absence means deletion. The snapshot has one row per key, or the query fails; null
    keys are no keys.

    One full join decides everything: each side is exchanged once, and each pair gives back the rows it needs.
    """
    constants = dict(constants or {})
    out_cols = [c for c in current.columns]
    types = {f.name: nullable(f.dataType) for f in current.schema.fields}
    new = snapshot.filter(named(key).isNotNull()).withColumn(cols.row_id, row_id(hash_cols)).withColumns(constants)
    fresh = {cols.valid_to: F.lit(None), cols.active: F.lit(ACTIVE)}
    new_row = F.struct(
        *[
            (fresh[c] if c in fresh else named(c) if c in new.columns else F.lit(None)).cast(types[c]).alias(c)
            for c in out_cols
        ]
    )
    incoming = new.select(named(key).alias("_key"), new_row.alias("_new"))
    # Counted in the exchange that the join needs anyway.
    incoming = incoming.groupBy("_key").agg(F.count(F.lit(1)).alias("_copies"), F.first("_new").alias("_new"))
    twice = F.raise_error(F.concat(F.lit("snapshot: more than one row for key "), F.col("_key").cast("string"))).cast("boolean")
    incoming = incoming.filter(F.when(F.col("_copies") > 1, twice).otherwise(F.lit(True))).drop("_copies")
    open_rows = F.coalesce((named(cols.active) == ACTIVE) & named(key).isNotNull(), F.lit(False))
    active = current.filter(open_rows).select(
        named(key).alias("_key_old"),
        F.struct(*[named(c).cast(types[c]).alias(c) for c in out_cols]).alias("_old"),
    )
    changed = ~F.col("_new").getField(cols.row_id).eqNullSafe(F.col("_old").getField(cols.row_id))
    has_new, has_old = F.col("_new").isNotNull(), F.col("_old").isNotNull()
    since = F.col("_new").getField(cols.valid_from)
    end = F.date_sub(since.cast("date"), 1).cast("timestamp") if closed_at is None else closed_at
    closed = F.col("_old")
    closed = closed.withField(cols.valid_to, end.cast(types[cols.valid_to])).withField(cols.active, F.lit(INACTIVE))
    kept = F.when(has_old & has_new & changed, closed).when(has_old, F.col("_old"))
    inserted = F.when(has_new & (~has_old | changed), F.col("_new"))
    rows = incoming.join(active, F.col("_key") == F.col("_key_old"), "full").select(
        F.explode(F.filter(F.array(kept, inserted), lambda r: r.isNotNull())).alias("_row")
    )
    past = current.filter(~open_rows)
    return rows.select("_row.*").unionByName(past)


def renumber(
    df: DataFrame, id_name: str, tie: Sequence[str], slice_rows: int | None = ID_SLICE_ROWS
) -> DataFrame:
    """Dense ids: rows that have one first, in their order, then the new rows in the order of ``tie``."""
    ordered = df.withColumn("_new_row", named(id_name).isNull()).withColumn("_old_id", named(id_name))
    out = global_id(ordered, ["_new_row", "_old_id", *tie], id_name, slice_rows=slice_rows)
    return out.select(*as_columns(df.columns))


def state_history(
    df: DataFrame,
    keys: Sequence[str],
    state_cols: Sequence[str] | None = None,
    source_priority: Mapping[str, int] | None = None,
    id_name: str | None = None,
    cols: HistoryColumns = HISTORY,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """History by state: consecutive rows of a key in the same state are one row.

    Rows of one instant are ordered by source priority (greatest first), row id (blank last) and state hash;
    the same state twice at one instant and source counts once. Each row ends where the next state begins, one
    microsecond later where both begin at the same instant. ``id_name`` numbers the states of a key.
    """
    time = cols.valid_from
    states = list(state_cols) if state_cols is not None else [c for c in df.columns if c not in cols.names()]
    base = df.filter(reduce(lambda a, b: a & b, [named(k).isNotNull() for k in keys]))
    given_id = named(cols.row_id) if cols.row_id in df.columns else F.lit(None).cast("string")
    src = named(cols.source) if cols.source in df.columns else F.lit("")
    priority = F.lit(0)
    if source_priority:
        ranks = F.create_map(*[F.lit(x) for kv in source_priority.items() for x in kv])
        priority = F.coalesce(F.try_element_at(ranks, src), F.lit(0))
    tagged = base.withColumns(
        {
            "_state": state_hash(states),
            "_after": -priority,
            "_row_order": order_row_id(given_id),
            "_src": F.coalesce(src, F.lit("")),
        }
    )
    once = first_per_key(tagged, [*keys, time, "_src", "_state"], [F.col("_row_order").asc()])
    order = [time, "_after", "_row_order", "_state", "_src"]
    line = Timeline.of(once, keys, order, hot_rows, count_on=base)
    seen = line.add(line.df, previous={"_before": "_state"})
    changes = seen.filter(F.col("_before").isNull() | (F.col("_before") != F.col("_state")))
    out = line.add(changes, following={"_until": time}, rank="_version" if id_name else None)
    until = F.when(F.col("_until") == named(time), microsecond_after("_until")).otherwise(F.col("_until"))
    out = out.withColumns({cols.valid_to: until, cols.active: _flag(F.col("_until").isNull())})
    if id_name:
        out = out.withColumn(id_name, F.col("_version"))
    helpers = ["_state", "_after", "_row_order", "_src", "_before", "_until", "_version", SLICE]
    return out.drop(*helpers)


def close_by(
    a: DataFrame,
    b: DataFrame,
    keys: Sequence[str],
    only_active: bool = True,
    cols: HistoryColumns = HISTORY,
    hot_rows: int = HOT_ROWS,
    count_on: DataFrame | None = None,
) -> DataFrame:
    """Close a row of ``a`` when its key becomes active in ``b``: at the first strictly later active time of ``b``.

    With ``only_active`` rows already closed stay as they are; otherwise a later end is brought forward as well.
    Both tables are laid on one timeline and every row of ``a`` looks for the next mark of ``b``; the rows of a
    key are never paired with each other. ``count_on`` has the keys and at least as many rows of each as ``a``.
    """
    time = cols.valid_from
    marks = b.filter(named(cols.active) == ACTIVE).select(*as_columns(keys), named(time).alias("_at"))
    marks = marks.dropna(subset=list(keys)).distinct()  # a null key is no key and closes nothing
    ours = a.select(
        *[named(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        named(time).alias("_at"),
        F.lit(1).alias("_side"),
        F.struct(*as_columns(a.columns)).alias("_row"),
    )
    theirs = marks.select(
        *[named(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        "_at",
        F.lit(0).alias("_side"),
        F.lit(None).cast(ours.schema["_row"].dataType).alias("_row"),
    )
    line = ours.unionByName(theirs).withColumn("_mark", F.when(F.col("_side") == 0, F.col("_at")))
    line = line.withColumn("_tie", F.xxhash64("_row"))
    names = [f"_k{i}" for i in range(len(keys))]
    bound = None
    if count_on is not None:
        own = [named(k).alias(n) for k, n in zip(keys, names)]
        bound = count_on.select(*own).unionByName(b.select(*own))
    met = along(
        line, names, ["_at", "_side", "_tie"], next_marked={"_next_mark": "_mark"}, hot_rows=hot_rows, count_on=bound
    )
    rows = met.filter("_side = 1").select("_row.*", "_next_mark")
    end_type = a.schema[cols.valid_to].dataType
    if only_active:
        closes = (named(cols.active) == ACTIVE) & F.col("_next_mark").isNotNull()
    else:
        ends = named(cols.valid_to).cast(line.schema["_at"].dataType)
        closes = F.col("_next_mark").isNotNull() & (ends.isNull() | (F.col("_next_mark") < ends))
    return rows.withColumns(
        {
            cols.valid_to: F.when(closes, F.col("_next_mark").cast(end_type)).otherwise(named(cols.valid_to)),
            cols.active: F.when(closes, F.lit(INACTIVE)).otherwise(named(cols.active)),
        }
    ).select(*as_columns(a.columns))


def group_of(history: DataFrame, key: str, group: str, cols: HistoryColumns = HISTORY) -> DataFrame:
    """Keys that are active in a group, with the time they are so from."""
    active = history.filter(named(cols.active) == ACTIVE)
    return active.select(
        named(key), F.lit(group).alias("currentGroup"), named(cols.valid_from).alias("asOfTimestamp")
    ).distinct()


def group_updates(history: DataFrame, other: DataFrame, key: str, cols: HistoryColumns = HISTORY) -> DataFrame:
    """Keys active here that the other group lists as active without a time; they take the time from here."""
    open_there = other.filter((named(cols.active) == ACTIVE) & named(cols.valid_from).isNull())
    active = history.filter(named(cols.active) == ACTIVE)
    hits = active.join(open_there.select(named(key)).distinct(), key, "left_semi")
    return hits.select(named(key), named(cols.valid_from).alias("activeFrom")).distinct()


def history_state(history: DataFrame, keys: Sequence[str], id_name: str, cols: HistoryColumns = HISTORY) -> DataFrame:
    """One row per key, to be kept as a table beside the history: hash and time of its active row and its greatest id."""
    active = named(cols.active) == ACTIVE
    packed = _packed_hash("row_hash")
    sums = history.groupBy(*as_columns(keys)).agg(
        F.max(F.when(active, packed)).alias("_packed"), F.max(F.when(active & packed.isNull(), F.col("row_hash"))).alias("_other"),
        F.max(F.when(active, named(cols.valid_from))).alias("since"), F.max(named(id_name)).alias("last_id"),
    )
    return sums.select(*as_columns(keys), F.greatest(F.lower(F.hex("_packed")), "_other").alias("row_hash"), "since", "last_id")


def _packed_hash(name: str) -> Column:
    """A hash of :func:`state_hash` in the 32 bytes that it stands for, in the same order; null for any other text."""
    return F.when(named(name).rlike("^[0-9a-f]{64}$"), F.unhex(named(name)))


def incremental_history(
    source: DataFrame,
    target: DataFrame | None,
    keys: Sequence[str],
    tracked: Sequence[str],
    id_name: str,
    tie: Sequence[str],
    cols: HistoryColumns = HISTORY,
    hot_rows: int = HOT_ROWS,
    id_slice_rows: int | None = ID_SLICE_ROWS,
    state: DataFrame | None = None,
) -> DataFrame:
    """New state of a history after its source was read again in full.

    The first load keeps every version. Later, keys whose newest state is new or differs from the active one
    are affected: their active row ends at the first time that was not loaded yet, and the versions not loaded
    yet are inserted. Versions that are in the table already are never inserted again. Ids go on from the
    greatest one.

    What a batch affects is found from one row per key: the newest state in the source against ``state``
    (:func:`history_state`, which has every key of the table), or the table's own where none is given. The source is moved
    once for that, without its hashes, and the rows of affected keys are written. Only those whose key is in the table
    meet the table's; if they are few, they are broadcast to it and the table is not moved.
    """
    time = cols.valid_from
    state_of = state_hash([*keys, *tracked], "~")
    order = [time, *tie, "row_hash"]
    if target is None:
        return _versions(source, keys, order, id_name, F.lit(0), state_of, cols, hot_rows, id_slice_rows)

    last_id = target.select(named(id_name).alias("last_id")) if state is None or "last_id" not in state.columns else state
    if state is None:
        state = history_state(target, keys, id_name, cols)
    active = state.select(
        *[named(k).alias(f"_k{i}") for i, k in enumerate(keys)], _packed_hash("row_hash").alias("_active_hash"), F.lit(True).alias("_known")
    )
    same_key = reduce(lambda x, y: x & y, [named(k) == F.col(f"_k{i}") for i, k in enumerate(keys)])
    differs = F.col("_active_hash").isNull() | (F.col("_active_hash") != F.unhex("_newest"))
    helpers = ["_newest", "_active_hash", *[f"_k{i}" for i in range(len(keys))]]
    keyed = source.filter(reduce(lambda x, y: x & y, [named(k).isNotNull() for k in keys]))  # a null key is no key
    if count_rows(keyed, keys, hot_rows)[1]:
        hashed = keyed.withColumn("row_hash", state_of)
        newest = hashed.groupBy(*as_columns(keys)).agg(F.max_by("row_hash", F.struct(*as_columns(order))).alias("_newest"))
        affected = newest.join(active, same_key, "left").filter(differs).drop(*helpers)
        touched = hashed.join(materialise(affected, "affected"), list(keys))
    else:
        laid = keyed.drop("row_hash").repartition(*as_columns(keys)).withColumn("row_hash", state_of)
        newest = F.max(F.struct(*as_columns(order))).over(Window.partitionBy(*as_columns(keys))).getField("row_hash")
        touched = laid.withColumn("_newest", newest).join(active, same_key, "left").filter(differs).drop(*helpers)
    touched = materialise(touched.withColumn("_known", F.coalesce("_known", F.lit(False))).drop("row_hash"), "touched")
    touched = touched.withColumn("row_hash", state_of)

    on, present = {k: k for k in keys}, {c: c for c in [*keys, "row_hash", time]}
    met = materialise(touched.filter("_known").select(*as_columns(keys)).distinct(), "affected")
    sized = F.broadcast if met.count() <= BROADCAST_KEYS else (lambda df: df)
    loaded = within(target.select(*as_columns(present)), sized(met), on)
    again = materialise(without(touched.filter("_known"), loaded, present), "pending")
    pending = touched.filter("not _known").unionByName(again).drop("_known", "row_hash")
    first = again.groupBy(*[named(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min(named(time)).alias("_first"))
    expires = (named(cols.active) == ACTIVE) & F.col("_first").isNotNull()
    end_type = target.schema[cols.valid_to].dataType
    expired = (
        target.join(sized(first), same_key, "left")
        .withColumns(
            {
                cols.valid_to: F.when(expires, F.col("_first").cast(end_type)).otherwise(named(cols.valid_to)),
                cols.active: F.when(expires, F.lit(INACTIVE)).otherwise(named(cols.active)),
            }
        )
        .select(*as_columns(target.columns))
    )
    greatest = last_id.agg(F.coalesce(F.max("last_id").cast("long"), F.lit(0))).scalar()
    added = _versions(pending, keys, order, id_name, greatest, state_of, cols, hot_rows, id_slice_rows)
    return expired.unionByName(added, allowMissingColumns=True)


def _versions(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    id_name: str,
    start: Column,
    state_of: Column,
    cols: HistoryColumns,
    hot_rows: int,
    id_slice_rows: int | None,
) -> DataFrame:
    following = {"_until": cols.valid_from, "_has_next": F.lit(True)}
    out = global_id_along(df, keys, order, id_name, following, start, {"row_hash": state_of}, hot_rows, id_slice_rows)
    out = out.withColumns({cols.valid_to: F.col("_until"), cols.active: _flag(F.col("_has_next").isNull())})
    return out.drop("_until", "_has_next")


def append_rerank(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    id_name: str,
    id_order: Sequence[str],
    hash_cols: Sequence[str],
    now: Column,
    action: str = "row_action",
    cols: HistoryColumns = HISTORY,
    hot_rows: int = HOT_ROWS,
    id_slice_rows: int | None = ID_SLICE_ROWS,
    only_appended_keys: bool = False,
) -> DataFrame:
    """Changes that append the rows newer than anything loaded and rank the whole table again.

    The greatest ``order`` of a key is active; every other row ends at ``now``. Row ids are written again. With
    ``only_appended_keys`` keys without a new row are left out: a table that was ranked before has their ranks, and the
    time at which their rows ended stays. New rows are written once; a few of them are broadcast to the table, of which
    only the rows of their keys are moved and ranked. The result carries ``create`` or ``update`` for :func:`stratalake.operators.merge.merge_actions`, which needs
    to update the four bookkeeping columns only.
    """
    time = cols.valid_from
    floor = F.lit("1900-01-01").cast(existing.schema[time].dataType)
    newest = existing.agg(F.coalesce(F.max(named(time)), floor)).scalar()
    last_id = existing.agg(F.coalesce(F.max(named(id_name)).cast("long"), F.lit(0))).scalar()
    fresh = global_id(incoming.filter(named(time) > newest), id_order, id_name, last_id, id_slice_rows)
    if only_appended_keys:
        fresh = materialise(fresh, "appended")
        existing = within(existing, fresh.select(*as_columns(keys)).distinct(), {k: k for k in keys})
    both = existing.withColumn(action, F.lit("update")).unionByName(
        fresh.withColumn(action, F.lit("create")), allowMissingColumns=True
    )
    ranked = along(both, keys, [*order, id_name], following={"_has_next": F.lit(True)}, hot_rows=hot_rows)
    keyed = reduce(lambda a, b: a & b, [named(k).isNotNull() for k in keys])
    ranked = ranked.withColumns(
        {
            cols.migrated: F.when(keyed, F.lit(1)).otherwise(F.lit(0)),
            cols.active: _flag(F.col("_has_next").isNull()),
        }
    ).withColumn(cols.row_id, row_id(hash_cols))
    end = F.when(named(cols.active) == INACTIVE, now).otherwise(named(cols.valid_to))
    return ranked.withColumn(cols.valid_to, end).drop("_has_next")


def deleted_keys(snapshots: DataFrame, key: str, load_col: str) -> DataFrame:
    """Keys of older snapshots that the newest one does not have.

    A key is gone when its last load is not the newest load: one aggregate instead of a self anti join.
    """
    newest = snapshots.agg(F.max(named(load_col))).scalar()
    return (
        snapshots.filter(named(key).isNotNull())
        .groupBy(named(key))
        .agg(F.max(named(load_col)).alias("_last"))
        .filter(F.col("_last") < newest)
        .select(named(key))
    )


def close_deleted(
    history: DataFrame, deleted: DataFrame, on: Mapping[str, str], cols: HistoryColumns = HISTORY
) -> DataFrame:
    """Deactivate deleted keys. An active row has no end; an inactive row without one ends a day after it began."""
    marked = flag_exists(history, deleted, on, "_gone", True, False)
    active = F.when(F.col("_gone"), F.lit(INACTIVE)).otherwise(named(cols.active))
    out = marked.withColumn(cols.active, active).drop("_gone")
    end_type = history.schema[cols.valid_to].dataType
    day_after = F.date_add(named(cols.valid_from).cast("date"), 1).cast("timestamp").cast(end_type)
    end = F.when(named(cols.active) == INACTIVE, F.coalesce(named(cols.valid_to), day_after))
    return out.withColumn(cols.valid_to, end).select(*as_columns(history.columns))


def fan_out(history: DataFrame, type_col: str, types: Sequence[str]) -> dict[str, DataFrame]:
    """The active rows of one history as one view per type."""
    active = history.filter(named("IsActive") == ACTIVE) if "IsActive" in history.columns else history
    return {t: active.filter(named(type_col) == t) for t in types}
