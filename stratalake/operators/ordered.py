"""Neighbour, rank and id computations along a per-key timeline.

A plain window gives one task all rows of one key. Before a timeline is windowed, one narrow aggregate counts
rows per key (key columns only, combined before the exchange). Where no key has more than ``hot_rows`` rows the
plan is a plain window behind one hash exchange. Otherwise the rows are range-partitioned by key and order, which
cuts a hot key into slices of even size, and written to the shared folder once, so that every later pass and
every retried task sees the same slices. Each slice is windowed on its own, and what crosses a slice border
comes from a table with one row per slice of a cut key.

Two slices share at most one key, so the table of borders has at most two rows per slice. It is joined by key and
slice and written first, so that its size is known and decides whether it is broadcast.

The order columns must name a row uniquely within its key; ties beyond them have no defined order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions.keys import as_columns, named
from stratalake.session import materialise

HOT_ROWS = 2_000_000
#: Keys are first counted by so many buckets: no key has more rows than the fullest bucket.
COUNT_BUCKETS = 8192
#: Rows per slice for dense ids; none leaves the number of slices to the session's shuffle partitions.
ID_SLICE_ROWS: int | None = None
SLICE = "_slice"

Columns = Mapping[str, str | Column]


def _attach(df: DataFrame, small: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Null-safe equi-join; the key columns of the right side are dropped."""
    renamed = small.withColumnsRenamed({k: f"_s_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [named(k).eqNullSafe(named(f"_s_{k}")) for k in keys])
    return df.join(renamed, same, how).drop(*[f"_s_{k}" for k in keys])


def _slices(rows: int, per_slice: int) -> int:
    return max(2, -(-rows // per_slice))


def count_rows(df: DataFrame, keys: Sequence[str], hot_rows: int) -> tuple[int, bool]:
    """Number of rows, and whether some key has more than ``hot_rows``.

    Buckets of keys are counted first, which leaves a few thousand rows of each map task, however many keys there are.
    Single keys are counted only where a bucket is too full to tell.
    """
    by = [named(k) for k in keys]
    for group in ([F.pmod(F.xxhash64(*by), F.lit(COUNT_BUCKETS)).alias("_bucket")] if by else []), by:
        sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
        rows, most = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.max("_n"), F.lit(0))).first()
        if most <= hot_rows:
            return rows, False
    return rows, True


@dataclass(frozen=True)
class Timeline:
    """How the rows of a frame are laid out for windows over one key and order.

    ``df`` carries a slice number only if some key is hot, and ``cut`` then holds the keys that lie in more than
    one slice. Frames derived from ``df`` by filters or projections can be passed to :meth:`add` and share its
    exchange.
    """

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    cut: DataFrame | None = None

    @property
    def sliced(self) -> bool:
        return self.cut is not None

    @staticmethod
    def of(
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        hot_rows: int = HOT_ROWS,
        count_on: DataFrame | None = None,
    ) -> "Timeline":
        """Look for hot keys, which runs one narrow aggregate, and slice the frame if there is one.

        ``count_on`` is a cheaper frame to look at: one with the same keys and at least as many rows of each,
        such as the table ``df`` was derived from.
        """
        by = [named(k) for k in keys]
        rows, hot = count_rows(df if count_on is None else count_on, keys, hot_rows)
        if not hot:
            return Timeline(df, tuple(keys), tuple(order))
        ranged = df.repartitionByRange(_slices(2 * rows, hot_rows), *by, *[named(c) for c in order])
        staged = materialise(ranged.withColumn(SLICE, F.spark_partition_id()), "slices")
        spans = staged.groupBy(*by).agg(F.min(SLICE).alias("_lo"), F.max(SLICE).alias("_hi"))
        cut = materialise(spans.filter("_lo < _hi").select(*by, "_lo"), "cut-keys")
        return Timeline(staged, tuple(keys), tuple(order), cut)

    def add(
        self,
        df: DataFrame,
        previous: Columns | None = None,
        following: Columns | None = None,
        next_marked: Columns | None = None,
        rank: str | None = None,
        reverse_rank: str | None = None,
    ) -> DataFrame:
        """Add values of neighbouring rows of the same key, in ascending order.

        ``previous`` / ``following``: value in the row just before / after, null at the end of the timeline.
        ``next_marked``: nearest later value that is not null. ``rank`` and ``reverse_rank``: 1-based position
        from the start and from the end, 64 bit.
        """
        part = [named(k) for k in self.keys] + ([F.col(SLICE)] if self.sliced else [])
        forward = Window.partitionBy(*part).orderBy(*[named(c).asc() for c in self.order])
        backward = Window.partitionBy(*part).orderBy(*[named(c).desc() for c in self.order])
        later = backward.rowsBetween(Window.unboundedPreceding, -1)
        added: dict[str, Column] = {}
        if previous:
            added["_prev"] = F.lag(_packed(previous)).over(forward)
        if following:
            added["_next"] = F.lead(_packed(following)).over(forward)
        if rank:
            added["_rank"] = F.row_number().over(forward).cast("long")
        if reverse_rank:
            added["_reverse"] = F.row_number().over(backward).cast("long")
        for alias, c in (next_marked or {}).items():
            added[f"_mark_{alias}"] = F.last(as_columns([c])[0], ignorenulls=True).over(later)
        out = df.withColumns(added)
        if self.sliced:
            borders = materialise(self._borders(df, previous, following, next_marked, bool(rank or reverse_rank)), "borders")
            out = _attach(out, borders, [*self.keys, SLICE], "left")

        def joined(own: str, border: str) -> Column:
            return F.coalesce(own, border) if self.sliced else F.col(own)

        final: dict[str, Column] = {}
        for alias in previous or {}:
            final[alias] = joined("_prev", "_border_prev").getField(alias)
        for alias in following or {}:
            final[alias] = joined("_next", "_border_next").getField(alias)
        for alias in next_marked or {}:
            final[alias] = joined(f"_mark_{alias}", f"_border_mark_{alias}")
        for name, own, border in ((rank, "_rank", "_border_before"), (reverse_rank, "_reverse", "_border_after")):
            if name:
                final[name] = F.col(own) + F.coalesce(F.col(border), F.lit(0)) if self.sliced else F.col(own)
        helpers = [c for c in out.columns if c.startswith("_border_")] + list(added)
        return out.withColumns(final).drop(*[h for h in helpers if h not in final])

    def _borders(
        self, df: DataFrame, previous: Columns | None, following: Columns | None, next_marked: Columns | None, counted: bool
    ) -> DataFrame:
        """One row per slice of a cut key: what its rows need from the slices around it.

        The row at an end of a slice comes from ``row_number() = 1``, which each map task cuts down to one row
        per slice before the exchange.
        """
        by = [named(k) for k in self.keys]
        rows = _attach(df, self.cut, self.keys, "left_semi") if self.keys else df
        up_in, down_in = [named(c).asc() for c in self.order], [named(c).desc() for c in self.order]

        def end(of: DataFrame, value: Column, name: str, order: list[Column]) -> DataFrame:
            w = Window.partitionBy(*by, SLICE).orderBy(*order)
            return of.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").select(*by, SLICE, value.alias(name))

        parts = []
        if counted:
            parts.append(rows.groupBy(*by, SLICE).agg(F.count(F.lit(1)).alias("_rows")))
        if previous:
            parts.append(end(rows, _packed(previous), "_last", down_in))
        if following:
            parts.append(end(rows, _packed(following), "_first", up_in))
        for alias, c in (next_marked or {}).items():
            mark = as_columns([c])[0]
            parts.append(end(rows.filter(mark.isNotNull()), mark, f"_first_{alias}", up_in))
        if not counted and not previous and not following:
            parts.append(rows.groupBy(*by, SLICE).agg(F.count(F.lit(1)).alias("_rows")))
        both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        values = [c for c in both.columns if c not in (*self.keys, SLICE)]
        edge = both.groupBy(*by, SLICE).agg(*[F.first(v, ignorenulls=True).alias(v) for v in values])

        up = Window.partitionBy(*by).orderBy(SLICE)
        down = Window.partitionBy(*by).orderBy(F.col(SLICE).desc())
        before = up.rowsBetween(Window.unboundedPreceding, -1)
        after = down.rowsBetween(Window.unboundedPreceding, -1)
        cols: dict[str, Column] = {}
        if counted:
            cols["_border_before"] = F.sum("_rows").over(before)
            cols["_border_after"] = F.sum("_rows").over(after)
        if previous:
            cols["_border_prev"] = F.last("_last", ignorenulls=True).over(before)
        if following:
            cols["_border_next"] = F.last("_first", ignorenulls=True).over(after)
        for alias in next_marked or {}:
            cols[f"_border_mark_{alias}"] = F.last(f"_first_{alias}", ignorenulls=True).over(after)
        return edge.select(*by, SLICE, *[c.alias(a) for a, c in cols.items()])


def _packed(cols: Columns) -> Column:
    """The columns as one struct, which is never null itself: a null value and a missing row stay apart."""
    return F.struct(*[c.alias(a) for a, c in zip(cols, as_columns(list(cols.values())))])


def along(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    previous: Columns | None = None,
    following: Columns | None = None,
    next_marked: Columns | None = None,
    rank: str | None = None,
    reverse_rank: str | None = None,
    hot_rows: int = HOT_ROWS,
    count_on: DataFrame | None = None,
) -> DataFrame:
    """Neighbour values and positions in one call; see :meth:`Timeline.add`."""
    line = Timeline.of(df, keys, order, hot_rows, count_on)
    return line.add(line.df, previous, following, next_marked, rank, reverse_rank).drop(SLICE)


def global_id(
    df: DataFrame,
    order: Sequence[str],
    name: str,
    start: int | Column = 0,
    slice_rows: int | None = ID_SLICE_ROWS,
    count_on: DataFrame | None = None,
) -> DataFrame:
    """Dense ids ``start + 1 ..`` in the given total order, by one plan at every size and never in one task.

    The table is range-partitioned and sorted within its partitions; each row then knows its place in its
    partition, the partitions are counted, and the counts of the partitions before are added. Only those counts,
    one row per partition, are broadcast. The sorted rows are written once: a second range partitioning would
    draw other limits. ``slice_rows`` asks for partitions of so many rows, which takes a count.
    """
    offset = F.lit(start) if isinstance(start, int) else start
    by = [named(c) for c in order]
    slices = [] if slice_rows is None else [_slices((df if count_on is None else count_on).count(), slice_rows)]
    ranged = df.repartitionByRange(*slices, *by).sortWithinPartitions(*by)
    return _placed(ranged, name, offset)


def _placed(ranged: DataFrame, name: str, offset: Column) -> DataFrame:
    """Ids of rows that lie in their order, within partitions and from one to the next."""
    staged = materialise(ranged.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    # The generated id holds the partition above its 33rd bit and the place within it below.
    placed = staged.withColumns({"_part": F.shiftright("_at", 33), "_place": F.col("_at") % (1 << 33) + 1})
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = placed.join(F.broadcast(offsets), "_part", "left")  # one row per partition
    return numbered.withColumn(name, F.col("_place") + F.col("_before") + offset.cast("long")).drop(
        "_at", "_part", "_place", "_before"
    )


def global_id_along(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
    following: Columns,
    start: int | Column = 0,
    computed: Mapping[str, Column] | None = None,
    hot_rows: int = HOT_ROWS,
    slice_rows: int | None = ID_SLICE_ROWS,
) -> DataFrame:
    """Dense ids in the order of key, then timeline, and values of the row after on the key's timeline.

    Without a hot key both come from one exchange: a range of keys holds its keys whole, so the sorted slices serve the
    window as well. ``computed`` are columns the order may name, such as a hash; they are computed from the row on both
    sides of the exchange and neither moved nor written. A hot key is cut by :func:`global_id` and :func:`along`.
    """
    computed = dict(computed or {})
    rows, hot = count_rows(df, keys, hot_rows)
    if hot:
        numbered = global_id(df.withColumns(computed), [*keys, *order], name, start, slice_rows)
        return along(numbered, keys, order, following=following, hot_rows=hot_rows)
    by = [named(k) for k in keys]
    slices = [] if slice_rows is None else [_slices(rows, slice_rows)]
    ranged = df.drop(*computed).repartitionByRange(*slices, *by).withColumns(computed)
    forward = Window.partitionBy(*by).orderBy(*[named(c).asc() for c in order])
    ahead = ranged.withColumn("_next", F.lead(_packed(following)).over(forward)).drop(*computed)
    out = _placed(ahead, name, F.lit(start) if isinstance(start, int) else start).withColumns(computed)
    return out.withColumns({alias: F.col("_next").getField(alias) for alias in following}).drop("_next")


def chunk_groups(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int, name: str = "chunk", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Number chunks of at most ``size`` rows along every key, so that a fold by key and chunk stays bounded."""
    ranked = along(df, keys, order, rank="_position", hot_rows=hot_rows)
    return ranked.withColumn(name, F.floor((F.col("_position") - 1) / size)).drop("_position")
