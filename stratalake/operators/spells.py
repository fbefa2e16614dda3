"""Spells of time and lines of reporting: merged spells, working days, and the way to the top.

Nothing is spread over days: spells are merged by the greatest end before them, and working days are the difference of
two running sums over a calendar. A key with a third of all spells is cut into slices (:mod:`.ordered`); what a slice
needs of those before it comes from a table of one row per slice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions.keys import as_columns, named
from stratalake.operators.ordered import HOT_ROWS, SLICE, Timeline
from stratalake.session import materialise


def _running(line: Timeline, df: DataFrame, value: Column, name: str, total: bool) -> DataFrame:
    """``df``, laid out as the line, with the sum of a value up to a row, or its maximum over the rows before it."""
    keys = [named(k) for k in line.keys]
    order = [named(c).asc() for c in line.order]
    last = Window.currentRow if total else -1
    within = Window.partitionBy(*keys, *([F.col(SLICE)] if line.sliced else [])).orderBy(*order).rowsBetween(Window.unboundedPreceding, last)
    out = df.withColumn(name, (F.sum if total else F.max)(value).over(within))
    if not line.sliced:
        return out
    per_slice = df.groupBy(*keys, SLICE).agg((F.sum if total else F.max)(value).alias("_of"))
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)  # one row per slice
    border = per_slice.select(
        *[named(k).alias(f"_k{i}") for i, k in enumerate(line.keys)], F.col(SLICE).alias("_s"), (F.sum if total else F.max)("_of").over(before).alias("_before")
    )
    same = reduce(lambda a, b: a & b, [named(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(line.keys)], F.col(SLICE) == F.col("_s"))
    out = out.join(border, same, "left")
    both = F.coalesce(F.col(name), F.lit(0)) + F.coalesce("_before", F.lit(0)) if total else F.greatest(name, "_before")
    return out.withColumn(name, both).drop("_s", "_before", *[f"_k{i}" for i in range(len(keys))])


def merge_spells(df: DataFrame, keys: Sequence[str], start: str, end: str, gap_days: int = 1, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``keys, start, end, spells``: spells of a key that overlap, or follow within ``gap_days`` days, as one.

    Both days belong to a spell. A spell without an end is open and takes in all that begin later; one without a start, or
    that ends before it starts, is left out.
    """
    far = F.lit("9999-12-31").cast("date")
    spells = df.select(*as_columns(keys), named(start).cast("date").alias("_start"), F.coalesce(named(end).cast("date"), far).alias("_end"))
    spells = spells.filter(F.col("_start") <= F.col("_end")).groupBy(*as_columns(keys), "_start", "_end").agg(F.count(F.lit(1)).alias("_n"))
    line = Timeline.of(spells, keys, ["_start", "_end"], hot_rows)
    reached = _running(line, line.df, F.col("_end"), "_reach", total=False)
    opens = F.col("_reach").isNull() | (F.datediff("_start", "_reach") > gap_days)
    marked = materialise(reached.withColumn("_opens", opens.cast("int")), "spells")
    numbered = _running(line, marked, F.col("_opens"), "_group", total=True)
    merged = numbered.groupBy(*as_columns(keys), "_group").agg(F.min("_start").alias(start), F.max("_end").alias(end), F.sum("_n").alias("spells"))
    return merged.select(*as_columns(keys), named(start), F.nullif(named(end), far).alias(end), "spells")


def calendar(days: DataFrame, holidays: DataFrame, date: str = "date") -> DataFrame:
    """``date, working``: the number of working days up to each date, from the first to the last of ``days``.

    ``days`` has the dates that will be asked for, ``holidays`` those that are free besides Saturday and Sunday; both in
    column ``date``. A calendar has some hundred rows a year, so its running sum is taken in one place.
    """
    reach = days.agg(F.date_sub(F.min(named(date).cast("date")), 1).alias("low"), F.max(named(date).cast("date")).alias("high"))
    every = reach.filter("low is not null").select(F.explode(F.sequence("low", "high")).alias("date"))
    free = holidays.select(named(date).cast("date").alias("_free")).distinct()
    marked = every.join(free, F.col("date") == F.col("_free"), "left")
    works = ((F.weekday("date") < 5) & F.col("_free").isNull()).cast("int")
    by_year = marked.select("date", F.year("date").alias("_year"), works.alias("_works"))
    of_year = by_year.groupBy("_year").agg(F.sum("_works").alias("_sum"))
    before = of_year.select(F.col("_year").alias("_y"), F.coalesce(F.sum("_sum").over(Window.orderBy("_year").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    within = F.sum("_works").over(Window.partitionBy("_year").orderBy("date"))
    return by_year.withColumn("_within", within).join(before, F.col("_year") == F.col("_y")).select("date", (F.col("_within") + F.col("_before")).alias("working"))


def add_working_days(df: DataFrame, start: str, end: str, running: DataFrame, name: str) -> DataFrame:
    """Working days from the start to the end, both counted; null where a day is null or outside the calendar, none where the
    end comes first."""
    side = lambda day, as_: running.select(F.col("date").alias(f"_{as_}"), F.col("working").alias(f"_{as_}_n")).alias(day)
    out = df.join(side("a", "to"), named(end).cast("date") == F.col("_to"), "left")
    out = out.join(side("b", "from"), F.date_sub(named(start).cast("date"), 1) == F.col("_from"), "left")
    between = F.col("_to_n") - F.col("_from_n")
    return out.withColumn(name, F.when(between < 0, F.lit(0)).otherwise(between)).drop("_to", "_to_n", "_from", "_from_n")


def reporting_lines(df: DataFrame, person: str, manager: str, sep: str = "/") -> DataFrame:
    """``person, manager, level, top, chain, cyclic`` for every person: how many managers are above, who is at the top, and the
    way from there.

    By doubling: a step puts what is known of a manager's way before one's own, so a way of n managers takes log2(n)
    steps. A manager who is no person counts as none. The first run of steps finds level and top, which are of fixed size.
    If a step ends no way, who has not come to a top is on or under a circle: a longer way would have ended at one of its
    managers. Their level, top and chain are null. Chains are put together in a second run, from those who came to a top
    alone: round a circle a chain would double with every step. A person who comes twice is an error; one without a name
    is left out.
    """
    rows = df.filter(named(person).isNotNull()).select(named(person).cast("string").alias("_id"), named(manager).cast("string").alias("_manager"))
    rows = rows.groupBy("_id").agg(F.count(F.lit(1)).alias("_n"), F.first("_manager").alias("_manager"))
    twice = F.raise_error(F.concat(F.lit("reporting lines: more than one row for "), F.col("_id"))).cast("boolean")
    rows = rows.filter(F.when(F.col("_n") > 1, twice).otherwise(F.lit(True))).drop("_n")
    people = rows.select(F.col("_id").alias("_known"))
    rows = rows.join(people, F.col("_manager") == F.col("_known"), "left").select("_id", "_manager", F.col("_known").alias("_first"))
    rows = materialise(rows, "lines")
    levels = rows.select("_id", F.col("_first").alias("_up"), F.col("_first").isNotNull().cast("long").alias("_level"), F.coalesce("_first", "_id").alias("_top"))
    levels = _doubled(levels, {"_level": F.col("_a_level") + F.col("_level"), "_top": F.col("_a_top")})
    levels = levels.select(F.col("_id").alias("_l"), "_level", "_top", F.col("_up").isNotNull().alias("_open"))
    rows = materialise(rows.join(levels, F.col("_id") == F.col("_l")).drop("_l"), "lines")
    chains = rows.filter("not _open").select("_id", F.col("_first").alias("_up"), F.col("_id").alias("_chain"))
    chains = _doubled(chains, {"_chain": F.concat("_a_chain", F.lit(sep), "_chain")}).select(F.col("_id").alias("_c"), "_chain")
    out = rows.join(chains, F.col("_id") == F.col("_c"), "left")
    return out.select(
        F.col("_id").alias(person), F.col("_manager").alias(manager), *[F.when(~F.col("_open"), F.col(f"_{c}")).alias(c) for c in ("level", "top", "chain")],
        F.col("_open").alias("cyclic"),
    )


def _doubled(known: DataFrame, put: Mapping[str, Column]) -> DataFrame:
    """``known`` when a step ends no way any more. ``put``: a column from one's own and, with ``_a`` before the name, from that
    of the person ``_up``. Ways that came to a top are carried on as they are; only open ones are joined."""
    open_ = known.filter("_up is not null").count()
    while open_:
        done, above = known.filter("_up is null"), known.select(*[named(c).alias("_a" + c) for c in known.columns])
        met = known.filter("_up is not null").join(above, F.col("_up") == F.col("_a_id"))
        met = met.select("_id", F.col("_a_up").alias("_up"), *[c.alias(name) for name, c in put.items()])
        known = materialise(done.unionByName(met), "lines")
        before, open_ = open_, known.filter("_up is not null").count()
        if open_ == before:
            break
    return known


def staff_movements(df: DataFrame, started: str, left: str, until: str) -> DataFrame:
    """``month, starters, leavers, headcount`` from the first start to the month of ``until``; the headcount is that at the
    month's end.

    Rows are reduced to one per month of a start or an end in the map tasks; what is carried on from month to month are
    those few sums.
    """
    month = lambda c: F.trunc(named(c).cast("date"), "month")
    moves = df.filter(named(started).isNotNull()).select(
        F.explode(F.array(F.struct(month(started).alias("month"), F.lit(1).alias("in"), F.lit(0).alias("out")), F.struct(month(left).alias("month"), F.lit(0).alias("in"), F.lit(1).alias("out")))).alias("m")
    )
    sums = moves.filter("m.month is not null").groupBy("m.month").agg(F.sum("m.in").alias("in"), F.sum("m.out").alias("out"))
    sums = materialise(sums, "movements")
    months = sums.agg(F.min("month").alias("low")).filter("low is not null").select(F.explode(F.sequence("low", F.lit(until).cast("date"), F.expr("INTERVAL 1 MONTH"))).alias("month"))
    each = months.join(sums, "month", "left").select("month", F.coalesce("in", F.lit(0)).alias("starters"), F.coalesce("out", F.lit(0)).alias("leavers"))
    return each.withColumn("headcount", F.sum(F.col("starters") - F.col("leavers")).over(Window.orderBy("month")))
