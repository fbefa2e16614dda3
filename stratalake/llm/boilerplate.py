"""Lines that many sites share, by HyperLogLog spread per line and exact counts near the threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.keys import named
from stratalake.llm.common import free_name, id_and_text, stage, text_key

MIN_SITES = 10
SKETCH_BITS = 12
#: Share of the threshold around it within which sketches are not trusted: six times their standard error.
NEAR = 0.1


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _hash(line: Column) -> Column:
    """96 bits of the line without outer blanks."""
    bare = F.trim(line)
    return F.struct(F.xxhash64(bare).alias("a"), F.hash(bare).alias("b"))


def _occurrences(df: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """``doc_id, key, site, at, line``: one row per line that is not blank."""
    own = df.select(
        named(id_col).cast("long").alias("doc_id"),
        F.coalesce(named(text_col).cast("string"), F.lit("")).alias("text"),
        F.coalesce(named(site_col).cast("string"), F.lit("")).alias("site"),
    )
    flat = own.select("doc_id", text_key(F.col("text")).alias("key"), "site", F.posexplode(_lines(F.col("text"))).alias("at", "line"))
    return flat.filter(F.trim("line") != "").select("doc_id", "key", "site", "at", _hash(F.col("line")).alias("line"))


def spread(lines: DataFrame, min_sites: int = MIN_SITES, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """``line, first``: lines on at least ``min_sites`` distinct sites and their first occurrence (id, place).

    Sketches of sites are built in map tasks and merged per line, so a line that a third of all rows hold moves
    one small sketch per task. Lines far above the threshold are taken by their estimate, lines far below are
    left; those near it get an exact count of distinct sites, also combined before it moves.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "at"))
    sketched = lines.groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", sketch_bits)).alias("sites"), first.alias("first"))
    likely, _ = stage(sketched.filter(F.col("sites") >= min_sites * (1 - NEAR)), "line-spread")
    near = likely.filter(F.col("sites") <= min_sites * (1 + NEAR)).select("line")
    exact = lines.join(near, "line", "left_semi").select("line", "site").distinct().groupBy("line").agg(F.count(F.lit(1)).alias("exact"))
    sure = likely.join(exact, "line", "left")
    return sure.filter(F.coalesce("exact", "sites") >= min_sites).select("line", "first")


def remove_boilerplate(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES, sketch_bits: int = SKETCH_BITS
) -> DataFrame:
    """``df`` with the lines of ``text_col`` that at least ``min_sites`` sites share removed.

    The first occurrence of such a line, by id and place, stays, so that nothing vanishes from the corpus. Lines
    are compared without outer blanks; blank lines stay. All rows and columns of ``df`` stay, ``__n_lines`` and
    ``__n_removed`` are added (in place of columns of these names). A null text stays null and has no lines; a null site counts as one site of its
    own; rows with a null id come after all others in the order of occurrences. Rows that repeat an id with the
    same text lose the same lines. A text without removed lines is returned unchanged.
    """
    lines = _occurrences(df, id_col, text_col, site_col)
    shared = spread(lines, min_sites, sketch_bits)
    here = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "at")
    gone = lines.select("doc_id", "key", "at", "line").join(shared, "line").filter(here != F.col("first"))
    own_id, own_key, own_gone = (free_name(df, n) for n in ("id", "key", "gone"))
    per_text = gone.groupBy("doc_id", "key").agg(F.collect_set("at").alias(own_gone)).withColumnsRenamed({"doc_id": own_id, "key": own_key})
    text = named(text_col).cast("string")
    same = named(id_col).cast("long").eqNullSafe(F.col(own_id)) & (text_key(F.coalesce(text, F.lit(""))) == F.col(own_key))
    joined = df.join(per_text, same, "left")
    lined = _lines(text)
    stay = F.array_except(F.sequence(F.lit(0), F.size(lined) - 1), own_gone)  # by hash: in proportion to the lines
    left = F.array_join(F.transform(stay, lambda at: lined[at]), "\n")
    counts = {
        "__n_lines": F.when(text.isNull(), F.lit(0)).otherwise(F.size(lined)).cast("long"),
        "__n_removed": F.when(F.col(own_gone).isNull(), F.lit(0)).otherwise(F.size(own_gone)).cast("long"),
    }
    # Columns of these names give way to the counts.
    cleaned = joined.withColumns(counts).withColumn(text_col, F.when(F.col(own_gone).isNull(), text).otherwise(left))
    return cleaned.select(*[named(c) for c in df.columns if c not in counts], *counts)
