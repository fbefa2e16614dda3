"""Exact top-k search by inner product with a three-phase uniform threshold.

Components become whole numbers, and a vector's components are dealt to a few *lists*; a score is the sum of its partial
scores, one from each list. Equal vectors are one class, which keeps its ``k + 1`` smallest ids, so a vector with
many copies counts once.

1. Every list names, for each query, the classes with its highest partial scores. Their whole scores are resolved; the
   one in place ``k + 1`` is a safe cutoff: at least as many rows score no less.
2. The cutoff goes back to the lists. A score reaches it only if a partial score reaches the cutoff divided by the number
   of lists, so each list gives all its entries from there on.
3. What no list has given for a class that another list has named is looked up, and the sums are exact.

Candidates and queries are packed into blocks of a bounded number of rows, and every list meets each block of queries
with each block of candidates once: a stated set of queries against all rows. Only entries beyond the cutoff move.

Defined results: a vector that is null, or holds a null or a component that is not finite, takes no part; a shorter
vector has zeros behind it; ties go to the smaller id, a null id comes last; a repeated row is a row of its own, and a
query leaves out itself alone; an empty table gives no rows. Other columns are not read. Scores that do not fit 62
bits raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions.keys import named
from stratalake.llm.common import arrow_rows, remove, stage, tidy_shuffles

SCALE = 256
LISTS = 2
#: Entries that a list names for each query in the first phase, for each row wanted. The cutoff is safe at any depth;
#: deeper lists find a higher one, so that fewer entries reach it.
DEPTH = 6
#: Rows in a block of candidates, and in a block of queries.
CANDIDATES, QUERIES = 16384, 512
#: Rows of a query block that meet a candidate block at once.
AT_ONCE = 256
#: Cells of the grid in an Arrow batch; one holds a block of either side.
CELLS = 8
#: Below the negative of this lies no score.
NO_CUT = 2**62
ENTRY = "g int, q int, c long, part int, p long"
_ENTRY = pa.schema([("g", pa.int32()), ("q", pa.int32()), ("c", pa.int64()), ("part", pa.int32()), ("p", pa.int64())])


def whole(vector: Column, scale: int = SCALE) -> Column:
    """Components as ``floor(scale * x)``; null where the vector takes no part."""
    scaled = F.transform(vector, lambda x: x.cast("double") * scale)
    fine = F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # Doubles from 2^53 on are whole numbers.
    return F.when(fine, F.transform(scaled, lambda x: F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)))


def _classes(rows: DataFrame, keep: int) -> DataFrame:
    """``v, ids, asked``: distinct vectors with their smallest ids; a third of the rows may be one vector."""
    order = Window.partitionBy("v", "asked").orderBy(F.col("id").asc_nulls_last())
    few = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)
    id_order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"))
    ids = F.slice(F.array_sort(F.collect_list(id_order)), 1, keep)  # at most 2 * keep are collected
    return few.groupBy("v").agg(F.transform(ids, lambda x: x["id"]).alias("ids"), F.max("asked").alias("asked"))


def _numbered(classes: DataFrame, blocks: int, salt: int) -> DataFrame:
    """``block, place``: dealt by the vector's hash; the place is the same in every attempt."""
    dealt = classes.withColumn("block", F.pmod(F.xxhash64("v", F.lit(salt)), blocks).cast("int"))
    return dealt.withColumn("place", F.row_number().over(Window.partitionBy("block").orderBy("v")) - 1)


def _packed(numbered: DataFrame, width: int, lists: int, block: str) -> DataFrame:
    """``block, part, matrix``: the components of one list for the rows of a block, in order of their places."""
    schema = pa.schema([(block, pa.int32()), ("part", pa.int32()), ("matrix", pa.binary())])

    def pack(key: tuple, t: pa.Table) -> pa.Table:
        rows = t.column("v").to_pylist()
        m = np.zeros((len(rows), width))
        for place, v in zip(t.column("place").to_pylist(), rows):
            m[place, : len(v)] = v
        parts = np.array_split(np.arange(width), lists)
        small = np.float32 if np.abs(m).max(initial=0) < 2**24 else np.float64
        head = np.dtype(small).char.encode()
        data = [head + np.ascontiguousarray(m[:, p], small).tobytes() for p in parts]
        return pa.Table.from_arrays([pa.array([key[0].as_py()] * lists, pa.int32()), pa.array(range(lists), pa.int32()), pa.array(data, pa.binary())], schema=schema)

    return numbered.select(F.col("block").alias(block), "place", "v").groupBy(block).applyInArrow(pack, f"{block} int, part int, matrix binary")


class _Product:
    """Partial scores of query rows with candidate rows, exact: floats up to 2^53, whole numbers beyond."""

    def __init__(self, most: float, width: int, lists: int) -> None:
        self.widths = [len(p) for p in np.array_split(np.arange(width), lists)]
        self.kind = np.float64 if most * most * width < 2**53 else np.int64

    def rows(self, data: bytes, part: int) -> np.ndarray:
        return np.frombuffer(data, np.dtype(chr(data[0])), offset=1).reshape(-1, self.widths[part]).astype(self.kind)


def _entries(cells: DataFrame, product: _Product, keep: int | None, lists: int) -> DataFrame:
    """Entries of each list: the ``keep`` highest for each query, or all from the cutoff on where ``cuts`` has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                cell = {n: b.column(i)[row].as_py() for i, n in enumerate(b.schema.names)}
                part = cell["part"]
                candidates, queries = product.rows(cell["c_matrix"], part), product.rows(cell["q_matrix"], part)
                for at in range(0, len(queries), AT_ONCE):
                    p = queries[at : at + AT_ONCE] @ candidates.T
                    if keep is None:
                        cuts = np.array(cell["cuts"][at : at + AT_ONCE], np.int64)
                        q, c = np.nonzero(p.astype(np.int64) * lists >= cuts[:, None])
                    else:
                        best = np.argpartition(-p, min(keep, p.shape[1]) - 1, axis=1)[:, :keep]
                        q, c = np.repeat(np.arange(len(p)), best.shape[1]), best.ravel()
                    n = len(q)
                    columns = [np.full(n, cell["g"], np.int32), (q + at).astype(np.int32), (np.int64(cell["block"]) << 32) + c, np.full(n, part, np.int32), p[q, c].astype(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], schema=_ENTRY)

    return cells.mapInArrow(run, ENTRY)


def _lookup(wanted: DataFrame, cells: DataFrame, product: _Product) -> DataFrame:
    """Partial scores for ``g, q, c, part``; those of one cell travel together, no more than the cell has pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                cell = {n: b.column(i)[row] for i, n in enumerate(b.schema.names)}
                part = cell["part"].as_py()
                candidates, queries = product.rows(cell["c_matrix"].as_py(), part), product.rows(cell["q_matrix"].as_py(), part)
                pairs = cell["pairs"].values.to_numpy()
                for at in range(0, len(pairs), 1 << 16):
                    some = pairs[at : at + (1 << 16)]
                    q, c = some >> 32, some & 0xFFFFFFFF
                    n, p = len(some), np.einsum("ij,ij->i", queries[q], candidates[c])
                    columns = [np.full(n, cell["g"].as_py(), np.int32), q.astype(np.int32), (np.int64(cell["block"].as_py()) << 32) + c, np.full(n, part, np.int32), p.astype(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], schema=_ENTRY)

    low = F.col("c").bitwiseAND(0xFFFFFFFF)
    pair = F.shiftleft(F.col("q").cast("long"), 32) + low
    asked = wanted.groupBy("part", F.shiftright("c", 32).cast("int").alias("block"), "g").agg(F.collect_list(pair).alias("pairs"))
    return cells.join(asked, ["part", "block", "g"]).mapInArrow(run, ENTRY)


def _best(scored: DataFrame, keep: int) -> DataFrame:
    """Classes of each query whose score is among its ``keep`` highest, ties all kept."""
    order = Window.partitionBy("g", "q").orderBy(F.desc("score"))
    return scored.withColumn("place", F.rank().over(order)).where(F.col("place") <= keep).drop("place")


def search(
    df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, lists: int = LISTS
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that ``is_query`` names, its ``k`` best of all other rows."""
    spark, keep = df.sparkSession, k + 1
    asked = F.coalesce(is_query, F.lit(False))
    rows = df.select(named(id_col).cast("long").alias("id"), whole(named(vector_col), scale).alias("v"), asked.alias("asked")).where("v IS NOT NULL")
    with tidy_shuffles(spark), arrow_rows(spark, CELLS):
        classes, classes_at = stage(_classes(rows, keep), "vector-classes")
        size = classes.agg(
            F.count("*").alias("n"), F.count_if("asked").alias("asked"), F.max(F.size("v")).alias("width"), F.max(F.array_max(F.transform("v", F.abs))).alias("most")
        ).first()
        width, most = max(1, size["width"] or 0), size["most"] or 0.0
        lists = min(lists, width)
        if most * most * width * lists >= NO_CUT:
            raise ValueError("inner products of these vectors do not fit 62 bits")
        blocks, groups = -(-size["n"] // CANDIDATES) or 1, -(-size["asked"] // QUERIES) or 1
        product = _Product(most, width, lists)
        numbered, numbered_at = stage(_numbered(classes, blocks, 0), "vector-numbers")
        asked_classes, asked_at = stage(_numbered(classes.where("asked"), groups, 1), "vector-queries")
        candidates, candidates_at = stage(_packed(numbered, width, lists, "block").withColumnRenamed("matrix", "c_matrix"), "vector-blocks")
        queries, queries_at = stage(_packed(asked_classes, width, lists, "g").withColumnRenamed("matrix", "q_matrix"), "query-blocks")

        def cells(of_queries: DataFrame) -> DataFrame:
            left = candidates.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
            return left.join(of_queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))), ["part", "block", "g"])

        def summed(entries: DataFrame) -> DataFrame:
            return entries.groupBy("g", "q", "c").agg(F.sum("p").alias("score"), F.expr("bit_or(shiftleft(1, part))").alias("seen"))

        def absent(named_in: DataFrame) -> DataFrame:
            every = F.array(*[F.lit(i) for i in range(lists)])
            parts = F.filter(every, lambda i: F.expr("seen").bitwiseAND(F.call_function("shiftleft", F.lit(1), i)) == 0)
            return named_in.select("g", "q", "c", F.explode(parts).alias("part"))

        def exact(named_in: DataFrame, name: str) -> tuple[DataFrame, list[str]]:
            written, at = stage(named_in, name)
            rest = _lookup(absent(written), cells(queries), product).select("g", "q", "c", F.col("p").alias("score"))
            scored = written.select("g", "q", "c", "score").unionByName(rest).groupBy("g", "q", "c").agg(F.sum("score").alias("score"))
            return scored, [at]

        # 1: local lists and a safe cutoff
        local = _entries(cells(queries), product, keep * DEPTH, lists)
        highest = Window.partitionBy("g", "q", "part").orderBy(F.desc("p"), "c")
        local = local.withColumn("place", F.row_number().over(highest)).where(F.col("place") <= keep * DEPTH)
        first, gone = exact(summed(local), "first-entries")
        nth = F.row_number().over(Window.partitionBy("g", "q").orderBy(F.desc("score")))
        cutoff = first.withColumn("place", nth).where(F.col("place") <= keep).groupBy("g", "q").agg(F.min("score").alias("cut"), F.count("*").alias("n"))
        cutoff = cutoff.select("g", "q", F.when(F.col("n") == keep, F.col("cut")).otherwise(F.lit(-NO_CUT)).alias("cut"))
        cuts = F.transform(F.array_sort(F.collect_list(F.struct("q", "cut"))), lambda x: x["cut"])
        with_cuts, cuts_at = stage(queries.join(cutoff.groupBy("g").agg(cuts.alias("cuts")), "g"), "query-cutoffs")
        # 2: all entries from the cutoff on, 3: what is missing
        scored, also = exact(summed(_entries(cells(with_cuts), product, None, lists)), "entries")
        best, best_at = stage(_best(scored, keep), "best-classes")
        result, _ = stage(_by_row(rows, numbered, asked_classes, best, k), "nearest")
        remove(spark, classes_at, numbered_at, asked_at, candidates_at, queries_at, cuts_at, best_at, *gone, *also)
    return result


def _by_row(rows: DataFrame, numbered: DataFrame, asked: DataFrame, best: DataFrame, k: int) -> DataFrame:
    """From classes back to rows: each query without itself."""
    class_of = (F.shiftleft(F.col("block").cast("long"), 32) + F.col("place")).alias("c")
    entry = F.struct((-F.col("score")).alias("order"), F.col("id").isNull().alias("none"), "id", "c")
    members = best.join(numbered.select(class_of, F.posexplode("ids").alias("copy", "id")), "c")
    order = Window.partitionBy("g", "q").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "c", "copy")
    members = members.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    found = members.groupBy("g", "q").agg(F.array_sort(F.collect_list(entry)).alias("found"))  # k + 1 entries
    own = asked.select(F.col("block").alias("g"), F.col("place").alias("q"), "v").join(numbered.select(class_of, "v"), "v")
    found = own.join(found, ["g", "q"]).select("v", F.col("c").alias("own"), "found")
    each = rows.where("asked").select(F.col("id").alias("query_id"), "v").join(found, "v")
    itself = F.expr("array_position(transform(found, x -> x.c = own AND x.id <=> query_id), true)")
    others = F.slice(F.filter("found", lambda x, i: i + 1 != itself), 1, k)
    picked = each.select("query_id", F.posexplode(others).alias("at", "x"))
    return picked.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.order")).alias("score"))
