"""Benchmark passages in documents: winnowed fingerprints are joined, every hit is extended to whole windows.

A fingerprint is the smallest hash of ``grams`` consecutive words in a sliding window of hashes. With a window of
``words - grams + 1`` hashes every run of ``words`` words holds one, and equal runs hold the same one: no shared
span of that length is missed. A joined fingerprint is only a place to look; whole windows of words are compared.

Documents are read once, and their texts never move: a fingerprint that the benchmark has takes along the few words
around it, in which all windows that hold it lie. The benchmark's fingerprints come to the documents in slices of a
bounded size; only a benchmark of more than :data:`SLICE` fingerprints asks for further readings. Each window of a
document then meets one row at most, that of the distinct benchmark window with the same words, whatever number of items
hold it; items come in at the end.

Items shorter than a window are one window of their own, so documents are also fingerprinted at those lengths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.keys import named
from stratalake.llm.common import free_name, id_and_text, remove, stage, text_key

WORDS = 10
GRAMS = 4
#: Fingerprints of the benchmark that are broadcast at once, 16 bytes each.
SLICE = 1_000_000
#: ASCII letters and digits and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def _from_zero(last: Column) -> Column:
    """Places 0 to ``last``; none if it is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _prints(df: DataFrame, length: int, grams: int, name: str) -> DataFrame:
    """``df`` with ``name``: fingerprints and places that winnowing picks in texts of ``length`` words or more.

    Each column is a step of its own, so that a step is evaluated once for a text. The lowest bits of a hash give
    way to the place in the window, so the smallest number is the smallest hash at its first place.
    """
    spans = length - grams + 1
    bits = (spans - 1).bit_length()
    mask = (1 << bits) - 1
    gram = lambda i: F.xxhash64(*[F.col("hashes")[i + k] for k in range(grams)]).bitwiseAND(F.lit(~mask))
    out = df.withColumn("grams", F.transform(_from_zero(F.size("hashes") - grams), gram))
    window = [lambda i, k=k: F.col("grams")[i + k] + k for k in range(spans)]
    least = (lambda i: F.least(*[w(i) for w in window])) if spans > 1 else window[0]
    out = out.withColumn("least", F.transform(_from_zero(F.size("grams") - spans), lambda i: least(i)))
    place = lambda p: p.bitwiseAND(F.lit(mask)).cast("int")
    # Neighbouring windows mostly share their smallest hash: only its first window tells it.
    told = lambda p, i: F.struct(
        F.lit(length).alias("n"), F.lit(grams).alias("g"), p.bitwiseAND(F.lit(~mask)).alias("print"), (i + place(p)).alias("at"), ((i == 0) | (place(F.col("least")[i - 1]) - 1 != place(p))).alias("new")
    )
    out = out.withColumn("told", F.transform("least", told))
    return out.withColumn(name, F.filter("told", lambda x: x["new"])).drop("grams", "least", "told")


def _hashed(df: DataFrame) -> DataFrame:
    return df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))


def _found(docs: DataFrame, prints: DataFrame, lengths: dict[int, int], whole: bool) -> DataFrame:
    """``row, doc_id, key, n_words, n, start, around``: fingerprints that ``prints`` has, with the words around them from
    ``start`` on; with ``whole`` also a row without ``n`` for each document, which tells its number of words."""
    out = _hashed(docs)
    for length, grams in lengths.items():
        out = _prints(out, length, grams, f"prints_{length}")
    all_of = [F.col(f"prints_{length}") for length in lengths]
    mark = F.array(F.struct(F.lit(0).alias("n"), F.lit(0).alias("g"), F.lit(0).cast("long").alias("print"), F.lit(-1).alias("at"), F.lit(True).alias("new")))
    out = out.withColumn("prints", F.concat(mark, *all_of) if whole else F.concat(*all_of))
    # The outer form, as the optimizer would else filter by the size of arrays and compute them twice.
    out = out.select("row", "doc_id", "key", "words", F.explode_outer("prints").alias("p"))
    known = F.broadcast(prints.select(F.col("n").alias("_n"), F.col("print").alias("_print")))  # SLICE rows at most
    out = out.join(known, (F.col("p.n") == F.col("_n")) & (F.col("p.print") == F.col("_print")), "left").filter("_n is not null or p.at < 0")
    start = F.greatest(F.lit(0), F.col("p.at") - F.col("p.n") + F.col("p.g"))
    return out.select(
        "row", "doc_id", "key", F.when(F.col("p.at") < 0, F.size("words").cast("long")).alias("n_words"), F.col("_n").alias("n"),
        start.alias("start"), F.when(F.col("_n").isNotNull(), F.slice("words", start + 1, F.col("p.at") - start + F.col("p.n"))).alias("around"),
    )


def _windows(words: str, n: Column, first: Column) -> Column:
    """Windows of ``n`` words with their places, the first of which is ``first``; one row for each."""
    return F.explode(F.transform(_from_zero(F.size(words) - n), lambda i: F.struct((first + i).alias("at"), F.slice(words, i + 1, n).alias("window"))))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    words: int = WORDS,
    grams: int = GRAMS,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, key, n_words, covered, items``.

    ``covered`` has the places of the words inside an occurrence of a window of ``words`` words of an item,
    ``items`` the ids of those items as sorted strings. Items with fewer words are one window, items without
    words are none. Null texts have no words; a null item id is left out of ``items`` but its windows count.
    Rows of ``docs`` that repeat an id with the same text have the same result. Empty tables give no hits.
    """
    spark = docs.sparkSession
    items = benchmark.select(named(item_col).cast("string").alias("item_id"), F.coalesce(named(item_text).cast("string"), F.lit("")).alias("text"))
    items = items.select("item_id", words_of(F.col("text")).alias("words")).filter(F.size("words") > 0).distinct()
    items, items_path = stage(items.withColumn("n", F.least(F.size("words"), F.lit(words))), "benchmark-words")
    lengths = {r[0]: min(grams, r[0]) for r in items.select("n").distinct().collect()}  # no more than words
    of_item = items.select("item_id", _windows("words", F.col("n"), F.lit(0)).alias("w")).select("item_id", "w.window")
    windows, windows_path = stage(of_item.groupBy("window").agg(F.collect_set("item_id").alias("items")).withColumn("wid", F.monotonically_increasing_id()), "benchmark-windows")
    prints = None
    for length, g in lengths.items():
        picked = _prints(_hashed(items.filter(F.col("n") == length)), length, g, "prints")
        picked = picked.select(F.explode_outer("prints").alias("p")).filter("p is not null").select("p.n", "p.print").distinct()
        prints = picked if prints is None else prints.union(picked)
    if prints is None:
        prints = spark.createDataFrame([], "n int, print long")
    prints, prints_path = stage(prints, "benchmark-prints")
    slices = -(-prints.count() // SLICE) or 1
    own = id_and_text(docs, id_col, text_col).withColumn("key", text_key(F.col("text"))).withColumn("row", F.monotonically_increasing_id())
    own = own.select("row", "doc_id", "key", words_of(F.col("text")).alias("words"))
    met, paths = None, []
    for k in range(slices):
        part, path = stage(_found(own, prints.filter(F.pmod(F.xxhash64("print"), slices) == k), lengths, k == 0), "hits")
        met, paths = part if met is None else met.unionByName(part), [*paths, path]
    # Extension: every window around a fingerprint is compared, word by word, with the distinct windows of the benchmark.
    near = met.filter("n is not null").select("doc_id", "key", "n", _windows("around", F.col("n"), F.col("start")).alias("w"))
    true = near.select("doc_id", "key", "n", "w.at", "w.window").distinct().join(windows.select("window", "wid"), "window").drop("window")
    true, true_path = stage(true, "windows-met")
    places = F.array_distinct(F.flatten(F.collect_set(F.sequence("at", F.col("at") + F.col("n") - 1)))).alias("covered")
    covered = true.groupBy("doc_id", "key").agg(places)
    named_by = true.select("doc_id", "key", "wid").distinct().join(windows.select("wid", F.explode("items").alias("item_id")), "wid")
    named_by = named_by.select("doc_id", "key", "item_id").distinct().groupBy("doc_id", "key").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    renamed = [d.withColumnsRenamed({"doc_id": f"_d{i}", "key": f"_k{i}"}) for i, d in enumerate((covered, named_by))]
    out = met.filter("n_words is not null")
    for i, d in enumerate(renamed):
        out = out.join(d, F.col("doc_id").eqNullSafe(F.col(f"_d{i}")) & (F.col("key") == F.col(f"_k{i}")), "left")
    out, _ = stage(out.select(
        "doc_id", "key", "n_words",
        F.coalesce("covered", F.array().cast("array<int>")).alias("covered"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    ), "contamination")
    remove(spark, items_path, windows_path, prints_path, true_path, *paths)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", words: int = WORDS, grams: int = GRAMS) -> DataFrame:
    """The rows of ``docs`` without any word inside an occurrence of a benchmark window, all columns kept."""
    hit = contamination(docs, benchmark, id_col, text_col, item_col, item_text, words, grams).filter(F.size("covered") > 0)
    own_id, own_key = free_name(docs, "id"), free_name(docs, "key")
    hit = hit.select(F.col("doc_id").alias(own_id), F.col("key").alias(own_key)).distinct()
    same = named(id_col).cast("long").eqNullSafe(F.col(own_id)) & (text_key(F.coalesce(named(text_col).cast("string"), F.lit(""))) == F.col(own_key))
    return docs.join(hit, same, "left_anti")
