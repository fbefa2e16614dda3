"""Sliced timelines give the rows of a plain window, whatever the skew."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stratalake.operators import nested
from stratalake.operators.ordered import SLICE, Timeline, along, chunk_groups, count_rows, global_id, global_id_along
from tests.conftest import rows

ORDERS = "/root/testdata/sf0.001/orders.parquet"


def skewed(spark):
    """Half of all orders under one key, some under none."""
    orders = spark.read.parquet(ORDERS)
    key = F.when(F.col("o_custkey") < 70, F.lit(1)).when(F.col("o_custkey") > 10, F.col("o_custkey"))
    key = F.when(F.col("o_orderstatus") == "P", None).otherwise(key)
    mark = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))
    return orders.select(key.alias("k"), "o_orderdate", "o_orderkey", "o_totalprice", mark.alias("m"))


@pytest.mark.parametrize("hot_rows", [40, 300, 10_000_000])
def test_same_as_plain_window(spark, hot_rows):
    df = skewed(spark)
    got = along(
        df,
        ["k"],
        ["o_orderdate", "o_orderkey"],
        previous={"p": "o_totalprice"},
        following={"n": "o_totalprice", "d": "o_orderdate"},
        next_marked={"nm": "m"},
        rank="r",
        reverse_rank="v",
        hot_rows=hot_rows,
    )
    up = Window.partitionBy("k").orderBy("o_orderdate", "o_orderkey")
    down = Window.partitionBy("k").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey"))
    want = df.withColumns(
        {
            "p": F.lag("o_totalprice").over(up),
            "n": F.lead("o_totalprice").over(up),
            "d": F.lead("o_orderdate").over(up),
            "nm": F.last("m", True).over(down.rowsBetween(Window.unboundedPreceding, -1)),
            "r": F.row_number().over(up).cast("long"),
            "v": F.row_number().over(down).cast("long"),
        }
    )
    assert got.count() == df.count()
    assert got.select(*want.columns).exceptAll(want).isEmpty()


def test_hot_key_is_cut_into_even_slices(spark):
    line = Timeline.of(skewed(spark), ["k"], ["o_orderdate", "o_orderkey"], hot_rows=50)
    sizes = [r["count"] for r in line.df.groupBy(SLICE).count().collect()]
    assert line.sliced and len(sizes) >= 20 and max(sizes) <= 100
    of_hot = line.df.filter("k = 1").select(SLICE).distinct().count()
    assert of_hot >= 5 and 1 in [r["k"] for r in line.cut.collect()]


def test_no_hot_key_means_a_plain_window(spark):
    line = Timeline.of(skewed(spark), ["k"], ["o_orderdate", "o_orderkey"])
    assert not line.sliced and SLICE not in line.df.columns


@pytest.mark.parametrize("slice_rows", [60, None])
def test_global_ids_are_dense_and_ordered(spark, slice_rows):
    orders = spark.read.parquet(ORDERS).select("o_orderdate", "o_orderkey")
    got = global_id(orders, ["o_orderdate", "o_orderkey"], "id", start=100, slice_rows=slice_rows)
    pairs = sorted((r["o_orderdate"], r["o_orderkey"], r["id"]) for r in got.collect())
    assert [p[2] for p in pairs] == list(range(101, 101 + orders.count()))


def test_all_rows_at_one_instant_are_still_cut(spark):
    df = spark.range(1000).select(F.lit(1).alias("k"), F.lit(5).alias("t"), "id")
    line = Timeline.of(df, ["k"], ["t", "id"], hot_rows=100)
    sizes = [r["count"] for r in line.df.groupBy(SLICE).count().collect()]
    assert max(sizes) < 400
    ranked = line.add(line.df, rank="r")
    assert ranked.filter("r <> id + 1").isEmpty()


def test_borders_have_two_rows_per_slice_at_most(spark):
    line = Timeline.of(skewed(spark), ["k"], ["o_orderdate", "o_orderkey"], hot_rows=50)
    borders = line._borders(line.df, {"p": "o_orderkey"}, None, None, True)
    assert borders.count() <= 2 * line.df.select(SLICE).distinct().count()


def test_cheaper_frame_is_counted_first(spark):
    df = skewed(spark)
    order = ["o_orderdate", "o_orderkey"]
    assert not Timeline.of(df, ["k"], order, 50, count_on=df.limit(10)).sliced
    assert Timeline.of(df, ["k"], order, 50, count_on=df).sliced


def test_chunks_are_full_and_whole(spark):
    out = chunk_groups(skewed(spark), ["k"], ["o_orderdate", "o_orderkey"], 10, hot_rows=50)
    sizes = out.groupBy("k", "chunk").count()
    assert out.count() == 1500 and sizes.agg({"count": "max"}).first()[0] == 10
    assert sizes.filter("k = 1 AND count < 10").count() <= 1


def test_folds_in_parts_hold_every_row_of_a_hot_key(spark):
    made = [("hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{i % 40}", i, i % 7) for i in range(600)]
    df = spark.createDataFrame(made, "k string, id long, v long")
    by_key = {}
    for k, i, v in sorted(made, key=lambda r: r[1]):
        by_key.setdefault(k, []).append((i, v))
    for hot_rows in (100, 2_000_000):
        texts = nested.rows_json_parts(df, ["k"], ["id", "v"], "text", 16, hot_rows=hot_rows).collect()
        for k, want in by_key.items():
            mine = sorted((r for r in texts if r["k"] == k), key=lambda r: r["part"])
            assert [r["part"] for r in mine] == list(range(1, mine[0]["parts"] + 1)) and mine[0]["parts"] == -(-len(want) // 16)
            lists = [json.loads(r["text"]) for r in mine]
            assert [(x["id"], x["v"]) for one in lists for x in one] == want and max(map(len, lists)) <= 16
        arrays = nested.collect_structs_parts(df, ["k"], {"id": "i", "v": "w"}, "items", 16, hot_rows=hot_rows).collect()
        assert sorted((str(r["k"]), x["i"]) for r in arrays for x in r["items"]) == sorted((str(k), i) for k, i, _ in made)
        kept = nested.collect_over_rows(df, ["k"], ["id"], {"v": "vs", "id": "ids"}, 16, hot_rows=hot_rows).collect()
        assert len(kept) == 600
        for r in kept:
            chunk = by_key[r["k"]][16 * r["chunk"] : 16 * r["chunk"] + 16]
            assert r["id"] in r["ids"] and r["ids"] == [i for i, _ in chunk] and r["vs"] == sorted(v for _, v in chunk)
        lists = nested.collect_into_parts(df.select("k", F.col("id").alias("v"), (F.col("id") % 2).alias("odd")), ["k"], "v", 16, hot_rows=hot_rows).collect()
        assert max(len(r["v"]) for r in lists) <= 16 and sorted(x for r in lists if r["k"] == "hot" and r["odd"] for x in r["v"]) == [i for i, _ in by_key["hot"]]


@pytest.mark.parametrize("slice_rows", [None, 70])
def test_ids_and_neighbours_of_one_exchange_match_those_of_two(spark, slice_rows):
    df = spark.range(900).select(
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 7 > 0, F.concat(F.lit("k"), F.col("id") % 40)).alias("k"), (F.col("id") % 50).alias("t"), "id"
    )
    args = (["k"], ["t", "h"], "n", {"until": "t", "more": F.lit(True)}, 10, {"h": F.md5(F.col("id").cast("string"))})
    one, two = (global_id_along(df, *args, hot_rows=hot, slice_rows=slice_rows) for hot in (2_000_000, 50))
    assert rows(one, "n", "k", "t", "id", "h", "until", "more") == rows(two, "n", "k", "t", "id", "h", "until", "more")
    assert [r["n"] for r in one.orderBy("n").collect()] == list(range(11, 911))


def test_keys_are_counted_by_buckets_first(spark):
    df = spark.range(30_000).withColumn("k", F.col("id") % 10_000)
    assert count_rows(df, ["k"], 100) == (30_000, False) and count_rows(df, ["k"], 2) == (30_000, True)
    assert count_rows(df, ["k"], 3) == (30_000, False) and count_rows(df.limit(0), ["k"], 3) == (0, False)
