from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators import ingest, joins, merge, quality, sets
from stratalake.sources import files, sinks
from tests.conftest import plan, rows

TARGET = [(1, "a", "x"), (2, "b", "x"), (3, "c", "x"), (None, "n", "x")]


def target(spark):
    return spark.createDataFrame(TARGET, "k int, v string, w string")


def changes(spark, data):
    return spark.createDataFrame(data, "k int, v string, act string")


def test_merge_applies_each_action(spark):
    ch = changes(spark, [(1, "A", "Update"), (2, "B", "deleted"), (3, "C", "create"), (4, "D", "Created"), (5, "E", "update"), (6, "F", "delete")])
    out = merge.merge_actions(target(spark), ch, ["k"], "act")
    assert rows(out) == [(1, "A", "x"), (3, "c", "x"), (4, "D", None), (None, "n", "x")]


def test_merge_updates_the_listed_columns_only(spark):
    ch = spark.createDataFrame([(1, "A", "y", "update"), (9, "Z", "y", "create")], "k int, v string, w string, act string")
    out = merge.merge_actions(target(spark), ch, ["k"], "act", ["w"])
    assert rows(out.filter("k IN (1, 9)")) == [(1, "a", "y"), (9, "Z", "y")]


def test_merge_adds_new_columns(spark):
    ch = spark.createDataFrame([(1, "new", "update")], "k int, extra string, act string")
    out = merge.merge_actions(target(spark), ch, ["k"], "act")
    assert rows(out, "k", "v", "extra") == [(1, "a", "new"), (2, "b", None), (3, "c", None), (None, "n", None)]


def test_unknown_action_fails(spark):
    with pytest.raises(Exception, match="unknown row action"):
        merge.merge_actions(target(spark), changes(spark, [(1, "A", "upsert")]), ["k"], "act").collect()


def test_two_changes_for_one_row_fail(spark):
    with pytest.raises(Exception, match="more than one change"):
        merge.merge_actions(target(spark), changes(spark, [(1, "A", "update"), (1, "B", "update")]), ["k"], "act").collect()


def test_two_changes_for_no_row_and_null_keyed_creates_are_fine(spark):
    ch = changes(spark, [(8, "A", "update"), (8, "B", "update"), (None, "p", "create"), (None, "q", "create")])
    assert merge.merge_actions(target(spark), ch, ["k"], "act").count() == 6


def test_missing_key_column_fails_early(spark):
    with pytest.raises(ValueError, match="missing in the target"):
        merge.merge_actions(target(spark).drop("k"), changes(spark, []), ["k"], "act")


def test_labels(spark):
    new = spark.createDataFrame([(1, ["a"]), (2, ["b", "c"]), (3, ["z"]), (None, ["n"])], "k int, v array<string>")
    old = spark.createDataFrame([(1, ["a"]), (2, ["b"])], "k int, v array<string>")
    out = merge.label_changes(new, old, "k", "act")
    assert rows(out, "k", "act") == [(2, "update"), (3, "create")]
    assert rows(merge.hash_upsert(new, old, "k"), "k") == [(1,), (2,), (3,)]


def test_an_upsert_replaces_what_differs_in_one_join(spark):
    old = spark.createDataFrame([(1, "a", "n1"), (2, "b", "n2"), (2, "bb", "n3"), (None, "x", "n4")], "k int, v string, note string")
    new = spark.createDataFrame([(1, "a", 9), (2, "B", 9), (3, "c", 9), (3, "c", 8), (None, "y", 9)], "k long, v string, extra int")
    shaped = old.withColumn("extra", F.lit(9))
    out = merge.hash_upsert(new, shaped, "k")
    assert rows(out, "k", "v", "note", "extra") == [(1, "a", "n1", 9), (2, "B", "n2", 9), (2, "B", "n3", 9), (3, "c", None, 8), (3, "c", None, 9), (None, "x", "n4", 9)]
    assert plan(out).count("Scan ExistingRDD") <= 2
    same = new.unionByName(spark.createDataFrame([(1, "a", 9)], new.schema))
    assert merge.hash_upsert(same, shaped, "k").count() == 6
    with pytest.raises(Exception, match="more than one change"):
        merge.hash_upsert(new.unionByName(spark.createDataFrame([(2, "C", 9)], new.schema)), shaped, "k").collect()
    aligned = merge.aligned_upsert(new.withColumn("v", F.upper("v")), old, "k")
    assert aligned.columns == old.columns and rows(aligned, "k", "v", "note")[0] == (1, "A", "n1")


HISTORY = "k string, message_id string, IngestionDate string, ValidTo string, IsActive string"


def test_message_reconcile(spark):
    old = spark.createDataFrame(
        [("a", "1", "2025-01-01", None, "Y"), ("b", "2", "2025-01-01", None, "Y"), ("b", "0", "2024-01-01", "2025-01-01", "N"), ("c", "3", "2025-01-01", None, "Y")],
        HISTORY,
    )
    new = spark.createDataFrame(
        [("a", "4", "2025-02-01", None, "Y", "update"), ("a", "5", "2025-03-01", None, "Y", "update"), ("b", "6", "2025-02-02", None, "Y", "delete"), ("d", "7", "2025-02-01", None, "Y", "create"), ("d", "7", "2025-02-01", None, "Y", "create")],
        HISTORY + ", act string",
    )
    out = merge.reconcile_messages(old, new, "k", "act")
    assert rows(out, "message_id", "ValidTo", "IsActive") == [
        ("0", "2025-01-01", "N"),
        ("1", "2025-02-01", "N"),
        ("2", "2025-02-02", "N"),
        ("3", None, "Y"),
        ("4", None, "Y"),
        ("5", None, "Y"),
        ("7", None, "Y"),
    ]


def test_message_types(spark):
    df = spark.createDataFrame([(m,) for m in ("Create", "update", "Update", "Publish", "Unpublish", "Delete", "create")], "m string")
    got = dict(rows(df.select("m", merge.message_action("m"))))
    assert got == {"Create": "create", "update": "update", "Update": "update", "Publish": "update", "Unpublish": "update", "Delete": "delete", "create": "delete"}


def test_reconcile_refuses_ambiguous_keys(spark):
    std = spark.createDataFrame([(1, "m"), (2, "m"), (None, "m")], "k int, v string")
    raw = spark.createDataFrame([(1, "one"), (3, "x")], "k int, v string")
    assert rows(joins.reconcile(std, raw, ["k"], ["v"])) == [(1, "one"), (2, "m"), (None, "m")]
    with pytest.raises(Exception, match="not unique"):
        joins.reconcile(std, raw.unionByName(raw), ["k"], ["v"]).collect()


def test_constants_need_one_row(spark):
    df = spark.range(3)
    one = spark.createDataFrame([(7, "x")], "a int, b string")
    assert rows(joins.attach_constants(df, one)) == [(0, 7, "x"), (1, 7, "x"), (2, 7, "x")]
    assert rows(joins.attach_constants(df, one.filter("a = 0")), "a") == [(None,)] * 3
    with pytest.raises(Exception):
        joins.attach_constants(df, one.unionByName(one)).collect()


def test_temporal_anti(spark):
    a = spark.createDataFrame([("x", 1), ("x", 3), ("y", 9), (None, 1)], "k string, t int")
    b = spark.createDataFrame([("x", 3), ("x", 2), ("z", 1)], "k string, t int")
    assert rows(joins.without_from(a, b, "k", "t", "t")) == [("x", 1), ("y", 9), (None, 1)]


def test_multiset_diff(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "v int")
    b = spark.createDataFrame([(1,), (3,)], "v int")
    assert rows(sets.multiset_diff(a, b), "v", "side", "copies") == [(1, "missing", 1), (2, "missing", 1), (3, "unexpected", 1)]
    with pytest.raises(ValueError, match="schemas differ"):
        sets.multiset_diff(a, b.withColumn("w", F.lit(1)))


def test_run_log(spark):
    start = datetime(2025, 1, 1)
    empty = spark.createDataFrame([], quality.RUN_SCHEMA)
    run = spark.createDataFrame([("r", "e", "s", "{}", start, None, None, None)], quality.RUN_SCHEMA)
    log = quality.log_runs(empty, run.withColumn("row_action", F.lit("create")))
    done = run.withColumns({"successful": F.lit(True), "result_text": F.lit("ok"), "execution_parameters": F.lit("new"), "row_action": F.lit("update")})
    log = quality.log_runs(log, done)
    assert rows(quality.runs_of(log, "r", "e", "s"), "successful", "result_text", "execution_parameters") == [(True, "ok", "{}")]


def test_tables_grow_columns_and_swap(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_sinks")
    sinks.append_or_create(spark.createDataFrame([(1,)], "a int"), "t_sinks.grow")
    sinks.append_or_create(spark.createDataFrame([("x", 2)], "b string, a int"), "t_sinks.grow")
    sinks.append_or_create(spark.createDataFrame([("y",)], "b string"), "t_sinks.grow")
    assert rows(spark.table("t_sinks.grow"), "a", "b") == [(1, None), (2, "x"), (None, "y")]
    sinks.delete_rows(spark, "t_sinks.grow", F.col("a") == 1)
    assert rows(spark.table("t_sinks.grow"), "a", "b") == [(2, "x"), (None, "y")]
    sinks.empty_table(spark, "t_sinks.grow")
    assert spark.table("t_sinks.grow").isEmpty()
    with pytest.raises(ValueError, match="unknown kind"):
        sinks.write_all([sinks.WriteSpec(spark.range(1), "x", "nowhere")])


def test_merge_takes_nested_values_whether_nulls_are_promised_or_not(spark):
    strict = spark.range(2).select("id", F.array(F.struct(F.lit(1).alias("a"))).alias("v"))
    loose = spark.createDataFrame([(1, [(2,)], "update"), (5, [None], "create")], "id bigint, v array<struct<a: int>>, act string")
    assert merge.merge_actions(strict, loose, ["id"], "act").count() == 3
    assert merge.hash_upsert(strict, loose.drop("act"), "id").count() == 3


def test_a_first_load_checks_actions_too(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_sinks")
    wrong = spark.createDataFrame([(1, "create"), (2, "upsert")], "id int, act string")
    with pytest.raises(Exception, match="unknown row action"):
        sinks.merge_table(wrong, "t_sinks.first_load", ["id"], "act")


def test_landed_files_with_blanks_are_missing_only_once(spark, tmp_path):
    root = tmp_path / "land dir+100%"
    root.mkdir()
    for n in range(3):
        (root / f"m {n}%20+.json").write_text('{"a": %d}' % n)
    loaded = files.read_messages(spark, str(root), T.StructType([T.StructField("a", T.LongType())]))
    assert loaded.count() == 3 and ingest.missing_files(files.list_files(spark, str(root)), loaded).count() == 0
    assert ingest.missing_files(files.list_files(spark, str(root)), loaded.filter("a = 1")).count() == 2
