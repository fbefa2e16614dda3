"""Tables keep their layout when they are swapped, merged and cut down, and survive a death half way."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from stratalake.operators import merge
from stratalake.sources import sinks
from tests.conftest import rows

ROWS = [(1, "a", "x"), (2, "b", "x"), (3, "c", "y"), (4, "d", None), (5, "e", "it's")]


@pytest.fixture(params=["managed", "external"])
def parted(request, spark, tmp_path):
    """A partitioned table, its path if it has one of its own, and the files of each partition."""
    spark.sql("CREATE DATABASE IF NOT EXISTS t_sinks")
    name = f"t_sinks.{request.param}_{request.node.name.split('[')[0]}"
    path = str(tmp_path / "own place") if request.param == "external" else None
    sinks.write_table(spark.createDataFrame(ROWS, "k int, v string, p string"), name, path, partition_by="p")
    return name, path


def files_of(spark, table):
    found = spark.table(table).select("p", F.col("_metadata.file_path").alias("f")).distinct().collect()
    return {p: {r["f"] for r in found if r["p"] == p} for p in {r["p"] for r in found}}


def check_layout(spark, table, path):
    now = sinks.layout(spark, table)
    assert now.partition_by == ("p",) and now.fmt == "parquet"
    assert (now.path is None) == (path is None) and (path is None or now.path.replace("%20", " ").endswith(path))
    assert not sinks.table_exists(spark, f"{table}_tmp")


def test_merge_rewrites_touched_partitions_only(spark, parted):
    table, path = parted
    before = files_of(spark, table)
    changes = [(1, "A", "x", "update"), (3, "c", "y", "delete"), (6, "f", "new", "create"), (2, "no", "z", "create"), (9, "n", "none", "update"), (5, "E", "moved", "update")]
    sinks.merge_table(spark.createDataFrame(changes, "k int, v string, p string, act string"), table, ["k"], "act")
    assert rows(spark.table(table)) == [(1, "A", "x"), (2, "b", "x"), (4, "d", None), (5, "E", "moved"), (6, "f", "new")]
    assert files_of(spark, table)[None] == before[None] and not files_of(spark, table)["x"] & before["x"]
    check_layout(spark, table, path)


def test_merge_reaches_null_partitions_and_adds_columns(spark, parted):
    table, path = parted
    changes = spark.createDataFrame([(4, "D", 1, "update"), (7, "g", 2, "create")], "k int, v string, extra int, act string")
    sinks.merge_table(changes, table, ["k"], "act")
    assert rows(spark.table(table).filter("p IS NULL"), "k", "v", "extra") == [(4, "D", 1), (7, "g", 2)]
    assert spark.table(table).count() == 6
    check_layout(spark, table, path)


def test_wrong_actions_leave_the_table_alone(spark, parted):
    table, path = parted
    before = files_of(spark, table)
    with pytest.raises(Exception, match="unknown row action"):
        sinks.merge_table(spark.createDataFrame([(1, "A", "x", "upsert")], "k int, v string, p string, act string"), table, ["k"], "act")
    assert files_of(spark, table) == before


def test_delete_rewrites_touched_partitions_only(spark, parted):
    table, path = parted
    before = files_of(spark, table)
    sinks.delete_rows(spark, table, F.col("k").isin(1, 4, 5))
    assert rows(spark.table(table)) == [(2, "b", "x"), (3, "c", "y")] and files_of(spark, table)["y"] == before["y"]
    sinks.delete_rows(spark, table, F.lit(False))
    sinks.empty_table(spark, table)
    assert spark.table(table).isEmpty()
    check_layout(spark, table, path)


def test_swap_keeps_layout_and_properties(spark, parted):
    table, path = parted
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('kept' = 'yes')")
    sinks.swap_table(spark.table(table).filter("k < 3").drop("v"), table)
    assert rows(spark.table(table), "k", "p") == [(1, "x"), (2, "x")] and spark.table(table).columns == ["k", "p"]
    assert sinks.layout(spark, table).properties.get("kept") == "yes"
    check_layout(spark, table, path)


@pytest.mark.parametrize("dies_at", ["written", "dropped"])
def test_a_swap_that_died_is_finished_or_undone(spark, parted, monkeypatch, dies_at):
    table, path = parted
    whole = sinks._finish_swap

    def dies(spark, name):
        if dies_at == "dropped":
            spark.sql(f"DROP TABLE {name}")
        raise KeyboardInterrupt

    monkeypatch.setattr(sinks, "_finish_swap", dies)
    with pytest.raises(KeyboardInterrupt):
        sinks.swap_table(spark.table(table).filter("k < 3"), table)
    monkeypatch.setattr(sinks, "_finish_swap", whole)
    # The staged copy may be half copied, so it wins.
    assert sinks.recover_table(spark, table) and spark.table(table).count() == 2
    check_layout(spark, table, path)
    assert not sinks.recover_table(spark, table)


def test_a_renamed_swap_that_died_is_finished_or_undone(spark, monkeypatch):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_sinks")
    for drop, left in ((False, 5), (True, 2)):
        table = f"t_sinks.plain_{left}"
        sinks.write_table(spark.range(5).toDF("k"), table)
        with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
            m.setattr(sinks, "_finish_swap", lambda s, t: (drop and s.sql(f"DROP TABLE {t}"), (_ for _ in ()).throw(KeyboardInterrupt)))
            sinks.swap_table(spark.table(table).filter("k < 2"), table)
        assert sinks.recover_table(spark, table) == drop and spark.table(table).count() == left


def test_a_frame_of_a_half_swapped_table_is_refused(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_sinks")
    sinks.write_table(spark.range(3).toDF("k"), "t_sinks.half_tmp")
    with pytest.raises(RuntimeError, match="half swapped"):
        sinks.swap_table(spark.range(5).toDF("k"), "t_sinks.half")
    assert spark.table("t_sinks.half").count() == 3


def test_a_swap_is_one_write_and_one_change_of_the_catalogue(spark, parted, monkeypatch):
    table, path = parted
    sinks.swap_table(spark.table(table), table)  # from now on its folder tells the partitions
    if path is None:
        sinks.swap_table(spark.table(table), table)  # out of the folder of its name, which a dropped table must not leave
    writes, statements, read = [], [], spark.table(table)
    written, run = sinks.write_table, type(spark).sql
    monkeypatch.setattr(sinks, "write_table", lambda *a, **k: (writes.append(a), written(*a, **k)))

    def told(self, statement, *a, **k):
        if "SET LOCATION" in statement or "DROP TABLE" in statement and not statement.endswith("_tmp"):
            statements.append((statement.split()[3], spark.table(table).count()))
        return run(self, statement, *a, **k)

    monkeypatch.setattr(type(spark), "sql", told)
    sinks.swap_table(spark.table(table).filter("k < 3"), table)
    assert len(writes) == 1 and statements == [("SET", 5)]
    assert rows(spark.table(table)) == ROWS[:2] and rows(read) == rows(spark.createDataFrame(ROWS, read.schema))
    sinks.swap_table(spark.table(table).filter("k < 2"), table)
    sinks.swap_table(spark.table(table), table)
    assert rows(spark.table(table)) == ROWS[:1]
    check_layout(spark, table, path)


def test_swaps_of_a_plain_table_leave_no_old_rows_behind(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_sinks")
    for _ in range(2):
        sinks.write_table(spark.range(9).toDF("k"), "t_sinks.again")
        for n in (7, 5, 3):
            sinks.swap_table(spark.table("t_sinks.again").filter(f"k < {n}"), "t_sinks.again")
            assert spark.table("t_sinks.again").count() == n
        assert sinks.layout(spark, "t_sinks.again").path is None
        sinks.drop_table(spark, "t_sinks.again")


def test_deleting_many_partitions_runs_as_few_jobs_as_one(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_sinks")
    jobs = []
    for n in (3, 60):
        table = f"t_sinks.many_{n}"
        sinks.write_table(spark.range(2 * n).selectExpr("id AS k", f"id % {n} AS p"), table, partition_by="p")
        before, group = files_of(spark, table), f"delete {n}"
        spark.sparkContext.setJobGroup(group, "")
        sinks.delete_rows(spark, table, (F.col("p") < n - 1) | (F.col("k") == 2 * n - 1))
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert rows(spark.table(table)) == [(n - 1, n - 1)]
        assert not {f for p, fs in files_of(spark, table).items() for f in fs} & {f for p, fs in before.items() if p != n - 1 for f in fs}
    assert jobs[0] == jobs[1]


@pytest.mark.parametrize("buckets", [1, 4, 64])
def test_a_batch_rewrites_the_buckets_it_hits(spark, buckets):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_sinks")
    table, keys = f"t_sinks.buckets_{buckets}", ["k", "j"]
    first = spark.range(200).selectExpr("id AS k", "id % 3 AS j", "'old' AS v", "'create' AS act")
    sinks.merge_table(first, table, keys, "act", buckets=buckets)
    file = F.col("_metadata.file_path").alias("f")
    before = {r["f"]: r[sinks.BUCKET] for r in spark.table(table).select(file, sinks.BUCKET).distinct().collect()}
    changes = [(3, 0, "new", "update"), (4, 1, None, "delete"), (5, 2, "there", "create"), (5, 1, "added", "create"), (900, 0, "none", "update"), (None, 1, "no key", "create"), (None, 1, "no key", "update")]
    batch = spark.createDataFrame(changes, "k int, j int, v string, act string").withColumn("extra", F.lit(1))
    sinks.merge_table(batch, table, keys, "act", ["v"])
    want = merge.merge_actions(first.drop("act"), batch, keys, "act", ["v"])
    assert rows(sinks.read_buckets(spark, table), "k", "j", "v", "extra") == rows(want, "k", "j", "v", "extra")
    hit = {r[0] for r in batch.select(sinks._bucket(keys, buckets)).collect()}
    after = {r["f"]: r[sinks.BUCKET] for r in spark.table(table).select(file, sinks.BUCKET).distinct().collect()}
    assert {f for f, b in before.items() if b not in hit} <= set(after) and not {f for f, b in before.items() if b in hit} & set(after)
    everything = spark.range(200).selectExpr("id AS k", "id % 3 AS j", "'x' AS v", "'delete' AS act")
    sinks.merge_table(everything, table, keys, "act")
    assert rows(sinks.read_buckets(spark, table), "k", "j", "v") == [(5, 1, "added"), (None, 1, "no key")]
    with pytest.raises(Exception, match="more than one change"):
        sinks.merge_table(spark.createDataFrame([(5, 1, "update")] * 2, "k int, j int, act string"), table, keys, "act")


def test_buckets_keep_a_hot_key_whole(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_sinks")
    hot = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "id AS v")
    sinks.merge_table(hot.withColumn("act", F.lit("create")), "t_sinks.hot_key", ["k"], "act", buckets=8)
    sinks.merge_table(spark.createDataFrame([(7, -1, "update")], "k long, v long, act string"), "t_sinks.hot_key", ["k"], "act")
    assert spark.table("t_sinks.hot_key").filter("v = -1").count() == 1001 and spark.table("t_sinks.hot_key").count() == 3000
