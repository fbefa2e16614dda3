from __future__ import annotations

from pyspark.sql import functions as F

from stratalake.operators import quality
from stratalake.plans.run import run
from stratalake.sources.sinks import WriteSpec
from tests.conftest import rows


def test_runs_are_counted_and_logged(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_runs")
    first = spark.createDataFrame([(1, "a", "create"), (2, "b", "create")], "k int, v string, act string")
    spec = WriteSpec(first, "t_runs.people", "merge", keys=["k"], action="act")
    done = run(spark, "people", "curated", lambda: [spec], "t_runs.log", "r1")
    assert done.successful, done.error
    assert done.counts == {"t_runs.people": {"create_count": 2, "update_count": 0, "delete_count": 0}}

    second = spark.createDataFrame([(1, "A", "update"), (2, "B", "delete")], "k int, v string, act string")
    spec = WriteSpec(second, "t_runs.people", "merge", keys=["k"], action="act")
    again = run(spark, "people", "curated", lambda: [spec], "t_runs.log", "r2")
    assert again.counts == {"t_runs.people": {"create_count": 0, "update_count": 1, "delete_count": 1}}
    assert rows(spark.table("t_runs.people")) == [(1, "A")]

    broken = run(spark, "people", "curated", lambda: [WriteSpec(second.filter(F.raise_error(F.lit("boom")).cast("boolean")), "t_runs.other")], "t_runs.log", "r3")
    assert not broken.successful and "boom" in broken.error
    log = spark.table("t_runs.log")
    assert rows(log, "run_id", "successful") == [("r1", True), ("r2", True), ("r3", False)]
    assert quality.runs_of(log, "r3").filter("result_text LIKE '%boom%' AND execution_finish_time IS NOT NULL").count() == 1


def test_rows_of_unlabelled_outputs_are_counted(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_runs")
    done = run(spark, "plain", "standardised", lambda: [WriteSpec(spark.range(7).toDF("k"), "t_runs.plain", "append")])
    assert done.counts == {"t_runs.plain": {"row_count": 7}} and done.seconds >= 0


def test_runs_at_the_same_time_keep_both_rows(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_runs")

    def outer():
        # The second run opens and ends while the first one is open.
        assert run(spark, "inner", "curated", lambda: [], "t_runs.both", "b").successful
        assert rows(spark.table("t_runs.both"), "run_id", "successful") == [("a", None), ("b", True)]
        return []

    assert run(spark, "outer", "curated", outer, "t_runs.both", "a").successful
    assert rows(spark.table("t_runs.both"), "run_id", "successful") == [("a", True), ("b", True)]
    assert spark.table("t_runs.both").columns == [c.split()[0] for c in quality.RUN_SCHEMA.split(", ")]
