"""Shape of the physical plans: what must not be in them, and how often rows are moved."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from stratalake.operators import history, joins, latest, merge, nested, ordered
from stratalake.plans import harmonise, queries_jobs, registry
from stratalake.session import materialise
from tests.conftest import plan

FOLDER = "/root/testdata/sf0.001"
registry.load_all()


@pytest.fixture(scope="module")
def t(spark):
    return registry.Tables(spark, FOLDER)


def test_history_is_one_exchange(t):
    versions = t.orders.withColumnRenamed("o_orderdate", "IngestionDate")
    text = plan(history.rank_history(versions, ["o_custkey"], ["o_orderkey"]))
    assert text.count("Exchange hashpartitioning") == 1 and "SinglePartition" not in text


def test_state_history_moves_rows_twice(t):
    df = t.events.select("user_id", "event_type", F.col("ts").alias("IngestionDate"))
    text = plan(history.state_history(df, ["user_id"], ["event_type"]))
    assert text.count("Exchange hashpartitioning") == 2


def test_latest_is_reduced_before_the_exchange(t):
    text = plan(latest.latest_per_key(t.lineitem, ["l_partkey"], ["l_shipdate", "l_orderkey", "l_linenumber"]))
    assert text.count("WindowGroupLimit") == 2 and text.rindex("WindowGroupLimit") > text.index("Exchange")


def test_active_filter_and_columns_reach_the_scan(t, spark, tmp_path):
    path = str(tmp_path / "flagged")
    t.orders.withColumn("IsActive", F.lit("Y")).write.partitionBy("IsActive").parquet(path)
    text = plan(spark.read.parquet(path).filter("IsActive = 'Y' AND o_totalprice > 5").select("o_orderkey"))
    assert "PartitionFilters: []" not in text and "GreaterThan(o_totalprice,5.0)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text


def test_small_batches_leave_the_target_in_place(t):
    """Neither join of a merge moves the target when the changes are small."""
    changes = t.customer.filter("c_custkey = 1").withColumn("act", F.lit("update"))
    text = plan(merge.merge_actions(t.customer, changes, ["c_custkey"], "act"))
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text


def test_constants_need_no_join(t):
    text = plan(joins.attach_constants(t.orders, t.region.filter("r_regionkey = 0")))
    assert "Join" not in text and "Subquery" in text


def test_skew_is_left_to_the_splittable_side(t):
    """A tie filter is a semi join, which can be split by row, not a rank."""
    text = plan(latest.latest_with_ties(t.lineitem, ["l_partkey"], "l_shipdate"))
    assert "LeftSemi" in text and "Window" not in text


def test_ids_are_given_to_plain_rows_before_the_one_window(t, monkeypatch):
    staged, whole = [], ordered.materialise
    monkeypatch.setattr(ordered, "materialise", lambda df, name: (staged.append(plan(df)), whole(df, name))[1])
    versions = t.orders.withColumnRenamed("o_orderdate", "IngestionDate")
    text = plan(history.rank_history(versions, ["o_custkey"], ["o_orderkey"], id_name="VersionID"))
    assert len(staged) == 1 and "Window" not in staged[0] and "rangepartitioning" in staged[0]
    assert len(re.findall(r"Window \[lead", text)) == 1 and "rangepartitioning" not in text


def test_a_small_batch_moves_no_history(t, monkeypatch):
    """Of a history with its state table, a batch for one key moves nothing but that key's rows."""
    first = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", F.col("o_orderdate").alias("IngestionDate"))
    args = (["o_custkey"], ["o_orderstatus"], "VersionID", ["o_orderkey"])
    table = materialise(history.incremental_history(first, None, *args), "history")
    state = materialise(history.history_state(table, ["o_custkey"], "VersionID"), "state")
    new = first.filter("o_custkey = 1").limit(1).withColumns({"IngestionDate": F.col("IngestionDate") + F.expr("INTERVAL 30 YEARS"), "o_orderstatus": F.lit("new")})
    out = history.incremental_history(new, table, *args, state=state)
    text = plan(out)
    assert "SortMergeJoin" not in text and out.count() == table.count() + 1
    assert out.filter("VersionID > (SELECT 0)").agg(F.max("VersionID")).first()[0] == table.count() + 1
    assert out.filter("o_custkey = 1 AND IsActive = 'Y'").count() == 1


def test_a_first_load_moves_its_rows_once(t, monkeypatch):
    """Ids and ends come from one exchange, which the hashes do not pass; what it wrote is only scanned."""
    staged, whole = [], ordered.materialise
    monkeypatch.setattr(ordered, "materialise", lambda df, name: (staged.append((plan(df), df.columns)), whole(df, name))[1])
    first = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", F.col("o_orderdate").alias("IngestionDate"))
    out = history.incremental_history(first, None, ["o_custkey"], ["o_orderstatus"], "VersionID", ["o_orderkey"])
    ((text, columns),) = staged
    assert "row_hash" not in columns and text.count("rangepartitioning") == 1 and "hashpartitioning" not in text and "Window [lead" in text
    assert "Window [lead" not in plan(out) and "rangepartitioning" not in plan(out)


def test_a_later_load_moves_the_source_once(t, monkeypatch):
    """What is affected is found beside the rows themselves: one exchange of the source, one of the state."""
    first = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", F.col("o_orderdate").alias("IngestionDate"))
    args = (["o_custkey"], ["o_orderstatus"], "VersionID", ["o_orderkey"])
    table = materialise(history.incremental_history(first.filter("IngestionDate < '1997-01-01'"), None, *args), "history")
    state = materialise(history.history_state(table, ["o_custkey"], "VersionID"), "state")
    moved, whole = [], history.materialise
    monkeypatch.setattr(history, "materialise", lambda df, name: (moved.append(plan(df).count("Exchange hashpartitioning")), whole(df, name))[1])
    history.incremental_history(first, table, *args, state=state)
    assert moved[0] <= 2 and sum(moved) <= 4


def _handed(monkeypatch, module, name):
    """What a step hands to an operator, call by call."""
    frames, whole = [], getattr(module, name)
    monkeypatch.setattr(module, name, lambda df, *args: (frames.append(df), whole(df, *args))[1])
    return frames


def test_project_copies_go_before_the_rows_meet_the_messages(spark, monkeypatch):
    frames = _handed(monkeypatch, joins, "without_from")
    row = "1L caseId, 1L HorizonCaseNumber, 'a' stage, 'Horizon' ODTSourceSystem, '' RowID, timestamp'2024-01-01' IngestionDate, string(null) ValidTo, '7' SourceSystemID"
    legacy = spark.range(40).selectExpr("string(id % 20) region", *row.split(", "))
    messages = spark.sql(f"SELECT bigint(null) NSIPProjectInfoInternalID, array('sent') regions, {row}").drop("HorizonCaseNumber").withColumn("caseId", F.lit(2).cast("long"))
    out = harmonise.projects(messages, legacy)
    assert [df.count() for df in frames if "region" not in df.columns] == [1]
    assert sorted((r["caseId"], len(r["regions"])) for r in out.collect()) == [(1, 40), (2, 1)]


def test_legacy_rows_are_compared_by_the_columns_they_have(spark):
    messages = spark.sql("SELECT 1L a, 'x' b, " + ", ".join(f"string(null) n{i}" for i in range(30)))
    legacy = spark.range(6).selectExpr("id % 3 a", "'y' b")
    out = harmonise._union(messages, legacy)
    assert out.count() == 4 and out.columns == messages.columns
    assert not re.search(r"HashAggregate\(keys=\[[^]]*null|HashAggregate\(keys=\[[^]]*n\d+#", plan(out))


def test_representations_are_folded_without_what_is_the_same_in_all(t, monkeypatch):
    frames = _handed(monkeypatch, nested, "collect_into")
    out = queries_jobs._representations(t)
    assert not {"ODTSourceSystem", "Migrated", "RowID", "SourceSystemID", "IngestionDate", "ValidTo", "IsActive"} & set(frames[0].columns)
    assert {r[0] for r in out.filter("ODTSourceSystem = 'Horizon'").select("Migrated").distinct().collect()} <= {"0", "1"} and out.filter("SourceSystemID IS NULL").isEmpty()
