"""Histories on hand-built rows."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratalake.operators import history
from stratalake.session import materialise
from tests.conftest import rows

D = datetime
US = timedelta(microseconds=1)


def stages(spark, data):
    schema = "k string, s string, ODTSourceSystem string, RowID string, IngestionDate timestamp"
    return spark.createDataFrame(data, schema)


def test_state_changes_close_each_other(spark):
    df = stages(spark, [("A", "submitted", "ODT", "", D(2025, 1, 1)), ("A", "valid", "ODT", "", D(2025, 2, 1))])
    out = history.state_history(df, ["k"], ["s"], id_name="id")
    assert rows(out, "s", "IsActive", "ValidTo", "id") == [
        ("submitted", "N", D(2025, 2, 1), 1),
        ("valid", "Y", None, 2),
    ]


def test_unchanged_state_and_null_keys_are_dropped(spark):
    df = stages(
        spark,
        [
            ("A", "submitted", "ODT", "", D(2025, 1, 1)),
            ("A", "submitted", "ODT", "", D(2025, 2, 1)),
            (None, "bad", "ODT", "", D(2025, 1, 1)),
        ],
    )
    assert rows(history.state_history(df, ["k"], ["s"]), "k", "s", "IsActive") == [("A", "submitted", "Y")]


def test_message_state_precedes_legacy_state_of_the_same_instant(spark):
    df = stages(spark, [("A", "legacy", "HORIZON", "", D(2025, 1, 1)), ("A", "sent", "ODT", "", D(2025, 1, 1))])
    out = history.state_history(df, ["k"], ["s"], {"ODT": 2, "HORIZON": 1})
    assert rows(out, "s", "ValidTo", "IsActive") == [
        ("legacy", None, "Y"),
        ("sent", D(2025, 1, 1) + US, "N"),
    ]


def test_row_ids_order_states_of_one_instant(spark):
    df = stages(spark, [("A", "two", "ODT", "b", D(2025, 1, 1)), ("A", "one", "ODT", "a", D(2025, 1, 1))])
    out = history.state_history(df, ["k"], ["s"])
    assert rows(out, "RowID", "ValidTo", "IsActive") == [("a", D(2025, 1, 1) + US, "N"), ("b", None, "Y")]


def test_copies_of_a_state_at_one_instant_count_once(spark):
    df = stages(spark, [("A", "one", "ODT", "b", D(2025, 1, 1)), ("A", "one", "ODT", "a", D(2025, 1, 1))])
    assert rows(history.state_history(df, ["k"], ["s"]), "RowID") == [("a",)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("AB"), st.sampled_from("xyz"), st.integers(0, 9)), min_size=1, max_size=40))
def test_state_history_against_plain_loop(spark, events):
    start = D(2025, 1, 1)
    data = [(k, s, "ODT", f"{i:04d}", start + timedelta(days=d)) for i, (k, s, d) in enumerate(events)]
    got = history.state_history(stages(spark, data), ["k"], ["s"], hot_rows=5)
    want = []
    for key in {e[0] for e in data}:
        line, seen = [], set()
        for k, s, _, r, t in sorted((d for d in data if d[0] == key), key=lambda d: (d[4], d[3])):
            if (t, s) not in seen:
                seen.add((t, s))
                line.append((k, s, r, t))
        kept = [x for i, x in enumerate(line) if i == 0 or line[i - 1][1] != x[1]]
        for i, (k, s, r, t) in enumerate(kept):
            end = kept[i + 1][3] if i + 1 < len(kept) else None
            want.append((k, s, r, t, end + US if end == t else end, "N" if end else "Y"))
    assert rows(got, "k", "s", "RowID", "IngestionDate", "ValidTo", "IsActive") == sorted(want, key=repr)


def test_rank_history_over_two_sources(spark):
    data = [
        ("E1", "old", "ODT", "", D(2025, 1, 1, 9)),
        ("E1", "new", "ODT", "", D(2025, 1, 2, 9)),
        ("H1", "legacy", "Horizon", "", D(2025, 1, 3, 8)),
    ]
    df = stages(spark, data)
    known = spark.createDataFrame([("E1",)], "k string")
    out = history.rank_history(df, ["k"], ["s"], "id", (known, {"k": "k"}), ["k", "s", "ValidTo"])
    assert rows(out, "id", "s", "Migrated", "ValidTo", "IsActive") == [
        (1, "old", "1", D(2025, 1, 2, 9), "N"),
        (2, "new", "1", None, "Y"),
        (3, "legacy", "0", None, "Y"),
    ]
    assert all(len(r[0]) == 32 for r in rows(out, "RowID"))


def test_two_versions_of_one_instant_do_not_fan_out(spark):
    """Ends are set in place, where joining them back by key and time would pair the two rows."""
    df = stages(spark, [("A", "x", "ODT", "", D(2025, 1, 1)), ("A", "y", "ODT", "", D(2025, 1, 1))])
    assert history.rank_history(df, ["k"], ["s"], "id").count() == 2


def _group_b(spark, *times):
    data = [("A", t, None, "Y") for t in times]
    return spark.createDataFrame(data, "k string, IngestionDate timestamp, ValidTo timestamp, IsActive string")


@pytest.mark.parametrize(
    "marks, end, active",
    [
        ([D(2025, 2, 1)], D(2025, 2, 1), "N"),
        ([D(2024, 12, 1)], None, "Y"),
        ([D(2025, 1, 1), D(2025, 3, 1)], D(2025, 3, 1), "N"),
        ([D(2025, 5, 1), D(2025, 3, 1)], D(2025, 3, 1), "N"),
    ],
)
def test_other_group_closes_strictly_later(spark, marks, end, active):
    own = _group_b(spark, D(2025, 1, 1))
    out = history.close_by(own, _group_b(spark, *marks), ["k"], hot_rows=1)
    assert rows(out, "ValidTo", "IsActive") == [(end, active)]


def test_closed_rows_are_left_alone_unless_asked(spark):
    schema = "k string, IngestionDate timestamp, ValidTo timestamp, IsActive string"
    own = spark.createDataFrame([("A", D(2025, 1, 1), D(2028, 1, 1), "N")], schema)
    other = _group_b(spark, D(2027, 1, 1))
    assert rows(history.close_by(own, other, ["k"]), "ValidTo") == [(D(2028, 1, 1),)]
    assert rows(history.close_by(own, other, ["k"], only_active=False), "ValidTo") == [(D(2027, 1, 1),)]


def test_group_updates(spark):
    schema = "k string, IngestionDate timestamp, IsActive string"
    own = spark.createDataFrame(
        [("1", D(2026, 1, 1), "Y"), ("9", D(2026, 1, 1), "N"), ("2", D(2024, 1, 1), "Y"), ("3", D(2026, 1, 1), "Y"), ("3", D(2026, 1, 1), "Y")],
        schema,
    )
    other = spark.createDataFrame(
        [("1", D(2025, 1, 1), "Y"), ("2", D(2025, 1, 1), "Y"), ("3", None, "Y"), ("0", None, "N")], schema
    )
    assert rows(history.group_updates(own, other, "k")) == [("3", D(2026, 1, 1))]
    assert rows(history.group_of(own, "k", "B"), "k", "currentGroup") == [("1", "B"), ("2", "B"), ("3", "B")]


USERS = "id string, name string, IngestionDate timestamp, ValidTo timestamp, RowID string, IsActive string"


def test_snapshot_history(spark):
    snapshot = spark.createDataFrame(
        [("1", "same", D(2025, 2, 1)), ("2", "changed", D(2025, 2, 1)), ("3", "new", D(2025, 2, 1)), (None, "none", D(2025, 2, 1))],
        "id string, name string, IngestionDate timestamp",
    )
    known = spark.createDataFrame([("1", "same"), ("2", "before"), ("4", "missing")], "id string, name string")
    current = known.select(
        "id",
        "name",
        F.lit(D(2025, 1, 1)).alias("IngestionDate"),
        F.lit(None).cast("timestamp").alias("ValidTo"),
        history.row_id(["id", "name"]).alias("RowID"),
        F.lit("Y").alias("IsActive"),
    )
    past = spark.createDataFrame([("2", "first", D(2024, 1, 1), D(2024, 6, 1), "x", "N")], USERS)
    out = history.snapshot_history(snapshot, current.unionByName(past), "id", ["id", "name"])
    assert rows(out, "id", "name", "IsActive", "ValidTo") == [
        ("1", "same", "Y", None),
        ("2", "before", "N", D(2025, 1, 31)),
        ("2", "changed", "Y", None),
        ("2", "first", "N", D(2024, 6, 1)),
        ("3", "new", "Y", None),
        ("4", "missing", "Y", None),
    ]
    again = history.snapshot_history(snapshot, out, "id", ["id", "name"])
    assert rows(again) == rows(out)


def test_renumber_puts_new_rows_last(spark):
    df = spark.createDataFrame([("c", None), ("a", 7), ("b", 3)], "k string, id bigint")
    for slice_rows in (1, None):
        assert rows(history.renumber(df, "id", ["k"], slice_rows)) == [("a", 2), ("b", 1), ("c", 3)]


MEETINGS = "caseId int, meetingId string, agenda string, internal int, IngestionDate timestamp"


def _incremental(df, target):
    return history.incremental_history(df, target, ["caseId", "meetingId"], ["agenda"], "MeetingId_", ["internal"], id_slice_rows=2)


def test_incremental_history(spark):
    first = spark.createDataFrame([(1, "m", "a", 1, D(2025, 1, 1)), (1, "m", "b", 2, D(2025, 2, 1)), (2, "n", "a", 3, D(2025, 1, 1))], MEETINGS)
    loaded = _incremental(first, None)
    assert rows(loaded, "MeetingId_", "agenda", "IsActive", "ValidTo") == [
        (1, "a", "N", D(2025, 2, 1)),
        (2, "b", "Y", None),
        (3, "a", "Y", None),
    ]
    more = first.unionByName(spark.createDataFrame([(1, "m", "c", 4, D(2025, 3, 1)), (3, "o", "a", 5, D(2025, 3, 1))], MEETINGS))
    out = _incremental(more, loaded)
    assert rows(out, "MeetingId_", "caseId", "agenda", "IsActive", "ValidTo") == [
        (1, 1, "a", "N", D(2025, 2, 1)),
        (2, 1, "b", "N", D(2025, 3, 1)),
        (3, 2, "a", "Y", None),
        (4, 1, "c", "Y", None),
        (5, 3, "a", "Y", None),
    ]


def test_incremental_history_does_not_insert_loaded_versions_again(spark):
    """A full re-read of the source changes nothing; loaded versions are no news."""
    first = spark.createDataFrame([(1, "m", "a", 1, D(2025, 1, 1)), (1, "m", "b", 2, D(2025, 2, 1))], MEETINGS)
    loaded = _incremental(first, None)
    assert rows(_incremental(first, loaded), *loaded.columns) == rows(loaded)


def test_close_deleted(spark):
    snapshots = spark.createDataFrame([("1", 1), ("2", 1), ("1", 2), (None, 1)], "k string, load int")
    gone = history.deleted_keys(snapshots, "k", "load")
    assert rows(gone) == [("2",)]
    df = spark.createDataFrame(
        [("1", "n", D(2025, 1, 1), D(2026, 1, 1), "", "Y"), ("2", "n", D(2025, 1, 1), None, "", "Y")], USERS
    )
    out = history.close_deleted(df, gone, {"id": "k"})
    assert rows(out, "id", "ValidTo", "IsActive") == [("1", None, "Y"), ("2", D(2025, 1, 2), "N")]


def test_append_rerank(spark):
    schema = "id bigint, caseId int, invoice string, internal int, IngestionDate timestamp, ValidTo timestamp, RowID string, IsActive string, Migrated int"
    old = spark.createDataFrame([(5, 1, "i", 1, D(2025, 1, 1), None, "x", "Y", 1)], schema)
    new = spark.createDataFrame([(1, "i", 2, D(2025, 2, 1)), (1, "j", 3, D(2025, 1, 1)), (None, "k", 4, D(2025, 2, 1))], "caseId int, invoice string, internal int, IngestionDate timestamp")
    out = history.append_rerank(old, new, ["caseId", "invoice"], ["internal"], "id", ["invoice", "internal"], ["id", "IsActive"], F.lit(D(2025, 6, 1)))
    assert rows(out, "id", "invoice", "IsActive", "ValidTo", "Migrated", "row_action") == [
        (5, "i", "N", D(2025, 6, 1), 1, "update"),
        (6, "i", "Y", None, 1, "create"),
        (7, "k", "Y", None, 0, "create"),
    ]


def test_null_keys_close_nothing(spark):
    own = spark.createDataFrame([(None, "2025-01-01", None, "Y"), ("a", "2025-01-01", None, "Y")], "k string, IngestionDate string, ValidTo string, IsActive string")
    other = spark.createDataFrame([(None, "2025-02-01", "Y"), ("a", "2025-02-01", "Y")], "k string, IngestionDate string, IsActive string")
    assert rows(history.close_by(own, other, ["k"]), "k", "IsActive") == [("a", "N"), (None, "Y")]


def test_a_snapshot_with_two_rows_of_a_key_fails(spark):
    current = spark.createDataFrame([], "k string, v string, IngestionDate timestamp, ValidTo timestamp, RowID string, IsActive string")
    snapshot = spark.sql("SELECT 'a' AS k, 'x' AS v, timestamp'2025-01-01' AS IngestionDate UNION ALL SELECT 'a', 'y', timestamp'2025-01-01'")
    with pytest.raises(Exception, match="more than one row for key a"):
        history.snapshot_history(snapshot, current, "k", ["k", "v"]).collect()


@pytest.mark.parametrize("with_state", [False, True])
def test_incremental_history_of_a_hot_key(spark, with_state):
    """Cut keys and whole ones give the same history; null keys are never inserted later."""
    made = [("hot" if i % 3 else (None, "a", "b", "c")[i % 4], f"s{i % 5}", i, D(2024, 1, 1) + timedelta(i * 7 % 90)) for i in range(240)]
    df = spark.createDataFrame(made, "k string, s string, tie int, IngestionDate timestamp")
    found = []
    for hot_rows in (2_000_000, 20):
        args = (["k"], ["s"], "n", ["tie"])
        table = materialise(history.incremental_history(df.filter("IngestionDate < '2024-02-10'"), None, *args, hot_rows=hot_rows), "table")
        state = history.history_state(table, ["k"], "n") if with_state else None
        found.append(rows(history.incremental_history(df, table, *args, hot_rows=hot_rows, state=state), "k", "s", "tie", "n", "IngestionDate", "ValidTo", "IsActive"))
    assert found[0] == found[1] and len({r[3] for r in found[0]}) == len(found[0]) > 150
    assert not any(r[0] is None and r[4] >= D(2024, 2, 10) for r in found[0])


def test_a_state_keeps_the_greatest_hash_of_any_kind(spark):
    made = [("a", "f" * 64, "Y", 1), ("a", "0" * 64, "Y", 2), ("b", "Zz", "Y", 3), ("b", "a" * 64, "Y", 4), ("c", "b" * 64, "N", 5), ("d", "zz", "Y", 6), ("d", "1" * 64, "Y", 7)]
    df = spark.createDataFrame(made, "k string, row_hash string, IsActive string, n long").withColumn("IngestionDate", F.lit(D(2024, 1, 1)))
    out = history.history_state(df, ["k"], "n")
    assert out.columns == ["k", "row_hash", "since", "last_id"]
    assert rows(out, "k", "row_hash", "last_id") == [("a", "f" * 64, 2), ("b", "a" * 64, 4), ("c", None, 5), ("d", "zz", 7)]
