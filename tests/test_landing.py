"""Landed files reach their table once, whatever their names hold and wherever a run dies."""

from __future__ import annotations

import json
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.plans import landing
from stratalake.sources import files, manifest, sinks
from stratalake.sources.manifest import Manifest
from stratalake.sources.routing import SourceDefinition
from stratalake.streaming import pickup
from tests.conftest import rows

MESSAGE = T.StructType([T.StructField(n, T.StringType()) for n in ("message_id", "body", "message_enqueued_time_utc")])
NAMES = ["plain.json", "with blank.json", "50%.json", "a%20b+c.json", "brackets [1] {x,y}.json", "star * ? .json", "back\\slash.json"]


def at(day):
    return datetime(2024, 3, day, tzinfo=timezone.utc)


def message(n, time="2024-01-01T00:00:00"):
    return json.dumps({"message_id": None if n is None else str(n), "body": f"b{n}", "message_enqueued_time_utc": time}) + "\n"


@pytest.fixture
def land(spark, tmp_path):
    root = tmp_path / "land here 100%"
    root.mkdir()
    spark.sql("CREATE DATABASE IF NOT EXISTS t_landing")
    table = f"t_landing.{tmp_path.name.replace('-', '_')}"

    def run(day=1, **more):
        return landing.land_messages(spark, str(root), MESSAGE, table, str(tmp_path / "book"), at(day), **more)

    return root, table, run


def test_every_file_is_opened_once(spark, land, monkeypatch):
    root, table, run = land
    opened, read = [], files.read_messages
    monkeypatch.setattr(files, "read_messages", lambda spark, paths, schema: (df := read(spark, paths, schema), opened.append(df.inputFiles()))[0])
    for n, name in enumerate(NAMES[:4]):
        (root / name).write_text(message(n) * 2)
    assert len(run(1, most=3).batches) == 2 and rows(spark.table(table), "message_id") == [("0",), ("1",), ("2",), ("3",)]
    (root / "deep").mkdir()
    for n, name in enumerate(NAMES[4:]):
        (root / "deep" / name).write_text(message(10 + n))
    first = {f for fs in opened for f in fs}
    opened.clear()
    assert sorted(p.rsplit("/", 1)[1] for p in run(2).paths) == sorted(NAMES[4:])
    assert len(opened) == 1 and len(opened[0]) == 3 and not first & set(opened[0])
    assert run(3).paths == [] and spark.table(table).count() == 7
    loaded = spark.table(table)
    assert Manifest(spark, str(root.parent / "book")).pending(files.list_files(spark, str(root))).isEmpty()
    assert rows(loaded.filter("length(message_id) = 2").select("expected_from").distinct()) == [(datetime(2024, 3, 2),)]


@pytest.mark.parametrize("dies", ["before", "half way", "after"])
def test_a_run_that_died_is_finished_by_the_next(spark, land, monkeypatch, dies):
    root, table, run = land
    (root / "first.json").write_text(message(0))
    run(1)
    for n in (1, 2):
        (root / f"{n} %.json").write_text(message(n) + message(None) * 2 + message(n + 10))
    append = manifest.append_or_create

    def broken(df, name):
        if dies != "before":
            append(df if dies == "after" else df.filter("message_id = '1' OR message_id IS NULL AND input_file LIKE '%1 %'"), name)
        raise KeyboardInterrupt

    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr(manifest, "append_or_create", broken)
        run(2)
    (root / "late.json").write_text(message(9))
    done = run(3)
    assert [len(b.paths) for b in done.batches] == [2, 1]
    assert rows(spark.table(table), "message_id") == [("0",), ("1",), ("11",), ("12",), ("2",), ("9",), (None,), (None,)]
    assert rows(spark.table(table).filter("message_id = '2'"), "expected_from") == [(datetime(2024, 3, 2),)]
    assert run(4).paths == []


DEFINITIONS = [SourceDefinition("off", "never", enabled=False), SourceDefinition("part", "t_landing.parts", 3), SourceDefinition("p", "t_landing.others")]
DAY = date(2024, 2, 1)


def drops(spark, tmp_path, day=1, **more):
    declared = lambda d: T.StructType.fromDDL("id int, made array<string>, price double")
    return landing.land_drops(spark, str(tmp_path / "drops"), DAY, DEFINITIONS, declared, str(tmp_path / "book"), at(day), process="test", **more)


@pytest.fixture
def folder(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_landing")
    for d in DEFINITIONS:
        sinks.drop_table(spark, d.table)
    where = tmp_path / "drops" / DAY.isoformat()
    where.mkdir(parents=True)
    return where


def test_drops_go_to_the_tables_of_their_names(spark, tmp_path, folder):
    (folder / "part 1.csv").write_text('Id,Price,Unnamed: 3,Price\n1,"2,5",x,9\n2,2.5,"line\nbreak",8\n')
    (folder / "part 2.csv").write_text("Price,Id,Made.By\n7.5,3,me\n")
    (folder / "part 3.csv").write_text("Price,Id,Made.By\n8.5,4,you\n")
    (folder / "part empty.csv").write_text("")
    (folder / "page.csv").write_text("Id\n5\n")
    (folder / "off.csv").write_text("Id\n6\n")
    (folder / "part.txt").write_text("no")
    taken = drops(spark, tmp_path)
    assert {k: len(v.paths) for k, v in taken.items()} == {"t_landing.parts": 3, "t_landing.others": 1}  # an empty file is not listed
    out = spark.table("t_landing.parts")
    assert rows(out, "id", "price", "price1", "price3", "made_by") == [(1, None, "2,5", "9", None), (2, None, "2.5", "8", None), (3, 7.5, None, None, "me"), (4, 8.5, None, None, "you")]
    assert rows(out.select("entity_name", "expected_from", "expected_to").distinct()) == [("part", datetime(2024, 1, 31), datetime(2024, 2, 3))]
    assert rows(out.select(F.regexp_extract("input_file", "[^/]*$", 0)).distinct()) == [("part 1.csv",), ("part 2.csv",), ("part 3.csv",)]
    assert out.select("file_id").distinct().count() == 3
    (folder / "part 4.csv").write_text("Id\n7\n")
    assert {k: len(v.paths) for k, v in drops(spark, tmp_path, 2).items()} == {"t_landing.parts": 1, "t_landing.others": 0}
    assert rows(spark.table("t_landing.parts").filter("id = 7"), "modified_datetime") == [(datetime(2024, 3, 2),)]


def test_csv_and_json_of_one_drop(spark, tmp_path, folder):
    (folder / "part.CSV").write_text("Id,Made\n1,x\n")
    (folder / "part.json").write_text('[{"Id": 2, "Made": ["a", "b"], "@odata.x": 1},\n {"Id": 3}]')
    drops(spark, tmp_path, endings=(".csv", ".json"), strict=True)
    assert rows(spark.table("t_landing.parts"), "id", "made") == [(1, "x"), (2, '["a","b"]'), (3, None)]
    assert "odata_x" not in spark.table("t_landing.parts").columns


def test_what_is_refused(spark, tmp_path, folder):
    (folder / "part.xlsx").write_text("x")
    with pytest.raises(ValueError, match="part.xlsx"):
        drops(spark, tmp_path, strict=True)
    (folder / "unknown.csv").write_text("Id\n1\n")
    with pytest.raises(ValueError, match="no definition for unknown.csv"):
        drops(spark, tmp_path, only="part")
    assert not any(v.paths for v in drops(spark, tmp_path).values())


def stream(spark, root, table, **more):
    pickup.ingest_stream(spark, str(root), MESSAGE, table, str(root.parent / "offsets"), **more)


def test_streamed_messages_come_once(spark, land, monkeypatch):
    root, table, _ = land
    (root / "a 50%.json").write_text(message(1) + message(1, "2024-01-01T05:00:00") + message(None) * 2)
    stream(spark, root, table)
    scans = []
    monkeypatch.setattr(pickup, "_rest_of_batch", lambda *a: scans.append(a))
    (root / "b.json").write_text(message(1, "2031-01-01T00:00:00") + message(2, "1999-01-01T00:00:00") + message(3, None) + message(None))
    stream(spark, root, table)
    (root / "c.json").write_text(message(2) + message(3) + message(4, "1980-01-01T00:00:00"))
    stream(spark, root, table)
    assert rows(spark.table(table), "message_id") == [("1",), ("2",), ("3",), ("4",), (None,), (None,)] and not scans
    assert rows(spark.table(table).filter("message_id = '1'").select(F.endswith("input_file", F.lit("/land here 100%/a 50%.json")))) == [(True,)]


def test_a_streamed_batch_that_died_is_completed(spark, land, monkeypatch):
    root, table, _ = land
    (root / "0.json").write_text(message(0))
    stream(spark, root, table)
    (root / "1.json").write_text(message(1) + message(2) + message(None))
    append = pickup.append_or_create

    def broken(df, name):
        append(df.filter("message_id = '1'"), name)
        raise RuntimeError("died")

    with monkeypatch.context() as m, pytest.raises(Exception, match="died"):
        m.setattr(pickup, "append_or_create", broken)
        stream(spark, root, table)
    stream(spark, root, table)
    stream(spark, root, table)
    assert rows(spark.table(table), "message_id") == [("0",), ("1",), ("2",), (None,)]
