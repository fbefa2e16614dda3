from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions import keys, temporal, text
from stratalake.operators import conform, ingest, latest, nested, quality
from stratalake.plans import curate, standardise
from stratalake.sources import files, schema, sinks
from stratalake.sources.routing import SourceDefinition, route
from tests.conftest import rows


@pytest.mark.parametrize(
    "raw, want",
    [("Appeal Reference", "appealReference"), ("S78", "s78"), ("attribute", "attribute"), ("  Rule   6   Party  ", "rule6Party"), ("", "")],
)
def test_camel_headers(raw, want):
    assert text.camel_header(raw) == want


def test_header_rules():
    assert text.snake_header("Name (Full)#") == "name_full"
    assert text.light_header("Name (Full).") == "Name_Full"
    assert text.number_repeats(["a", "b", "a"]) == ["a1", "b", "a2"]


def test_attribute_matrix(spark):
    fields = [("attribute", T.StringType()), ("Appeal Reference", T.StringType()), ("S78", T.IntegerType()), ("_c0", T.StringType()), ("", T.StringType())]
    values = ["Housing Need", "", "   ", None, '"', "'", "Green Belt"]
    raw = spark.createDataFrame([(v, f"APP-{i}", i % 2, "x", "x") for i, v in enumerate(values)], T.StructType([T.StructField(*f) for f in fields]))
    out = standardise.attribute_matrix(raw)
    assert out.columns == ["attribute", "appealReference", "s78"] and dict(out.dtypes)["s78"] == "string"
    assert rows(out, "attribute") == [("Green Belt",), ("Housing Need",)]


def test_row_ids_tell_nulls_from_each_other(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    ids = df.select(keys.row_id(["x", "y"]).alias("r"), keys.row_id_ws(["x", "y"]).alias("w"), keys.state_hash(["x", "y"]).alias("s")).collect()
    assert ids[0]["r"] != ids[1]["r"] and ids[0]["s"] != ids[1]["s"]
    assert ids[0]["w"] == ids[1]["w"], "the joined variant skips nulls"


def test_composite_key_with_null_number(spark):
    """A null id must not pull the text default into a number."""
    df = spark.createDataFrame([(None, "f", 1)], "i int, f string, v int")
    import hashlib

    assert df.select(keys.composite_key(["i", "f", "v"])).first()[0] == hashlib.md5(b"f1").hexdigest()


def test_value_rules(spark):
    df = spark.createDataFrame([(" ",), ("Some . ",), (None,)], "t string")
    got = df.select(text.blank_to_null("t"), text.or_default("t", "UNKNOWN"), text.strip_trailing("t")).collect()
    assert [tuple(r) for r in got] == [(None, "UNKNOWN", ""), ("Some . ", "Some . ", "Some"), (None, "UNKNOWN", None)]
    flags = spark.createDataFrame([("Y",), ("NO",), ("T",), ("0",), ("maybe",), (None,)], "t string")
    assert [r[0] for r in flags.select(text.to_boolean("t")).collect()] == [True, False, True, False, None, None]
    assert spark.createDataFrame([("-7",), ("x",)], "t string").select(keys.absolute("t")).collect()[0][0] == 7


def test_time_rules(spark):
    names = ["a/x_2024-12-02T16:54:35.214679+0000.json", "a/x_2024-12-02T16_54_35.214679+0000.json", "a/2024-12-02/x.json", "a/latest/x.json"]
    got = spark.createDataFrame([(n,) for n in names], "p string").select(temporal.file_time("p"), temporal.folder_date("p")).collect()
    moment = datetime(2024, 12, 2, 16, 54, 35, 214679)
    assert [r[0] for r in got] == [moment, moment, None, None]
    assert [r[1] is not None for r in got] == [False, False, True, False]
    d = spark.createDataFrame([("1899-12-31",), ("1900-01-01",), (None,)], "t string")
    assert d.filter(temporal.not_before(F.col("t").cast("timestamp"))).count() == 2
    summer = spark.createDataFrame([("2024-07-01T10:00:00.000Z",)], "t string").select(temporal.utc_to_local("t")).first()[0]
    assert summer == datetime(2024, 7, 1, 11)


def test_schema_documents():
    doc = {
        "$defs": {"addr": {"type": "object", "properties": {"line": {"type": ["string", "null"]}}}},
        "properties": {
            "id": {"type": "integer"},
            "when": {"type": ["date-time", "null"]},
            "tags": {"type": "array", "items": {"type": "number"}},
            "home": {"$ref": "#/$defs/addr"},
            "gone": {},
        },
    }
    out = schema.to_spark_schema(doc)
    assert out.simpleString() == "struct<id:bigint,when:timestamp,tags:array<double>,home:struct<line:string>>"
    assert not out["id"].nullable and out["when"].nullable
    layered = schema.add_layer_columns(out, "harmonised", "key")
    assert layered.names[0] == "key" and layered.names[-1] == "IsActive"
    flat = schema.to_flat_schema({"properties": {"a": {"type": ["integer", "null"]}, "b": {}}})
    assert [(f["type"], f["nullable"]) for f in flat["fields"]] == [("long", True), ("string", True)]
    with pytest.raises(ValueError, match="unsupported type"):
        schema.to_spark_schema({"properties": {"a": {"type": "money"}}})


def test_strict_csv(spark, tmp_path):
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text('id,name\n1,"two\nlines, ""quoted"""\n2,\n')
    bad.write_text("id,name\n1,a\nx,b\n")
    wanted = T.StructType.fromDDL("id int, name string")
    assert files.read_csv_strict(spark, str(good), wanted).count() == 2
    with pytest.raises(Exception, match="corrupt CSV record"):
        files.read_csv_strict(spark, str(bad), wanted).count()
    with pytest.raises(Exception, match="corrupt CSV record"):
        files.read_csv_strict(spark, str(bad), wanted).select("name").collect()
    assert files.read_any(spark, str(good)).columns == ["id", "name"]
    with pytest.raises(ValueError, match="neither CSV nor JSON"):
        files.read_any(spark, "x.xml")


def test_newest_folder_needs_a_date(spark, tmp_path):
    (tmp_path / "backup").mkdir()
    (tmp_path / "backup" / "a.csv").write_text("id\n1\n")
    with pytest.raises(FileNotFoundError):
        files.newest_dated_folder(spark, str(tmp_path))
    (tmp_path / "2025-06-15").mkdir()
    (tmp_path / "2025-06-15" / "a.csv").write_text("id\n1\n")
    assert files.newest_dated_folder(spark, str(tmp_path)).endswith("/2025-06-15")


def test_text_formats_keep_microseconds(spark, tmp_path):
    df = spark.createDataFrame([(datetime(2025, 1, 1, 1, 2, 3, 456789),)], "t timestamp")
    for fmt in ("json", "csv"):
        sinks.write_files(df, str(tmp_path / fmt), fmt)
        assert rows(files.read_files(spark, fmt, str(tmp_path / fmt), schema=df.schema)) == rows(df)


def test_route_takes_the_first_definition(spark):
    names = spark.createDataFrame([("case_a.csv",), ("cases.csv",), ("other",)], "n string")
    defs = [SourceDefinition("case_", "off", enabled=False), SourceDefinition("case_", "one"), SourceDefinition("case", "two")]
    assert rows(route(names, "n", defs), "n", "target_table") == [("case_a.csv", "one"), ("cases.csv", "two"), ("other", None)]


def test_second_file_is_routed_by_the_full_list(spark):
    """Each file sees every definition, not the one the file before it matched."""
    names = spark.createDataFrame([("a1",), ("b1",)], "n string")
    out = route(names, "n", [SourceDefinition("a", "A"), SourceDefinition("b", "B")])
    assert rows(out, "target_table") == [("A",), ("B",)]


def test_latest_load_order(spark):
    data = [("k", 1, 9, 9, "z"), ("k", 2, 1, 1, "a"), ("k", 2, 2, 1, "a"), ("k", 2, 2, 2, "a"), ("k", 2, 2, 2, "b")]
    df = spark.createDataFrame(data, "k string, expected_from int, modified_datetime int, ingested_datetime int, file_id string")
    assert rows(latest.latest_load(df, ["k"]), "file_id", "ingested_datetime") == [("b", 2)]


def test_new_messages_keeps_messages_without_id(spark):
    """A null id on either side must not empty the result."""
    std = spark.createDataFrame([("1",), ("2",), (None,)], "message_id string")
    hrm = spark.createDataFrame([("1",), (None,)], "message_id string")
    assert rows(ingest.new_messages(std, hrm)) == [("2",), (None,)]


def test_explode_keeps_duplicates_and_drops_empty(spark):
    df = spark.createDataFrame([(1, [("x",), ("x",)]), (2, [])], "i int, a array<struct<`list-name`: string>>")
    assert rows(nested.explode_entities(df, "a")) == [("x",), ("x",)]


def test_joined_text_ignores_blanks(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (1, ""), (1, None), (2, None)], "k int, v string")
    assert rows(nested.join_distinct(df, ["k"], "v", "t")) == [(1, "a, b"), (2, "")]


def test_grounds_keep_every_pair(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (1, "a", 2), (1, "b", 1)], "k int, l string, d int")
    out = standardise.appeal_grounds(df, "k", "l", "d", "g").first()
    assert [tuple(x) for x in out["g"]] == [("a", 1), ("a", 2), ("b", 1)]


def test_procedure_codes(spark):
    df = spark.createDataFrame([("Written Reps", None), (None, "Public Inquiry"), ("Not Known", None), ("", "Hearing"), ("Hearing", "Inquiry")], "a string, b string")
    assert [r[0] for r in df.select(standardise.procedure_code("a", "b")).collect()] == ["WR", "LI", None, None, "IH"]


def test_rule_violations(spark):
    df = spark.createDataFrame([(1, "2025-01-01T00:00:00Z"), (2, "2025-13-01T00:00:00Z"), (3, None)], "k int, t string")
    out = quality.violations(df, ["k"], {"given": quality.required("t"), "time": quality.optional_timestamp("t")})
    assert rows(out) == [(2, ["time"]), (3, ["given"])]


def test_curated_codes(spark):
    df = spark.createDataFrame([("1", "None", "none", "Phone", "Depublished"), ("2", "5", "Me", "NONE", "Checked")], "adviceId string, caseId string, agent string, method string, status string")
    out = curate.advice(df.withColumn("IsActive", F.lit("Y")))
    assert rows(out, "adviceId", "caseId", "agent", "method", "status") == [("1", -1, None, "phone", "unchecked"), ("2", 5, "Me", None, "checked")]


def test_counts_ride_along_with_the_write(spark, tmp_path):
    df = spark.createDataFrame([("create",), ("create",), ("update",)], "act string")
    watched, seen = quality.observe_actions(df, "counts", "act")
    watched.write.parquet(str(tmp_path / "out"))
    assert seen.get == {"create_count": 2, "update_count": 1, "delete_count": 0}


def test_padding_and_order(spark):
    df = spark.createDataFrame([(1, "x")], "b int, a string")
    assert conform.project_padded(df, ["a", "c"]).columns == ["a", "c"]
    assert conform.declared_first(df, ["a", "c"]).columns == ["a", "c", "b"]
    assert conform.first_of_repeated(df.toDF("A", "a")).columns == ["A"]
