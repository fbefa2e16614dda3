"""Queries for sources, incremental pickup and sinks. Round trips write to the shared folder and read it back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators import ingest
from stratalake.plans.registry import Tables, query
from stratalake.session import fresh_path, materialise
from stratalake.sources import files, schema, sinks
from stratalake.sources.routing import SourceDefinition, route

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
PART = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


def _type(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def _written(t: Tables, df: DataFrame, name: str, fmt: str, **kw) -> str:
    path = fresh_path(t.spark, name)
    sinks.write_files(df, path, fmt, **kw)
    return path


def _messages(t: Tables) -> DataFrame:
    """Events as messages: id, type, enqueue time as text, and the file each came in."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return t.events.select(
        F.col("event_id").cast("string").alias("message_id"),
        F.col("event_type").alias("message_type"),
        stamp.alias("message_enqueued_time_utc"),
        F.concat(
            F.lit("landing/"),
            "event_type",
            F.lit("/"),
            F.date_format("ts", "yyyy-MM-dd"),
            F.lit("/"),
            "event_type",
            F.lit("_"),
            stamp,
            F.lit("+0000.json"),
        ).alias("input_file"),
        "user_id",
        "value",
        "ts",
    )


MESSAGES_SQL = """
  SELECT CAST(event_id AS VARCHAR) AS message_id, event_type AS message_type,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS message_enqueued_time_utc,
         'landing/' || event_type || '/' || strftime(ts, '%Y-%m-%d') || '/' || event_type || '_'
           || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+0000.json' AS input_file,
         user_id, value, ts
  FROM events
"""


# --- scans ---------------------------------------------------------------------------------------


@query("src_01_file_scan", "SELECT * FROM customer")
def file_scan(t: Tables) -> DataFrame:
    first = _written(t, t.customer.filter("c_acctbal < 0"), "scan", "json")
    second = _written(t, t.customer.filter("c_acctbal >= 0"), "scan", "json")
    return files.read_files(t.spark, "json", [first, second], schema=_type(CUSTOMER))


@query("src_02_table_scan", "SELECT * FROM supplier")
def table_scan(t: Tables) -> DataFrame:
    """The table is an external one in the shared folder; only its name goes into the catalogue."""
    path = _written(t, t.supplier, "table", "parquet")
    name = "supplier_" + path.rsplit("-", 1)[1]
    t.spark.catalog.createTable(name, path, "parquet")
    return files.read_table(t.spark, t.spark.catalog.currentDatabase(), name)


@query("src_03_snapshot_scan", "SELECT * FROM part")
def snapshot_scan(t: Tables) -> DataFrame:
    return files.read_snapshot_table(t.spark, _written(t, t.part, "snapshot", "parquet"))


@query("src_04_csv_strict", "SELECT * FROM part")
def csv_strict(t: Tables) -> DataFrame:
    path = _written(t, t.part, "strict", "csv", options={"header": "true", "escape": "\\"})
    return files.read_csv_strict(t.spark, path, _type(PART), multi_line=False)


@query("src_05_format_by_name", "SELECT * FROM customer UNION ALL SELECT * FROM customer")
def format_by_name(t: Tables) -> DataFrame:
    root = fresh_path(t.spark, "any")
    sinks.write_files(t.customer, f"{root}/drop.csv", "csv", options={"header": "true", "escape": "\\"})
    sinks.write_files(t.customer, f"{root}/drop.json", "json")
    from_csv = files.read_any(t.spark, f"{root}/drop.csv", _type(CUSTOMER), multi_line=False)
    return from_csv.unionByName(files.read_any(t.spark, f"{root}/drop.json", _type(CUSTOMER), multi_line=False))


@query(
    "src_06_message_scan",
    """SELECT CAST(event_id AS VARCHAR) AS message_id, event_type AS message_type, user_id, TRUE AS from_landing
       FROM events""",
)
def message_scan(t: Tables) -> DataFrame:
    path = _written(t, _messages(t).drop("input_file", "ts"), "messages", "json")
    wanted = _type("message_id string, message_type string, user_id bigint, value double")
    read = files.read_messages(t.spark, path, wanted)
    return read.select("message_id", "message_type", "user_id", F.contains("input_file", F.lit(path)).alias("from_landing"))


@query("src_07_nested_snapshot", "SELECT n_nationkey, n_name, s_suppkey, s_name FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def nested_snapshot(t: Tables) -> DataFrame:
    """Documents of at most ten suppliers, by ranges of the key, as an array."""
    rows = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    item = F.struct("n_nationkey", "n_name", "s_suppkey", "s_name")
    docs = rows.groupBy(F.floor(F.col("s_suppkey") / 10)).agg(F.collect_list(item).alias("value")).select("value")
    path = _written(t, docs, "nested", "json", options={"maxRecordsPerFile": "1"})
    element = _type("n_nationkey int, n_name string, s_suppkey bigint, s_name string")
    return files.read_nested_snapshot(t.spark, path, element)


@query("src_08_csv_snapshot", "SELECT p_partkey, p_name, p_size FROM part")
def csv_snapshot(t: Tables) -> DataFrame:
    """Two dated drops; only the newer one is read."""
    root = fresh_path(t.spark, "drops")
    cols = t.part.select("p_partkey", "p_name", "p_size")
    sinks.write_files(cols.filter("p_size > 25"), f"{root}/2024-01-31", "csv", options={"header": "true"})
    sinks.write_files(cols, f"{root}/2024-02-01", "csv", options={"header": "true"})
    read = files.read_csv_snapshot(t.spark, root)
    return read.select(F.col("p_partkey").cast("bigint"), "p_name", F.col("p_size").cast("int"))


@query("src_09_history_scan", "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def history_scan(t: Tables) -> DataFrame:
    """Many dated folders read as one frame."""
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_returnflag", F.year("l_shipdate").alias("shipped")
    )
    path = _written(t, rows, "history", "json", partition_by="shipped")
    wanted = _type("l_orderkey bigint, l_linenumber int, l_returnflag string")
    return files.read_history(t.spark, path, "json", "part-", schema=wanted)


@query("src_10_file_listing", "SELECT DISTINCT o_orderstatus, TRUE AS has_files FROM orders")
def file_listing(t: Tables) -> DataFrame:
    path = _written(t, t.orders, "listing", "parquet", partition_by="o_orderstatus")
    listed = files.list_files(t.spark, path, "*.parquet")
    status = F.regexp_extract("path", "o_orderstatus=([^/]*)/", 1).alias("o_orderstatus")
    return listed.groupBy(status).agg((F.count(F.lit(1)) > 0).alias("has_files"))


@query("src_11_newest_folder_by_name", "SELECT MAX(CAST(ts AS DATE)) AS folder_date FROM events")
def newest_by_name(t: Tables) -> DataFrame:
    return files.newest_folder_by_name(_messages(t), "input_file")


@query(
    "src_12_newest_folder_by_time",
    f"""SELECT MAX_BY(regexp_extract(input_file, '^(.*)/[^/]*$', 1), ts) AS folder FROM ({MESSAGES_SQL})""",
)
def newest_by_time(t: Tables) -> DataFrame:
    listing = _messages(t).select(F.col("input_file").alias("path"), F.col("ts").alias("modificationTime"))
    return files.newest_folder_by_time(listing)


DEFINITIONS = (
    SourceDefinition("click", "std_click", 1, "landing"),
    SourceDefinition("c", "std_other_c", 2, "landing"),
    SourceDefinition("purchase", "std_purchase", 3, "landing", enabled=False),
    SourceDefinition("p", "std_other_p", 4, "landing"),
    SourceDefinition("v", "std_view", 5, "landing"),
)


@query(
    "src_13_route_files",
    f"""SELECT message_id, f AS file_name,
          CASE WHEN f LIKE 'click%' THEN 'std_click' WHEN f LIKE 'c%' THEN 'std_other_c'
               WHEN f LIKE 'p%' THEN 'std_other_p' WHEN f LIKE 'v%' THEN 'std_view' END AS target_table,
          CASE WHEN f LIKE 'click%' THEN 'click' WHEN f LIKE 'c%' THEN 'c'
               WHEN f LIKE 'p%' THEN 'p' WHEN f LIKE 'v%' THEN 'v' END AS source_prefix,
          CASE WHEN f LIKE 'click%' THEN 1 WHEN f LIKE 'c%' THEN 2
               WHEN f LIKE 'p%' THEN 4 WHEN f LIKE 'v%' THEN 5 END AS lateness_days,
          CASE WHEN f LIKE 'c%' OR f LIKE 'p%' OR f LIKE 'v%' THEN 'landing' END AS source_folder
        FROM (SELECT message_id, regexp_extract(input_file, '([^/]*)$', 1) AS f FROM ({MESSAGES_SQL}))""",
)
def route_files(t: Tables) -> DataFrame:
    named_files = _messages(t).select("message_id", F.regexp_extract("input_file", "([^/]*)$", 1).alias("file_name"))
    return route(named_files, "file_name", DEFINITIONS)


PROPS_DOCUMENT = {
    "$defs": {"level": {"type": ["integer", "null"]}},
    "properties": {"k": {"$ref": "#/$defs/level"}, "note": {"type": ["string", "null"]}, "ignored": {}},
}


@query(
    "src_14_json_schema",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
              json_extract_string(props, '$.note') AS note FROM events""",
)
def json_schema(t: Tables) -> DataFrame:
    parsed = F.from_json("props", schema.to_spark_schema(PROPS_DOCUMENT))
    return t.events.select("event_id", parsed.alias("p")).select("event_id", "p.*")


@query(
    "src_15_layer_schema",
    """SELECT CAST(event_id AS VARCHAR) AS message_id, event_type AS message_type, ts AS ingested_datetime,
              CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
)
def layer_schema(t: Tables) -> DataFrame:
    """Messages written as JSON and read back with the declared schema of their layer."""
    body = F.from_json("props", "k bigint")
    out = t.events.select(
        F.col("event_id").cast("string").alias("message_id"),
        F.col("event_type").alias("message_type"),
        F.col("ts").alias("ingested_datetime"),
        body["k"].alias("k"),
    )
    path = _written(t, out, "layer", "json")
    full = schema.add_layer_columns(schema.to_spark_schema(PROPS_DOCUMENT), "standardised")
    read = files.read_files(t.spark, "json", path, schema=full)
    return read.select("message_id", "message_type", F.col("ingested_datetime").cast("timestamp_ntz"), "k")


@query("src_16_whole_text", "SELECT lang, SUM(LENGTH(text) + 1)::BIGINT AS n_chars FROM documents GROUP BY lang")
def whole_text(t: Tables) -> DataFrame:
    path = _written(
        t, t.documents.select("lang", "text"), "text", "text", partition_by="lang", options={"maxRecordsPerFile": "1000"}
    )
    return files.read_text(t.spark, path).groupBy("lang").agg(F.sum(F.length("value")).alias("n_chars"))


@query("src_18_landed_pages", "SELECT conv_id, turn, role, text FROM conversations")
def landed_pages(t: Tables) -> DataFrame:
    """Pages overlap by role, so assistant turns arrive twice."""
    root = fresh_path(t.spark, "pages")
    rows = t.conversations.withColumn("page", F.lit(1))
    sinks.write_files(rows, f"{root}/p1", "json", options={"maxRecordsPerFile": "1000"})
    second = rows.filter("role = 'assistant'").withColumn("page", F.lit(2))
    sinks.write_files(second, f"{root}/p2", "json", options={"maxRecordsPerFile": "1000"})
    wanted = _type("conv_id bigint, turn bigint, role string, text string, page int")
    return files.read_landed_pages(t.spark, root, wanted, ["conv_id", "turn"], "page", multi_line=False).drop("page")


@query("src_19_landed_sheet", "SELECT * FROM customer")
def landed_sheet(t: Tables) -> DataFrame:
    path = _written(t, t.customer, "sheet", "csv", options={"header": "true", "escape": "\\"})
    return files.read_landed_sheet(t.spark, path, _type(CUSTOMER), multi_line=False)


@query(
    "src_20_declared_formats",
    """SELECT f AS format, COUNT(*) AS n, SUM(s_suppkey)::BIGINT AS key_sum
       FROM supplier, (VALUES ('csv'), ('json'), ('orc'), ('parquet')) v(f) GROUP BY f""",
)
def declared_formats(t: Tables) -> DataFrame:
    wanted = _type("s_suppkey bigint, s_name string")
    out = None
    for fmt in ("csv", "json", "orc", "parquet"):
        options = {"header": "true"} if fmt == "csv" else {}
        path = _written(t, t.supplier.select("s_suppkey", "s_name"), fmt, fmt, options=options)
        one = files.read_files(t.spark, fmt, path, options, wanted).withColumn("format", F.lit(fmt))
        out = one if out is None else out.unionByName(one)
    return out.groupBy("format").agg(F.count(F.lit(1)).alias("n"), F.sum("s_suppkey").alias("key_sum"))


# --- incremental pickup --------------------------------------------------------------------------


def _loaded(t: Tables) -> DataFrame:
    """What an earlier run had taken: everything up to the last day, without the error messages."""
    m = _messages(t)
    return m.filter(F.to_date("ts") < F.to_date(m.agg(F.max("ts")).scalar())).filter("message_type <> 'error'")


LOADED_SQL = f"""
  SELECT * FROM ({MESSAGES_SQL})
  WHERE CAST(ts AS DATE) < (SELECT MAX(CAST(ts AS DATE)) FROM events) AND message_type <> 'error'
"""


@query(
    "ing_01_missing_files",
    "SELECT DISTINCT event_id % 16 AS slot, 1::BIGINT AS n_files FROM events WHERE event_id % 16 >= 10",
)
def missing_files(t: Tables) -> DataFrame:
    """Files in folders whose names hold blanks and percent signs; the table came from the first ten."""
    rows = _messages(t).drop("ts", "input_file").withColumn("slot", F.pmod(F.col("message_id").cast("long"), 16))
    landing = _written(t, rows.withColumn("slot", F.concat("slot", F.lit(" 50%"))).repartition("slot"), "landed messages", "json", partition_by="slot")
    slot = lambda path: F.regexp_extract(path, r"/slot=(\d+) 50%25/", 1).cast("long").alias("slot")
    read = files.read_messages(t.spark, landing, T.StructType([f for f in rows.schema.fields if f.name != "slot"]))
    loaded = _table_of(t, read.filter(slot("input_file") < 10))
    found = ingest.missing_files(files.list_files(t.spark, landing, "*.json"), loaded)
    return found.groupBy(slot("path")).agg(F.count(F.lit(1)).alias("n_files"))


def _table_of(t: Tables, rows: DataFrame) -> DataFrame:
    table = _scratch_table(t, "loaded")
    sinks.write_table(rows, table)
    return t.spark.table(table)


@query("ing_02_max_file_time", f"SELECT MAX(ts) AS max_file_time FROM ({LOADED_SQL})")
def max_file_time(t: Tables) -> DataFrame:
    return ingest.max_file_time(_loaded(t)).select(F.col("max_file_time").cast("timestamp_ntz"))


@query(
    "ing_03_files_after",
    f"""SELECT input_file AS path FROM ({MESSAGES_SQL}) WHERE ts > (SELECT MAX(ts) FROM ({LOADED_SQL}))""",
)
def files_after(t: Tables) -> DataFrame:
    """File names with ``_`` in the time are read as well."""
    underscored = F.regexp_replace("input_file", r"T(\d\d):(\d\d):", "T$1_$2_")
    landed = _messages(t).select(underscored.alias("name"), F.col("input_file").alias("path"))
    cutoff = ingest.max_file_time(_loaded(t)).scalar()
    return ingest.files_after(landed, cutoff, "name").select("path")


@query(
    "ing_04_message_columns",
    f"""SELECT message_id, TIMESTAMP '2024-03-01 06:30:00' AS expected_from,
               TIMESTAMP '2024-03-02 06:30:00' AS expected_to, ts AS ingested_datetime, input_file
        FROM ({MESSAGES_SQL})""",
)
def message_columns(t: Tables) -> DataFrame:
    now = F.lit("2024-03-01 06:30:00").cast("timestamp_ntz")
    out = ingest.add_message_columns(_messages(t), now, F.col("input_file"), "message_enqueued_time_utc")
    return out.select(
        "message_id",
        "expected_from",
        "expected_to",
        F.col("ingested_datetime").cast("timestamp_ntz"),
        "input_file",
    )


@query(
    "ing_05_dedupe_ignoring",
    f"""SELECT message_id, message_type, user_id, MIN(ts) AS ingested_datetime
        FROM (SELECT * FROM ({MESSAGES_SQL})
              UNION ALL SELECT * REPLACE (ts + INTERVAL 1 HOUR AS ts) FROM ({MESSAGES_SQL}))
        GROUP BY ALL""",
)
def dedupe_ignoring(t: Tables) -> DataFrame:
    m = _messages(t).select("message_id", "message_type", "user_id", F.col("ts").alias("ingested_datetime"))
    again = m.withColumn("ingested_datetime", F.col("ingested_datetime") + F.expr("INTERVAL 1 HOUR"))
    return ingest.dedupe_ignoring(m.unionByName(again))


@query(
    "ing_06_load_window",
    """SELECT event_id, CAST(CAST(ts AS DATE) - INTERVAL 1 DAY AS TIMESTAMP) AS expected_from,
              CAST(CAST(ts AS DATE) + INTERVAL 4 DAY AS TIMESTAMP) AS expected_to FROM events""",
)
def load_window(t: Tables) -> DataFrame:
    out = ingest.add_load_window(t.events, "ts", 5)
    return out.select(
        "event_id", F.col("expected_from").cast("timestamp_ntz"), F.col("expected_to").cast("timestamp_ntz")
    )


@query(
    "ing_07_new_messages",
    f"""SELECT message_id, message_enqueued_time_utc FROM ({MESSAGES_SQL})
        WHERE message_id NOT IN (SELECT message_id FROM ({LOADED_SQL}))""",
)
def new_messages(t: Tables) -> DataFrame:
    return ingest.new_messages(_messages(t), _loaded(t)).select("message_id", "message_enqueued_time_utc")


@query(
    "ing_08_stream_pickup",
    f"""SELECT message_id, message_type, ts AS ingested_datetime, CASE WHEN message_type = 'click' THEN 'a 50%25' ELSE 'b 50%25' END AS folder
        FROM ({MESSAGES_SQL})""",
)
def stream_pickup(t: Tables) -> DataFrame:
    """Three runs: the clicks; everything else with clicks that come once more and messages that are older than any
    before; and all messages again. Each message is there once, as it came first."""
    from stratalake.streaming.pickup import ingest_stream

    landing, checkpoint = fresh_path(t.spark, "landing"), fresh_path(t.spark, "offsets")
    table = _scratch_table(t, "messages")
    body = _messages(t).drop("input_file", "ts")
    wanted = _type(
        "message_id string, message_type string, message_enqueued_time_utc string, user_id bigint, value double"
    )
    click, later = F.col("message_type") == "click", F.lit("2030-01-01T00:00:00.000000").alias("message_enqueued_time_utc")
    again = body.withColumn("message_enqueued_time_utc", later)
    for folder, rows in (("a 50%", body.filter(click)), ("b 50%", body.filter(~click).unionByName(again.filter(click))), ("c 50%", again)):
        sinks.write_files(rows.withColumn("folder", F.lit(folder)), landing, "json", "append", partition_by="folder")
        ingest_stream(t.spark, landing, wanted, table, checkpoint)
    out = t.spark.table(table)
    return out.select("message_id", "message_type", F.col("ingested_datetime").cast("timestamp_ntz"), F.regexp_extract("input_file", "/folder=([^/]*)/", 1).alias("folder"))


# --- sinks ---------------------------------------------------------------------------------------


def _scratch_table(t: Tables, name: str) -> str:
    """New table name in a database whose files lie in the shared folder."""
    t.spark.sql(f"CREATE DATABASE IF NOT EXISTS scratch LOCATION '{fresh_path(t.spark, 'scratch')}'")
    return f"scratch.{name}_{fresh_path(t.spark, name).rsplit('-', 1)[1]}"


@query("snk_01_file_write", "SELECT * FROM orders")
def file_write(t: Tables) -> DataFrame:
    return t.spark.read.parquet(_written(t, t.orders, "files", "parquet", options={"compression": "zstd"}))


@query("snk_02_table_write", "SELECT * FROM orders")
def table_write(t: Tables) -> DataFrame:
    table = _scratch_table(t, "orders")
    sinks.write_table(t.orders, table, fresh_path(t.spark, "table"), partition_by="o_orderstatus")
    return t.spark.table(table)


CUSTOMER_CHANGES_SQL = """
  SELECT *, CASE WHEN c_mktsegment = 'BUILDING' THEN 'Update' WHEN c_mktsegment = 'MACHINERY' THEN 'deleted'
                 ELSE 'create' END AS row_action FROM customer
"""
CUSTOMER_AFTER_SQL = """
  SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 0.0 ELSE c_acctbal END AS c_acctbal,
         c_mktsegment FROM customer
  WHERE c_mktsegment <> 'MACHINERY'
"""


def _customer_base(t: Tables) -> DataFrame:
    """Customers that were there before: all but those in debt outside the changed segments."""
    return t.customer.filter("c_acctbal >= 0 OR c_mktsegment IN ('BUILDING', 'MACHINERY')")


def _customer_changes(t: Tables) -> DataFrame:
    act = (
        F.when(F.col("c_mktsegment") == "BUILDING", "Update")
        .when(F.col("c_mktsegment") == "MACHINERY", "deleted")
        .otherwise("create")
    )
    return t.customer.withColumns({"row_action": act, "c_acctbal": F.when(act == "Update", 0.0).otherwise(F.col("c_acctbal"))})


@query("snk_03_merge_write", CUSTOMER_AFTER_SQL)
def merge_write(t: Tables) -> DataFrame:
    table = _scratch_table(t, "customers")
    sinks.write_table(_customer_base(t), table)
    sinks.merge_table(_customer_changes(t), table, ["c_custkey"], "row_action")
    return t.spark.table(table)


@query(
    "snk_03_merge_partitions",
    """SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN 0.0 ELSE c_acctbal END AS c_acctbal, c_mktsegment,
              c_mktsegment <> 'BUILDING' AS untouched FROM customer WHERE c_mktsegment <> 'MACHINERY'""",
)
def merge_partitions(t: Tables) -> DataFrame:
    """Updates fill one partition, deletes empty another; the files of the rest are those of before."""
    table, path = _scratch_table(t, "segments"), fresh_path(t.spark, "segments")
    cols = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]
    sinks.write_table(t.customer.select(*cols), table, path, partition_by="c_mktsegment")
    file = F.col("_metadata.file_path")
    before = materialise(t.spark.table(table).select(file.alias("_file")).distinct(), "files")
    edits = _customer_changes(t).filter("row_action <> 'create'").select(*cols, "row_action")
    sinks.merge_table(edits, table, ["c_custkey"], "row_action")
    after = t.spark.table(table).select(*cols, file.alias("_file"))
    return after.join(before.withColumn("_old", F.lit(True)), "_file", "left").select(*cols, F.coalesce("_old", F.lit(False)).alias("untouched"))


@query(
    "snk_03_merge_buckets",
    """SELECT c_custkey, CASE WHEN c_custkey % 50 = 0 THEN 'new' ELSE c_name END AS c_name, TRUE AS others_untouched
       FROM customer WHERE c_custkey % 50 <> 1
       UNION ALL SELECT 10 * max(c_custkey), 'added', TRUE FROM customer""",
)
def merge_buckets(t: Tables) -> DataFrame:
    """A table without partitions, in buckets of its key: a batch that hits some leaves the files of the others alone."""
    table, file = _scratch_table(t, "customers"), F.col("_metadata.file_path").alias("_file")
    act = lambda a: F.lit(a).alias("row_action")
    sinks.merge_table(t.customer.select("c_custkey", "c_name", act("create")), table, ["c_custkey"], "row_action", buckets=256)
    before = materialise(t.spark.table(table).select(sinks.BUCKET, file).distinct(), "files")
    key = F.col("c_custkey")
    batch = t.customer.filter(key % 50 == 0).select(key, F.lit("new").alias("c_name"), act("update"))
    batch = batch.unionByName(t.customer.filter(key % 50 == 1).select(key, "c_name", act("delete")))
    batch = batch.unionByName(t.customer.agg((F.max(key) * 10).alias("c_custkey")).select(key, F.lit("added").alias("c_name"), act("create")))
    batch = materialise(batch, "batch")
    sinks.merge_table(batch, table, ["c_custkey"], "row_action")
    hit = batch.select(sinks._bucket(["c_custkey"], 256).alias(sinks.BUCKET)).distinct()
    kept = before.join(hit, sinks.BUCKET, "left_anti").join(t.spark.table(table).select(file).distinct(), "_file", "left_anti")
    return sinks.read_buckets(t.spark, table).withColumn("others_untouched", F.lit(kept.isEmpty()))


@query("snk_04_swap", "SELECT p_partkey, p_name FROM part WHERE p_size > 25")
def swap(t: Tables) -> DataFrame:
    table = _scratch_table(t, "parts")
    sinks.write_table(t.part.select("p_partkey", "p_name", "p_size"), table)
    sinks.swap_table(t.spark.table(table).filter("p_size > 25").drop("p_size"), table)
    return t.spark.table(table)


@query(
    "snk_05_append_or_create",
    """SELECT o_orderkey, o_orderstatus, NULL AS o_orderpriority FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'""",
)
def append_or_create(t: Tables) -> DataFrame:
    """The second load brings a column the table did not have."""
    table = _scratch_table(t, "orders")
    sinks.append_or_create(t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus"), table)
    later = t.orders.filter("o_orderstatus <> 'F'")
    sinks.append_or_create(later.select("o_orderpriority", "o_orderkey", "o_orderstatus"), table)
    return t.spark.table(table)


@query(
    "snk_06_write_plan",
    """SELECT 'customers' AS output, COUNT(*) AS n FROM customer UNION ALL SELECT 'parts', COUNT(*) FROM part""",
)
def write_plan(t: Tables) -> DataFrame:
    table, path = _scratch_table(t, "customers"), fresh_path(t.spark, "parts")
    sinks.write_all(
        [
            sinks.WriteSpec(t.customer, table, "append"),
            sinks.WriteSpec(t.part, "parts", "file", "errorifexists", path=path),
        ]
    )
    one = t.spark.table(table).agg(F.count(F.lit(1)).alias("n")).withColumn("output", F.lit("customers"))
    two = t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n")).withColumn("output", F.lit("parts"))
    return one.unionByName(two).select("output", "n")


@query(
    "snk_07_split_by_flag",
    "SELECT c_custkey, c_name, 'Y' AS \"IsActive\" FROM customer WHERE c_acctbal >= 0",
)
def split_by_flag(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "flagged")
    flag = F.when(F.col("c_acctbal") >= 0, "Y").otherwise("N")
    sinks.write_by_flag(t.customer.select("c_custkey", "c_name", flag.alias("IsActive")), path)
    return t.spark.read.parquet(path).filter("IsActive = 'Y'")


@query("snk_08_drop_and_empty", "SELECT 0::BIGINT AS rows_left, FALSE AS dropped_exists")
def drop_and_empty(t: Tables) -> DataFrame:
    kept, dropped = _scratch_table(t, "nations"), _scratch_table(t, "nations")
    sinks.write_table(t.nation, kept)
    sinks.write_table(t.nation, dropped)
    sinks.empty_table(t.spark, kept)
    sinks.drop_table(t.spark, dropped)
    left = t.spark.table(kept).agg(F.count(F.lit(1)).alias("rows_left"))
    return left.withColumn("dropped_exists", F.lit(sinks.table_exists(t.spark, dropped)))


@query(
    "snk_09_keyed_upsert",
    """SELECT c_custkey, c_name, c_nationkey, c_acctbal, 'moved' AS c_mktsegment FROM customer""",
)
def keyed_upsert(t: Tables) -> DataFrame:
    incoming = t.customer.withColumn("c_mktsegment", F.lit("moved"))
    return sinks.upsert_rows(_customer_base(t), incoming, ["c_custkey"])


@query(
    "snk_10_mapped_copy",
    """SELECT s_suppkey AS "supplierId", s_name AS "supplierName", s_acctbal AS balance FROM supplier""",
)
def mapped_copy(t: Tables) -> DataFrame:
    return sinks.rename_mapped(
        t.supplier, {"s_suppkey": "supplierId", "s_name": "supplierName", "s_acctbal": "balance"}
    )


@query("snk_11_dated_backup", "SELECT *, DATE '2024-02-01' AS date FROM supplier")
def dated_backup(t: Tables) -> DataFrame:
    root = fresh_path(t.spark, "backup")
    path = sinks.backup(t.supplier, root, "2024-02-01", "supplier")
    return t.spark.read.option("basePath", root).parquet(path)


@query(
    "snk_12_publish",
    """SELECT CAST(c_custkey AS VARCHAR) AS key,
              '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_mktsegment":"' || c_mktsegment || '"}' AS value
       FROM customer""",
)
def publish(t: Tables) -> DataFrame:
    return sinks.as_messages(t.customer.select("c_custkey", "c_name", "c_mktsegment"), ["c_custkey"])


@query("snk_13_first_write", "SELECT * FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')")
def first_write(t: Tables) -> DataFrame:
    table = _scratch_table(t, "customers")
    sinks.merge_table(_customer_changes(t), table, ["c_custkey"], "row_action")
    return t.spark.table(table)


@query("snk_14_delete_rows", "SELECT * FROM supplier WHERE NOT s_acctbal < 0")
def delete_rows(t: Tables) -> DataFrame:
    table = _scratch_table(t, "suppliers")
    sinks.write_table(t.supplier, table)
    sinks.delete_rows(t.spark, table, F.col("s_acctbal") < 0)
    return t.spark.table(table)


@query(
    "snk_15_alter_and_ctas",
    """SELECT n_nationkey, n_name, n_regionkey, CAST(NULL AS VARCHAR) AS n_name_translated FROM nation""",
)
def alter_and_ctas(t: Tables) -> DataFrame:
    table = _scratch_table(t, "nations")
    sinks.create_as_select(t.spark, table, t.nation)
    sinks.add_columns(t.spark, table, {"n_name_translated": "string"})
    return t.spark.table(table)


@query("snk_16_table_exists", "SELECT COUNT(*) AS n, TRUE AS written, FALSE AS unwritten FROM region")
def exists(t: Tables) -> DataFrame:
    table = _scratch_table(t, "regions")
    before = sinks.table_exists(t.spark, table)
    sinks.write_table(t.region, table)
    counted = t.spark.table(table).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumns({"written": F.lit(sinks.table_exists(t.spark, table)), "unwritten": F.lit(before)})
