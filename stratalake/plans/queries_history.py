"""Queries for versioned histories and merges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions import text
from stratalake.operators import conform, history, merge
from stratalake.plans.queries_sources import _scratch_table
from stratalake.plans.registry import Tables, query
from stratalake.session import materialise
from stratalake.sources import sinks

# --- flagship ------------------------------------------------------------------------------------


@query(
    "flagship_customer_state",
    """WITH typed AS (SELECT o_orderkey, o_custkey, o_orderdate AS "IngestionDate",
                             CASE o_orderpriority WHEN '1-URGENT' THEN 'appeals' WHEN '5-LOW' THEN 'archive'
                                  ELSE lower(o_orderpriority) END AS stage, o_orderstatus FROM orders),
       h AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY "IngestionDate" DESC, o_orderkey DESC) AS n,
                    ROW_NUMBER() OVER (ORDER BY "IngestionDate", o_custkey, o_orderkey) AS "StateID" FROM typed)
       SELECT "StateID", o_custkey, o_orderkey, o_orderstatus, stage, "IngestionDate",
              md5(o_custkey || o_orderkey::VARCHAR || o_orderstatus) AS "RowID" FROM h WHERE n = 1""",
)
def flagship(t: Tables) -> DataFrame:
    """Raw text orders are typed, versioned per customer, numbered and hashed; the active rows get their stage."""
    raw = conform.all_text(t.orders).toDF("O OrderKey", "o custkey.", "o_orderstatus", "o-totalprice", "o orderdate", "o_orderpriority")
    declared = T.StructType.fromDDL("o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz")
    typed = conform.cast_to_schema(conform.clean_headers(raw), declared)
    versions = history.rank_history(
        typed.withColumnRenamed("o_orderdate", "IngestionDate"),
        ["o_custkey"],
        ["o_orderkey"],
        id_name="StateID",
        hash_cols=["o_custkey", "o_orderkey", "o_orderstatus"],
    )
    codes = {"1-URGENT": "appeals", "5-LOW": "archive"}
    stage = text.map_codes("o_orderpriority", codes, F.lower("o_orderpriority"))
    cols = ["StateID", "o_custkey", "o_orderkey", "o_orderstatus", "stage", "IngestionDate", "RowID"]
    return conform.active_only(versions.withColumn("stage", stage), cols)


# --- rank history --------------------------------------------------------------------------------


def customer_versions(t: Tables) -> DataFrame:
    """Every order is a version of its customer; pending orders already carry an end."""
    end = F.when(F.col("o_orderstatus") == "P", F.lit("2030-01-01 00:00:00")).otherwise(F.lit(""))
    return t.orders.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.col("o_orderdate").alias("IngestionDate"),
        end.alias("ValidTo"),
    )


RANK_HISTORY_SQL = """
  SELECT *, md5(o_custkey || o_orderstatus || "IngestionDate"::VARCHAR || COALESCE("ValidTo"::VARCHAR, '.')) AS "RowID"
  FROM (
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate AS "IngestionDate",
      COALESCE(CASE WHEN o_orderstatus = 'P' THEN TIMESTAMP '2030-01-01' END, LEAD(o_orderdate) OVER w) AS "ValidTo",
      CASE WHEN LEAD(o_orderkey) OVER w IS NULL THEN 'Y' ELSE 'N' END AS "IsActive",
      CASE WHEN o_custkey IN (SELECT user_id FROM events) THEN '1' ELSE '0' END AS "Migrated",
      ROW_NUMBER() OVER (ORDER BY o_orderdate, o_custkey, o_orderkey) AS "VersionID"
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
"""


@query("scd_01_rank_history", RANK_HISTORY_SQL)
def rank_history(t: Tables) -> DataFrame:
    return history.rank_history(
        customer_versions(t),
        ["o_custkey"],
        ["o_orderkey"],
        id_name="VersionID",
        existence=(t.events, {"o_custkey": "user_id"}),
        hash_cols=["o_custkey", "o_orderstatus", "IngestionDate", "ValidTo"],
    )


# --- snapshot history ----------------------------------------------------------------------------


def _customer_history(t: Tables) -> DataFrame:
    """Customers as known before: debtors were not there yet, builders were in another segment."""
    segment = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("FURNITURE")).otherwise(F.col("c_mktsegment"))
    known = t.customer.withColumn("c_mktsegment", segment)
    ids = ["c_custkey", "c_name", "c_mktsegment"]
    at = lambda s: F.lit(s).cast("timestamp")
    active = known.filter("c_acctbal >= 0").select(
        *ids,
        at("2024-01-01").alias("IngestionDate"),
        F.lit(None).cast("timestamp").alias("ValidTo"),
        history.row_id(ids).alias("RowID"),
        F.lit("Y").alias("IsActive"),
    )
    past = known.filter("c_nationkey = 0").select(
        *ids,
        at("2023-01-01").alias("IngestionDate"),
        at("2023-12-31").alias("ValidTo"),
        F.lit("old").alias("RowID"),
        F.lit("N").alias("IsActive"),
    )
    return active.unionByName(past)


SNAPSHOT_HISTORY_SQL = """
  WITH known AS (SELECT * REPLACE (CASE WHEN c_mktsegment = 'BUILDING' THEN 'FURNITURE' ELSE c_mktsegment END AS c_mktsegment)
                 FROM customer),
  old AS (SELECT c_custkey, c_name, c_mktsegment, md5(c_custkey || c_name || c_mktsegment) AS h FROM known WHERE c_acctbal >= 0),
  new AS (SELECT c_custkey, c_name, c_mktsegment, md5(c_custkey || c_name || c_mktsegment) AS h FROM customer)
  SELECT c_custkey, c_name, c_mktsegment, TIMESTAMP '2023-01-01' AS "IngestionDate", TIMESTAMP '2023-12-31' AS "ValidTo",
         'old' AS "RowID", 'N' AS "IsActive" FROM known WHERE c_nationkey = 0
  UNION ALL SELECT c_custkey, c_name, c_mktsegment, TIMESTAMP '2024-01-01', CASE WHEN h NOT IN (SELECT h FROM new)
         THEN TIMESTAMP '2024-01-31' END, h, CASE WHEN h NOT IN (SELECT h FROM new) THEN 'N' ELSE 'Y' END FROM old
  UNION ALL SELECT c_custkey, c_name, c_mktsegment, TIMESTAMP '2024-02-01', NULL, h, 'Y' FROM new
         WHERE h NOT IN (SELECT h FROM old)
"""


@query(
    "scd_02_snapshot_history",
    f"""SELECT *, ROW_NUMBER() OVER (ORDER BY c_custkey, "IngestionDate", "RowID") AS id FROM ({SNAPSHOT_HISTORY_SQL})""",
)
def snapshot_history(t: Tables) -> DataFrame:
    snapshot = t.customer.select(
        "c_custkey", "c_name", "c_mktsegment", F.lit("2024-02-01").cast("timestamp").alias("IngestionDate")
    )
    ids = ["c_custkey", "c_name", "c_mktsegment"]
    out = history.snapshot_history(snapshot, _customer_history(t), "c_custkey", ids)
    unnumbered = materialise(out.withColumn("id", F.lit(None).cast("bigint")), "snapshot")
    numbered = history.renumber(unnumbered, "id", ["c_custkey", "IngestionDate", "RowID"])
    naive = {c: F.col(c).cast("timestamp_ntz") for c in ("IngestionDate", "ValidTo")}
    return numbered.withColumns(naive)


# --- state history -------------------------------------------------------------------------------

STATE_HISTORY_SQL = """
  WITH seen AS (
    SELECT *, LAG(event_type) OVER (PARTITION BY user_id ORDER BY ts, sha256(event_type)) AS before
    FROM (SELECT DISTINCT user_id, event_type, ts FROM events)),
  changes AS (SELECT * FROM seen WHERE before IS NULL OR before <> event_type),
  ended AS (SELECT *, LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, sha256(event_type)) AS until FROM changes)
  SELECT user_id, event_type, ts AS "IngestionDate",
         CASE WHEN until = ts THEN until + INTERVAL 1 MICROSECOND ELSE until END AS "ValidTo",
         CASE WHEN until IS NULL THEN 'Y' ELSE 'N' END AS "IsActive" FROM ended
"""


@query("scd_03_state_history", STATE_HISTORY_SQL)
def state_history(t: Tables) -> DataFrame:
    stages = t.events.select("user_id", "event_type", F.col("ts").alias("IngestionDate"))
    return history.state_history(stages, ["user_id"], ["event_type"])


TWO_SOURCES_SQL = """
  WITH staged AS (
    SELECT user_id, props AS state, date_trunc('hour', ts) AS at,
           CASE WHEN event_type IN ('click', 'view') THEN 'casework' ELSE 'legacy' END AS src,
           CASE WHEN event_type IN ('click', 'view') THEN event_id::VARCHAR ELSE '' END AS rid FROM events),
  once AS (
    SELECT *, CASE WHEN rid = '' THEN '~' ELSE rid END AS ord, CASE src WHEN 'casework' THEN -2 ELSE -1 END AS pri FROM staged
    QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, at, src, state ORDER BY CASE WHEN rid = '' THEN '~' ELSE rid END) = 1),
  seen AS (SELECT *, LAG(state) OVER (PARTITION BY user_id ORDER BY at, pri, ord, sha256(state)) AS before FROM once),
  changes AS (SELECT * FROM seen WHERE before IS NULL OR before <> state),
  ended AS (SELECT *, LEAD(at) OVER w AS until, ROW_NUMBER() OVER w AS version FROM changes
            WINDOW w AS (PARTITION BY user_id ORDER BY at, pri, ord, sha256(state)))
  SELECT user_id, state, at AS "IngestionDate", src AS "ODTSourceSystem", rid AS "RowID", version AS "StateID",
         CASE WHEN until = at THEN until + INTERVAL 1 MICROSECOND ELSE until END AS "ValidTo",
         CASE WHEN until IS NULL THEN 'Y' ELSE 'N' END AS "IsActive" FROM ended
""".replace(" at,", " moment,").replace(" at ", " moment ").replace("= at ", "= moment ").replace("(at)", "(moment)")


@query("scd_04_two_source_history", TWO_SOURCES_SQL)
def two_source_history(t: Tables) -> DataFrame:
    """Times cut to the hour make the two sources meet at one instant."""
    first = F.col("event_type").isin("click", "view")
    staged = t.events.select(
        "user_id",
        F.col("props").alias("state"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("IngestionDate"),
        F.when(first, "casework").otherwise("legacy").alias("ODTSourceSystem"),
        F.when(first, F.col("event_id").cast("string")).otherwise("").alias("RowID"),
    )
    priority = {"casework": 2, "legacy": 1}
    return history.state_history(staged, ["user_id"], ["state"], priority, id_name="StateID")


def _urgent_history(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Urgent orders as a history per customer, and the low orders that may close it."""
    urgent = customer_versions(t).join(
        t.orders.filter("o_orderpriority IN ('1-URGENT', '2-HIGH')").select("o_orderkey"), "o_orderkey", "left_semi"
    )
    ours = history.rank_history(urgent.drop("ValidTo"), ["o_custkey"], ["o_orderkey"])
    theirs = t.orders.filter("o_orderpriority = '5-LOW'").select(
        "o_custkey", F.col("o_orderdate").alias("IngestionDate"), F.lit("Y").alias("IsActive")
    )
    return ours, theirs


URGENT_SQL = """
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate AS "IngestionDate", LEAD(o_orderdate) OVER w AS "ValidTo",
         CASE WHEN LEAD(o_orderkey) OVER w IS NULL THEN 'Y' ELSE 'N' END AS "IsActive"
  FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
"""


@query(
    "scd_05_cross_closure",
    f"""WITH met AS (SELECT a.*, (SELECT MIN(o_orderdate) FROM orders b WHERE b.o_orderpriority = '5-LOW'
                       AND b.o_custkey = a.o_custkey AND b.o_orderdate > a."IngestionDate") AS mark FROM ({URGENT_SQL}) a)
        SELECT o_orderkey, o_custkey, o_orderstatus, "IngestionDate",
               CASE WHEN "IsActive" = 'Y' AND mark IS NOT NULL THEN mark ELSE "ValidTo" END AS "ValidTo",
               CASE WHEN "IsActive" = 'Y' AND mark IS NOT NULL THEN 'N' ELSE "IsActive" END AS "IsActive" FROM met""",
)
def cross_closure(t: Tables) -> DataFrame:
    ours, theirs = _urgent_history(t)
    return history.close_by(ours, theirs, ["o_custkey"])


@query(
    "scd_05_cross_closure_any",
    f"""WITH met AS (SELECT a.*, (SELECT MIN(o_orderdate) FROM orders b WHERE b.o_orderpriority = '5-LOW'
                       AND b.o_custkey = a.o_custkey AND b.o_orderdate > a."IngestionDate") AS mark FROM ({URGENT_SQL}) a)
        SELECT o_orderkey, o_custkey, o_orderstatus, "IngestionDate",
               CASE WHEN mark < COALESCE("ValidTo", TIMESTAMP '9999-01-01') THEN mark ELSE "ValidTo" END AS "ValidTo",
               CASE WHEN mark < COALESCE("ValidTo", TIMESTAMP '9999-01-01') THEN 'N' ELSE "IsActive" END AS "IsActive" FROM met""",
)
def cross_closure_any(t: Tables) -> DataFrame:
    ours, theirs = _urgent_history(t)
    return history.close_by(ours, theirs, ["o_custkey"], only_active=False)


@query(
    "scd_06_group_updates",
    f"""SELECT o_custkey, 'B' AS "currentGroup", "IngestionDate" AS "asOfTimestamp", 'group' AS kind
        FROM ({URGENT_SQL}) WHERE "IsActive" = 'Y'
        UNION SELECT o_custkey, 'B', "IngestionDate", 'update' FROM ({URGENT_SQL})
        WHERE "IsActive" = 'Y' AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
)
def group_updates(t: Tables) -> DataFrame:
    ours, _ = _urgent_history(t)
    untimed = t.customer.select(
        F.col("c_custkey").alias("o_custkey"),
        F.when(F.col("c_acctbal") >= 0, F.lit("2024-01-01").cast("timestamp_ntz")).alias("IngestionDate"),
        F.lit("Y").alias("IsActive"),
    )
    groups = history.group_of(ours, "o_custkey", "B").withColumn("kind", F.lit("group"))
    updates = history.group_updates(ours, untimed, "o_custkey").select(
        "o_custkey", F.lit("B").alias("currentGroup"), F.col("activeFrom").alias("asOfTimestamp"), F.lit("update").alias("kind")
    )
    return groups.unionByName(updates)


# --- incremental history -------------------------------------------------------------------------


def _line_states(t: Tables) -> DataFrame:
    """Lines as states of (part, supplier), dated by shipping."""
    return t.lineitem.select(
        "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber",
        F.col("l_shipdate").alias("IngestionDate"),
    )


LINE_STATES_SQL = """
  SELECT l_partkey, l_suppkey, l_returnflag, l_linestatus, l_orderkey, l_linenumber, l_shipdate AS "IngestionDate",
         sha256(l_partkey || '~' || l_suppkey || '~' || l_returnflag || '~' || l_linestatus) AS row_hash FROM lineitem
"""
_LINE_ORDER = '"IngestionDate", l_orderkey, l_linenumber, row_hash'
INCREMENTAL_SQL = f"""
  WITH src AS ({LINE_STATES_SQL}),
  first_load AS (SELECT * FROM src WHERE "IngestionDate" < TIMESTAMP '2000-01-01'),
  tgt AS (SELECT *, ROW_NUMBER() OVER (ORDER BY l_partkey, l_suppkey, {_LINE_ORDER}) AS "LineID",
            LEAD("IngestionDate") OVER (PARTITION BY l_partkey, l_suppkey ORDER BY {_LINE_ORDER}) AS "ValidTo",
            CASE WHEN LEAD(row_hash) OVER (PARTITION BY l_partkey, l_suppkey ORDER BY {_LINE_ORDER}) IS NULL
                 THEN 'Y' ELSE 'N' END AS "IsActive" FROM first_load),
  newest AS (SELECT l_partkey, l_suppkey, row_hash FROM src QUALIFY ROW_NUMBER() OVER (PARTITION BY l_partkey, l_suppkey
             ORDER BY "IngestionDate" DESC, l_orderkey DESC, l_linenumber DESC, row_hash DESC) = 1),
  affected AS (SELECT n.l_partkey, n.l_suppkey FROM newest n LEFT JOIN (SELECT * FROM tgt WHERE "IsActive" = 'Y') a
               ON a.l_partkey = n.l_partkey AND a.l_suppkey = n.l_suppkey
               WHERE a.row_hash IS NULL OR a.row_hash <> n.row_hash),
  pending AS (SELECT * FROM src s WHERE (l_partkey, l_suppkey) IN (SELECT l_partkey, l_suppkey FROM affected)
              AND NOT EXISTS (SELECT 1 FROM tgt x WHERE x.l_partkey = s.l_partkey AND x.l_suppkey = s.l_suppkey
                              AND x.row_hash = s.row_hash AND x."IngestionDate" = s."IngestionDate")),
  firsts AS (SELECT l_partkey, l_suppkey, MIN("IngestionDate") AS f FROM pending GROUP BY ALL)
  SELECT t.* REPLACE (CASE WHEN "IsActive" = 'Y' AND f IS NOT NULL THEN f ELSE "ValidTo" END AS "ValidTo",
                      CASE WHEN "IsActive" = 'Y' AND f IS NOT NULL THEN 'N' ELSE "IsActive" END AS "IsActive")
  FROM tgt t LEFT JOIN firsts USING (l_partkey, l_suppkey) ORDER BY ALL
"""
INCREMENTAL_SQL = INCREMENTAL_SQL.replace(
    "SELECT t.* REPLACE",
    "SELECT l_partkey, l_suppkey, l_returnflag, l_linestatus, l_orderkey, l_linenumber, \"IngestionDate\", row_hash,"
    " \"LineID\", \"ValidTo\", \"IsActive\" FROM (SELECT t.* EXCLUDE (f) REPLACE",
).replace(
    "FROM tgt t LEFT JOIN firsts USING (l_partkey, l_suppkey) ORDER BY ALL",
    f"""FROM (SELECT tgt.*, f FROM tgt LEFT JOIN firsts USING (l_partkey, l_suppkey)) t)
  UNION ALL SELECT *, (SELECT MAX("LineID") FROM tgt) + ROW_NUMBER() OVER (ORDER BY l_partkey, l_suppkey, {_LINE_ORDER}),
         LEAD("IngestionDate") OVER (PARTITION BY l_partkey, l_suppkey ORDER BY {_LINE_ORDER}),
         CASE WHEN LEAD(row_hash) OVER (PARTITION BY l_partkey, l_suppkey ORDER BY {_LINE_ORDER}) IS NULL
              THEN 'Y' ELSE 'N' END FROM pending""",
)


def _first_lines(t: Tables) -> DataFrame:
    first = _line_states(t).filter(F.col("IngestionDate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    return history.incremental_history(first, None, *_LINE_ARGS)  # a scan of the rows it wrote; the hashes are computed anew


_LINE_ARGS = (
    ["l_partkey", "l_suppkey"],
    ["l_returnflag", "l_linestatus"],
    "LineID",
    ["l_orderkey", "l_linenumber"],
)


@query("scd_07_incremental_history", INCREMENTAL_SQL)
def incremental_history(t: Tables) -> DataFrame:
    """A first load up to a day, then the whole source once more."""
    return history.incremental_history(_line_states(t), _first_lines(t), *_LINE_ARGS)


@query("scd_07_state_table", INCREMENTAL_SQL)
def incremental_history_by_state(t: Tables) -> DataFrame:
    """The same with the table of one row per key that a job keeps beside its history."""
    first = _first_lines(t)
    state = materialise(history.history_state(first, _LINE_ARGS[0], "LineID"), "state")
    return history.incremental_history(_line_states(t), first, *_LINE_ARGS, state=state)


@query(
    "scd_07_first_load",
    f"""SELECT *, ROW_NUMBER() OVER (ORDER BY l_partkey, l_suppkey, {_LINE_ORDER}) AS "LineID",
          LEAD("IngestionDate") OVER (PARTITION BY l_partkey, l_suppkey ORDER BY {_LINE_ORDER}) AS "ValidTo",
          CASE WHEN LEAD(row_hash) OVER (PARTITION BY l_partkey, l_suppkey ORDER BY {_LINE_ORDER}) IS NULL
               THEN 'Y' ELSE 'N' END AS "IsActive" FROM ({LINE_STATES_SQL})""",
)
def first_load(t: Tables) -> DataFrame:
    return history.incremental_history(_line_states(t), None, *_LINE_ARGS)


def _invoices(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_custkey", "o_orderpriority", "o_orderkey", F.col("o_orderdate").alias("IngestionDate")
    )


INVOICE_HASH = ["InvoiceID", "o_orderkey", "o_custkey", "o_orderpriority", "Migrated", "IsActive"]
APPEND_RERANK_SQL = """
  WITH old AS (SELECT o_custkey, o_orderpriority, o_orderkey, o_orderdate AS "IngestionDate",
                 ROW_NUMBER() OVER (ORDER BY o_orderkey) AS "InvoiceID", 'update' AS row_action FROM orders
               WHERE o_orderstatus = 'F'),
  fresh AS (SELECT o_custkey, o_orderpriority, o_orderkey, o_orderdate,
              (SELECT MAX("InvoiceID") FROM old) + ROW_NUMBER() OVER (ORDER BY o_custkey, o_orderkey), 'create'
            FROM (SELECT * REPLACE (o_orderdate + INTERVAL 5 YEAR AS o_orderdate) FROM orders)
            WHERE o_orderdate > (SELECT MAX("IngestionDate") FROM old)),
  merged AS (SELECT * FROM old UNION ALL SELECT * FROM fresh),
  ranked AS (SELECT *, CASE WHEN LEAD(o_orderkey) OVER (PARTITION BY o_custkey, o_orderpriority
               ORDER BY o_orderkey, "InvoiceID") IS NULL THEN 'Y' ELSE 'N' END AS "IsActive" FROM merged)
  SELECT *, 1 AS "Migrated", CASE WHEN "IsActive" = 'N' THEN TIMESTAMP '2024-06-01' END AS "ValidTo",
         md5("InvoiceID" || o_orderkey::VARCHAR || o_custkey || o_orderpriority || '1' || "IsActive") AS "RowID" FROM ranked
"""


def _append_rerank(t: Tables) -> tuple[DataFrame, DataFrame]:
    from stratalake.operators.ordered import global_id

    none = {
        "Migrated": F.lit(None).cast("int"),
        "ValidTo": F.lit(None).cast("timestamp_ntz"),
        "RowID": F.lit(None).cast("string"),
        "IsActive": F.lit("Y"),
    }
    finished = t.orders.filter("o_orderstatus = 'F'").select("o_orderkey")
    old = _invoices(t).join(finished, "o_orderkey", "left_semi").withColumns(none)
    old = materialise(global_id(old, ["o_orderkey"], "InvoiceID"), "invoices")
    shifted = _invoices(t).withColumn("IngestionDate", F.col("IngestionDate") + F.expr("INTERVAL 5 YEAR"))
    changes = history.append_rerank(
        old,
        shifted.withColumns(none),
        ["o_custkey", "o_orderpriority"],
        ["o_orderkey"],
        "InvoiceID",
        ["o_custkey", "o_orderkey"],
        INVOICE_HASH,
        F.lit("2024-06-01").cast("timestamp_ntz"),
    )
    return old, changes


@query("scd_08_append_rerank", APPEND_RERANK_SQL)
def append_rerank(t: Tables) -> DataFrame:
    return _append_rerank(t)[1]


@query("scd_08_append_rerank_merged", f"SELECT * EXCLUDE (row_action) FROM ({APPEND_RERANK_SQL})")
def append_rerank_merged(t: Tables) -> DataFrame:
    """The changes applied: old rows get four columns, new rows are inserted."""
    old, changes = _append_rerank(t)
    return merge.merge_actions(old, materialise(changes, "changes"), ["InvoiceID"], "row_action", ["IsActive", "ValidTo", "Migrated", "RowID"])


@query(
    "scd_08_append_keys",
    """WITH old AS (SELECT o_custkey, o_orderpriority, o_orderkey, o_orderdate AS "IngestionDate", ROW_NUMBER() OVER (ORDER BY o_orderkey) AS "InvoiceID"
                    FROM orders WHERE o_orderstatus = 'F'),
            fresh AS (SELECT o_custkey, o_orderpriority, o_orderkey, o_orderdate + INTERVAL 20 YEAR,
                             (SELECT MAX("InvoiceID") FROM old) + ROW_NUMBER() OVER (ORDER BY o_custkey, o_orderkey) FROM orders WHERE o_custkey % 10 = 1),
            merged AS (SELECT *, FALSE AS f FROM old UNION ALL SELECT *, TRUE FROM fresh),
            r AS (SELECT *, LEAD(o_orderkey) OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey, "InvoiceID") IS NULL AS last,
                         bool_or(f) OVER (PARTITION BY o_custkey, o_orderpriority) AS hit FROM merged)
       SELECT o_custkey, o_orderpriority, o_orderkey, "IngestionDate", "InvoiceID", CASE WHEN last THEN 'Y' ELSE 'N' END AS "IsActive",
              CASE WHEN last THEN NULL WHEN hit THEN TIMESTAMP '2024-06-01' ELSE TIMESTAMP '2024-01-01' END AS "ValidTo" FROM r""",
)
def append_keys(t: Tables) -> DataFrame:
    """A second batch for some customers: the others keep their ranks and ends, and are no part of the changes."""
    old, _ = _append_rerank(t)
    keys, order = ["o_custkey", "o_orderpriority"], ["o_orderkey"]
    ids, booked = ["o_custkey", "o_orderkey"], ["IsActive", "ValidTo", "Migrated", "RowID"]
    day = lambda text: F.lit(text).cast("timestamp_ntz")
    none = {c: F.lit(None).cast(old.schema[c].dataType) for c in booked}
    first = history.append_rerank(old, old.drop("InvoiceID").limit(0), keys, order, "InvoiceID", ids, INVOICE_HASH, day("2024-01-01"))
    table = materialise(merge.merge_actions(old, materialise(first, "changes"), ["InvoiceID"], "row_action", booked), "invoices")
    later = _invoices(t).filter("o_custkey % 10 = 1").withColumn("IngestionDate", F.col("IngestionDate") + F.expr("INTERVAL 20 YEAR")).withColumns(none)
    second = history.append_rerank(table, later, keys, order, "InvoiceID", ids, INVOICE_HASH, day("2024-06-01"), only_appended_keys=True)
    out = merge.merge_actions(table, materialise(second, "changes"), ["InvoiceID"], "row_action", booked)
    return out.select(*keys, *order, "IngestionDate", "InvoiceID", "IsActive", "ValidTo")


# --- change messages and merges ------------------------------------------------------------------

MESSAGE_TYPES_SQL = """CASE event_type WHEN 'signup' THEN 'create' WHEN 'click' THEN 'update' WHEN 'purchase' THEN 'update'
                            ELSE 'delete' END"""


def _message_type() -> F.Column:
    return (
        F.when(F.col("event_type") == "signup", "Create")
        .when(F.col("event_type") == "click", "Publish")
        .when(F.col("event_type") == "purchase", "update")
        .otherwise(F.concat(F.lit("Delete "), "event_type"))
    )


@query(
    "scd_09_message_reconcile",
    f"""WITH day AS (SELECT MAX(CAST(ts AS DATE)) AS d FROM events),
        new AS (SELECT user_id, event_id, ts, {MESSAGE_TYPES_SQL} AS act FROM events, day WHERE CAST(ts AS DATE) = d),
        old AS (SELECT user_id, event_id, ts, CASE WHEN LEAD(event_id) OVER w IS NULL THEN 'Y' ELSE 'N' END AS active,
                       LEAD(ts) OVER w AS until FROM events, day WHERE CAST(ts AS DATE) < d
                WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
        closing AS (SELECT user_id, MIN(ts) AS f FROM new WHERE act <> 'create' GROUP BY user_id)
        SELECT user_id, event_id, ts AS "IngestionDate", NULL AS "ValidTo", 'Y' AS "IsActive" FROM new WHERE act <> 'delete'
        UNION SELECT user_id, event_id, ts, CASE WHEN active = 'Y' AND f IS NOT NULL THEN f ELSE until END,
               CASE WHEN active = 'Y' AND f IS NOT NULL THEN 'N' ELSE active END FROM old LEFT JOIN closing USING (user_id)""",
)
def message_reconcile(t: Tables) -> DataFrame:
    """The last day arrives as messages on the history of all days before."""
    last_day = F.to_date(t.events.agg(F.max("ts")).scalar())
    rows = t.events.select("user_id", "event_id", "event_type", F.col("ts").alias("IngestionDate"))
    old = rows.filter(F.to_date("IngestionDate") < last_day).drop("event_type")
    old = history.rank_history(old, ["user_id"], ["event_id"])
    new = rows.filter(F.to_date("IngestionDate") == last_day).select(
        "user_id",
        "event_id",
        "IngestionDate",
        F.lit(None).cast("timestamp_ntz").alias("ValidTo"),
        F.lit("Y").alias("IsActive"),
        merge.message_action(_message_type()).alias("action"),
    )
    return merge.reconcile_messages(old, new, "user_id", "action")


def _changed_customers(t: Tables) -> DataFrame:
    act = (
        F.when(F.col("c_mktsegment") == "BUILDING", "Updated")
        .when(F.col("c_mktsegment") == "MACHINERY", "DELETE")
        .otherwise("create")
    )
    return t.customer.select(
        "c_custkey", F.lit("changed").alias("c_name"), F.lit("changed").alias("c_mktsegment"), act.alias("row_action")
    )


@query(
    "scd_10_action_merge",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 AND c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN 'changed' ELSE c_name END
              AS c_name, CASE WHEN c_mktsegment = 'BUILDING' AND c_acctbal >= 0
              OR c_acctbal < 0 AND c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN 'changed' ELSE c_mktsegment END AS c_mktsegment
       FROM customer WHERE (c_acctbal >= 0 AND c_mktsegment <> 'MACHINERY')
                        OR (c_acctbal < 0 AND c_mktsegment NOT IN ('BUILDING', 'MACHINERY'))""",
)
def action_merge(t: Tables) -> DataFrame:
    """Debtors are not in the table: their creates are inserted, their updates and deletes do nothing."""
    target = t.customer.filter("c_acctbal >= 0").select("c_custkey", "c_name", "c_mktsegment")
    return merge.merge_actions(target, _changed_customers(t), ["c_custkey"], "row_action", ["c_mktsegment"])


def _order_documents(t: Tables) -> DataFrame:
    """Orders with their lines as a nested array."""
    item = F.struct("l_linenumber", "l_partkey")
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sort_array(F.collect_list(item)).alias("lines"))
    return t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority").join(lines, "o_orderkey")


@query(
    "scd_11_hash_upsert",
    """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderpriority = '5-LOW' THEN 'create' ELSE 'update' END AS row_action
       FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
         AND (o_orderpriority = '5-LOW' OR o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber > 6))""",
)
def hash_labels(t: Tables) -> DataFrame:
    """Only long orders differ, and only inside their array; low orders are new."""
    new = _order_documents(t)
    short = new.withColumn("lines", F.filter("lines", lambda x: x["l_linenumber"] <= 6))
    existing = short.filter("o_orderpriority <> '5-LOW'")
    return merge.label_changes(new, existing, "o_orderkey", "row_action").select("o_orderkey", "o_orderstatus", "row_action")


@query(
    "scd_11_hash_upsert_merged",
    """SELECT o_orderkey, o_orderstatus, COUNT(*) AS n_lines FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL""",
)
def hash_upsert(t: Tables) -> DataFrame:
    new = materialise(_order_documents(t), "documents")
    existing = new.withColumn("lines", F.filter("lines", lambda x: x["l_linenumber"] <= 6)).filter("o_orderpriority <> '5-LOW'")
    out = merge.hash_upsert(new, existing, "o_orderkey")
    return out.select("o_orderkey", "o_orderstatus", F.size("lines").cast("bigint").alias("n_lines"))


@query(
    "scd_12_close_deleted",
    f"""WITH months AS (SELECT DISTINCT o_custkey, date_trunc('year', o_orderdate) AS m FROM orders),
        gone AS (SELECT o_custkey FROM months GROUP BY o_custkey HAVING MAX(m) < (SELECT MAX(m) FROM months)),
        h AS (SELECT o_orderkey, o_custkey, o_orderdate AS "IngestionDate", LEAD(o_orderdate) OVER w AS until,
                     LEAD(o_orderkey) OVER w IS NULL AND o_custkey NOT IN (SELECT o_custkey FROM gone) AS active
              FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
        SELECT o_orderkey, o_custkey, "IngestionDate",
               CASE WHEN NOT active THEN COALESCE(until, CAST(CAST("IngestionDate" AS DATE) + INTERVAL 1 DAY AS TIMESTAMP)) END AS "ValidTo",
               CASE WHEN active THEN 'Y' ELSE 'N' END AS "IsActive" FROM h""",
)
def close_deleted(t: Tables) -> DataFrame:
    """Years are the snapshots: a customer without an order in the newest one is gone."""
    snapshots = t.orders.select("o_custkey", F.date_trunc("year", "o_orderdate").alias("loaded"))
    gone = history.deleted_keys(snapshots, "o_custkey", "loaded")
    versions = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("IngestionDate"))
    ours = history.rank_history(versions, ["o_custkey"], ["o_orderkey"])
    return history.close_deleted(ours, gone, {"o_custkey": "o_custkey"})


def _parts_history(t: Tables) -> DataFrame:
    """Parts as loaded before: brown goods missing, economy parts under another type."""
    kind = F.when(F.col("p_type") == "ECONOMY", "BUDGET").otherwise(F.col("p_type"))
    ids = ["p_partkey", "p_brand", "p_type"]
    known = t.part.filter("p_size <= 25").withColumn("p_type", kind)
    return known.select(
        *ids,
        F.lit("2024-01-01").cast("timestamp").alias("dateReceived"),
        F.lit(None).cast("timestamp").alias("validTo"),
        history.row_id(ids).alias("rowID"),
        F.lit("Y").alias("isActive"),
    )


PARTS_HISTORY_SQL = """
  SELECT p_partkey, p_brand, CASE WHEN p_type = 'ECONOMY' THEN 'BUDGET' ELSE p_type END AS p_type,
         TIMESTAMP '2024-01-01' AS "dateReceived", CASE WHEN p_type = 'ECONOMY' THEN TIMESTAMP '2024-02-01' END AS "validTo",
         md5(p_partkey || p_brand || CASE WHEN p_type = 'ECONOMY' THEN 'BUDGET' ELSE p_type END) AS "rowID",
         CASE WHEN p_type = 'ECONOMY' THEN 'N' ELSE 'Y' END AS "isActive" FROM part WHERE p_size <= 25
  UNION ALL SELECT p_partkey, p_brand, p_type, TIMESTAMP '2024-02-01', NULL, md5(p_partkey || p_brand || p_type), 'Y'
  FROM part WHERE p_size > 25 OR p_type = 'ECONOMY'
"""


def _reference_history(t: Tables) -> DataFrame:
    from stratalake.functions.contract import HistoryColumns

    cols = HistoryColumns(valid_from="dateReceived", valid_to="validTo", active="isActive", row_id="rowID")
    now = F.lit("2024-02-01").cast("timestamp")
    snapshot = t.part.select("p_partkey", "p_brand", "p_type", now.alias("dateReceived"))
    ids = ["p_partkey", "p_brand", "p_type"]
    out = history.snapshot_history(snapshot, _parts_history(t), "p_partkey", ids, closed_at=now, cols=cols)
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("dateReceived", "validTo")})


@query("scd_13_reference_history", PARTS_HISTORY_SQL)
def reference_history(t: Tables) -> DataFrame:
    return _reference_history(t)


@query(
    "scd_11_hash_upsert_buckets",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 100 < 2 THEN 'changed' ELSE o_orderpriority END AS o_orderpriority,
              CASE WHEN o_orderkey % 100 < 2 THEN 2 ELSE 1 END AS written FROM orders""",
)
def hash_upsert_buckets(t: Tables) -> DataFrame:
    """Two snapshots into a table in buckets; ``written`` tells which of them brought a row."""
    table = _scratch_table(t, "orders")
    rows = t.orders.select("o_orderkey", "o_orderpriority", F.lit(1).alias("written"))
    sinks.upsert_table(rows.filter("o_orderkey % 100 <> 0"), table, "o_orderkey", 64)
    hit = F.col("o_orderkey") % 100 < 2
    second = rows.withColumns({"o_orderpriority": F.when(hit, "changed").otherwise(F.col("o_orderpriority")), "written": F.when(hit, 2).otherwise(1)})
    sinks.upsert_table(second, table, "o_orderkey", 64)
    return sinks.read_buckets(t.spark, table)


@query(
    "scd_13_reference_counts",
    """SELECT COUNT(*) FILTER (p_size > 25) AS insert_count, COUNT(*) FILTER (p_size <= 25 AND p_type = 'ECONOMY') AS update_count
       FROM part""",
)
def reference_counts(t: Tables) -> DataFrame:
    """A reference not seen before is an insert, a known one that changed is an update."""
    before = _parts_history(t).select(F.col("p_partkey").alias("_known"))
    started = _reference_history(t).filter("dateReceived = TIMESTAMP_NTZ '2024-02-01 00:00:00'")
    marked = started.join(before, F.col("p_partkey") == F.col("_known"), "left")
    return marked.agg(
        F.count_if(F.col("_known").isNull()).alias("insert_count"),
        F.count_if(F.col("_known").isNotNull()).alias("update_count"),
    )


@query(
    "scd_14_aligned_upsert",
    """SELECT p_partkey, p_name, p_type, CASE WHEN p_size <= 25 THEN 'kept' END AS note FROM part""",
)
def aligned_upsert(t: Tables) -> DataFrame:
    """The table has a note the source does not know, the source has columns the table does not have."""
    kind = F.when(F.col("p_type") == "ECONOMY", "BUDGET").otherwise(F.col("p_type"))
    existing = t.part.filter("p_size <= 25").select("p_partkey", "p_name", kind.alias("p_type"), F.lit("kept").alias("note"))
    return merge.aligned_upsert(t.part, existing, "p_partkey")


@query(
    "scd_15_lookup_history",
    """SELECT n_nationkey, n_name, "IngestionDate", "IsActive" FROM (
         SELECT n_nationkey, CASE WHEN n_regionkey = 0 THEN 'old ' || n_name ELSE n_name END AS n_name,
                TIMESTAMP '2024-01-01' AS "IngestionDate", CASE WHEN n_regionkey = 0 THEN 'N' ELSE 'Y' END AS "IsActive" FROM nation
         UNION ALL SELECT n_nationkey, n_name, TIMESTAMP '2024-02-01', 'Y' FROM nation WHERE n_regionkey = 0)""",
)
def lookup_history(t: Tables) -> DataFrame:
    """A one-source lookup table versioned by the md5 of its columns."""
    ids = ["n_nationkey", "n_name"]
    old_name = F.when(F.col("n_regionkey") == 0, F.concat(F.lit("old "), "n_name")).otherwise(F.col("n_name"))
    current = t.nation.withColumn("n_name", old_name).select(
        *ids,
        F.lit("2024-01-01").cast("timestamp").alias("IngestionDate"),
        F.lit(None).cast("timestamp").alias("ValidTo"),
        history.row_id(ids).alias("RowID"),
        F.lit("Y").alias("IsActive"),
    )
    snapshot = t.nation.select(*ids, F.lit("2024-02-01").cast("timestamp").alias("IngestionDate"))
    out = history.snapshot_history(snapshot, current, "n_nationkey", ids)
    return out.select(*ids, F.col("IngestionDate").cast("timestamp_ntz"), "IsActive")


@query(
    "scd_16_fan_out",
    """SELECT o_orderstatus AS view, COUNT(*) AS active FROM (SELECT * FROM orders QUALIFY ROW_NUMBER() OVER (
         PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
       WHERE o_orderstatus IN ('F', 'P') GROUP BY o_orderstatus""",
)
def fan_out(t: Tables) -> DataFrame:
    versions = history.rank_history(customer_versions(t).drop("ValidTo"), ["o_custkey"], ["o_orderkey"])
    views = history.fan_out(versions, "o_orderstatus", ["F", "P"])
    counted = [v.groupBy(F.col("o_orderstatus").alias("view")).agg(F.count(F.lit(1)).alias("active")) for v in views.values()]
    return counted[0].unionByName(counted[1])


@query(
    "scd_17_ticket_merge",
    """SELECT event_id, event_type, CASE WHEN event_type IN ('click', 'view') THEN 'extract' ELSE 'history' END AS origin
       FROM events""",
)
def ticket_merge(t: Tables) -> DataFrame:
    """History is split into new and known tickets against an extract; only the new ones are inserted."""
    extract = t.events.filter("event_type IN ('click', 'view')").select("event_id", "event_type", F.lit("extract").alias("origin"))
    past = t.events.select("event_id", "event_type", F.lit("history").alias("origin"))
    labelled = merge.label_changes(past, extract, "event_id", "row_action", ["event_type"])
    parts = merge.split_changes(labelled, "row_action")
    return merge.merge_actions(extract, parts["create"].withColumn("row_action", F.lit("create")), ["event_id"], "row_action")
