"""Queries for latest-record selection, window positions, keys and hashes, and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions import keys as K
from stratalake.operators import latest, quality, sets
from stratalake.operators.ordered import along, global_id
from stratalake.plans.murmur import hash_sql, magnitude_sql
from stratalake.plans.queries_shape import ORDER_VERSIONS_SQL, order_versions
from stratalake.plans.registry import Tables, query

# --- latest record -------------------------------------------------------------------------------


@query("ded_01_exact", "SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders")
def exact(t: Tables) -> DataFrame:
    return latest.exact_distinct(t.orders.select("o_custkey", "o_orderstatus", "o_orderpriority"))


@query(
    "ded_02_subset",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag FROM lineitem
       QUALIFY ROW_NUMBER() OVER (PARTITION BY l_partkey, l_suppkey, l_returnflag
                                  ORDER BY l_orderkey, l_linenumber, l_extendedprice, l_quantity) = 1""",
)
def subset(t: Tables) -> DataFrame:
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_extendedprice", "l_quantity"
    )
    order = ["l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"]
    one = latest.distinct_on(lines, ["l_partkey", "l_suppkey", "l_returnflag"], order)
    return one.drop("l_extendedprice", "l_quantity")


@query(
    "ded_03_latest_snapshot",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate = (SELECT MAX(o_orderdate) FROM orders)",
)
def latest_snapshot(t: Tables) -> DataFrame:
    return latest.latest_snapshot(t.orders, "o_orderdate").select("o_orderkey", "o_custkey")


@query(
    "ded_04_latest_per_key",
    """SELECT l_partkey, l_shipdate, l_orderkey, l_linenumber, l_extendedprice FROM lineitem
       QUALIFY ROW_NUMBER() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC,
                                  l_linenumber DESC, l_extendedprice DESC) = 1""",
)
def latest_per_key(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice")
    return latest.latest_per_key(lines, ["l_partkey"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice"])


@query(
    "ded_05_latest_load",
    """SELECT user_id, CAST(ts AS DATE) AS expected_from, event_type AS modified_datetime, ts AS ingested_datetime,
              event_id AS file_id FROM events
       QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC, event_type DESC, ts DESC,
                                  event_id DESC) = 1""",
)
def latest_load(t: Tables) -> DataFrame:
    loads = t.events.select(
        "user_id",
        F.to_date("ts").alias("expected_from"),
        F.col("event_type").alias("modified_datetime"),
        F.col("ts").alias("ingested_datetime"),
        F.col("event_id").alias("file_id"),
    )
    return latest.latest_load(loads, ["user_id"])


@query(
    "ded_06_latest_with_ties",
    """SELECT l_partkey, l_orderkey, l_linenumber FROM lineitem
       QUALIFY RANK() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC) = 1""",
)
def latest_with_ties(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_partkey", "l_orderkey", "l_linenumber", "l_shipdate")
    return latest.latest_with_ties(lines, ["l_partkey"], "l_shipdate").drop("l_shipdate")


@query(
    "ded_07_flag_or_latest",
    f"""SELECT 'flagged' AS variant, o_custkey, o_orderkey FROM ({ORDER_VERSIONS_SQL}) WHERE "IsActive" = 'Y'
        UNION ALL SELECT 'newest', o_custkey, o_orderkey FROM orders
        QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def flag_or_latest(t: Tables) -> DataFrame:
    by = ["o_orderdate", "o_orderkey"]
    flagged = latest.active_or_latest(order_versions(t), ["o_custkey"], by)
    newest = latest.active_or_latest(t.orders, ["o_custkey"], by)
    cols = ["variant", "o_custkey", "o_orderkey"]
    return (
        flagged.withColumn("variant", F.lit("flagged"))
        .select(*cols)
        .unionByName(newest.withColumn("variant", F.lit("newest")).select(*cols))
    )


@query(
    "ded_08_source_priority",
    """SELECT key, origin, seen FROM (
         SELECT 1 AS p, user_id AS key, 'events' AS origin, ts AS seen, event_id AS tie FROM events
         UNION ALL SELECT 2, o_custkey, 'orders', o_orderdate, o_orderkey FROM orders)
       QUALIFY ROW_NUMBER() OVER (PARTITION BY key ORDER BY p, seen DESC, tie DESC) = 1""",
)
def source_priority(t: Tables) -> DataFrame:
    def shaped(df: DataFrame, key: str, origin: str, seen: str, tie: str) -> DataFrame:
        return df.select(
            F.col(key).alias("key"), F.lit(origin).alias("origin"), F.col(seen).alias("seen"), F.col(tie).alias("tie")
        )

    a = shaped(t.events, "user_id", "events", "ts", "event_id")
    b = shaped(t.orders, "o_custkey", "orders", "o_orderdate", "o_orderkey")
    return latest.by_source_priority({1: a, 2: b}, ["key"], ["seen", "tie"]).drop("tie")


@query(
    "ded_09_month_end",
    """SELECT o_custkey, MAX(o_orderdate) AS month_end, COUNT(*) AS n FROM (
         SELECT o_custkey, last_day(o_orderdate) AS o_orderdate FROM orders
         QUALIFY RANK() OVER (PARTITION BY o_custkey ORDER BY last_day(o_orderdate) DESC) = 1) GROUP BY o_custkey""",
)
def month_end(t: Tables) -> DataFrame:
    months = t.orders.select("o_custkey", F.last_day("o_orderdate").alias("month_end"))
    last = latest.latest_with_ties(months, ["o_custkey"], "month_end")
    return last.groupBy("o_custkey").agg(F.max("month_end").alias("month_end"), F.count(F.lit(1)).alias("n"))


RUNS_SQL = """
  SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS entity_name, props AS stage_name,
         ts AS execution_start_time, CAST(event_id AS VARCHAR) AS execution_finish_time FROM events
"""


def _runs(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("user_id").cast("string").alias("run_id"),
        F.col("event_type").alias("entity_name"),
        F.col("props").alias("stage_name"),
        F.col("ts").alias("execution_start_time"),
        F.col("event_id").cast("string").alias("execution_finish_time"),
    )


@query(
    "ded_10_latest_run",
    f"""SELECT * FROM ({RUNS_SQL}) QUALIFY ROW_NUMBER() OVER (PARTITION BY run_id, entity_name, stage_name
        ORDER BY execution_start_time DESC, execution_finish_time DESC) = 1""",
)
def latest_run(t: Tables) -> DataFrame:
    return quality.latest_runs(_runs(t))


# --- positions on a timeline ---------------------------------------------------------------------


@query(
    "win_01_version_rank",
    """SELECT o_custkey, o_orderkey, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC,
              o_orderkey DESC) AS version FROM orders""",
)
def version_rank(t: Tables) -> DataFrame:
    out = along(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], reverse_rank="version")
    return out.select("o_custkey", "o_orderkey", "version")


@query(
    "win_02_global_id",
    "SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) AS id FROM orders",
)
def global_ids(t: Tables) -> DataFrame:
    return global_id(t.orders.select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"], "id").drop("o_orderdate")


@query(
    "win_03_global_id_continued",
    """SELECT o_orderkey, (SELECT MAX(c_custkey) FROM customer) + ROW_NUMBER() OVER (ORDER BY o_custkey, o_orderkey) AS id
       FROM orders""",
)
def global_ids_continued(t: Tables) -> DataFrame:
    start = t.customer.agg(F.max("c_custkey")).scalar()
    return global_id(t.orders.select("o_custkey", "o_orderkey"), ["o_custkey", "o_orderkey"], "id", start).drop("o_custkey")


@query(
    "win_04_renumber",
    """SELECT key, ROW_NUMBER() OVER (ORDER BY old_id NULLS LAST, key) AS id FROM (
         SELECT c_name AS key, c_custkey * 10 AS old_id FROM customer UNION ALL SELECT s_name, NULL FROM supplier)""",
)
def renumber(t: Tables) -> DataFrame:
    from stratalake.operators.history import renumber as again

    old = t.customer.select(F.col("c_name").alias("key"), (F.col("c_custkey") * 10).alias("id"))
    new = t.supplier.select(F.col("s_name").alias("key"), F.lit(None).cast("bigint").alias("id"))
    return again(old.unionByName(new), "id", ["key"])


@query(
    "win_05_change_marks",
    """SELECT event_id, COALESCE(LAG(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) <> event_type, TRUE)
              AS changed FROM events""",
)
def change_marks(t: Tables) -> DataFrame:
    seen = along(t.events, ["user_id"], ["ts", "event_id"], previous={"before": "event_type"})
    return seen.select("event_id", F.coalesce(F.col("before") != F.col("event_type"), F.lit(True)).alias("changed"))


@query(
    "win_06_valid_to",
    "SELECT event_id, LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to FROM events",
)
def valid_to(t: Tables) -> DataFrame:
    return along(t.events, ["user_id"], ["ts", "event_id"], following={"valid_to": "ts"}).select("event_id", "valid_to")


@query(
    "win_07_tie_collapse",
    """SELECT o_custkey, o_orderdate, o_orderstatus, o_orderkey,
              ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderstatus, o_orderkey) AS tie
       FROM (SELECT * FROM orders QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderdate, o_orderstatus
             ORDER BY o_orderkey) = 1)""",
)
def tie_collapse(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderdate", "o_orderstatus", "o_orderkey")
    once = latest.distinct_on(rows, ["o_custkey", "o_orderdate", "o_orderstatus"], ["o_orderkey"])
    return along(once, ["o_custkey", "o_orderdate"], ["o_orderstatus", "o_orderkey"], rank="tie")


@query(
    "win_08_keep_max",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
       QUALIFY o_totalprice = MAX(o_totalprice) OVER (PARTITION BY o_custkey)""",
)
def keep_max(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return latest.latest_with_ties(rows, ["o_custkey"], "o_totalprice")


@query(
    "win_09_latest_id_wins",
    """SELECT l_partkey, l_suppkey, MAX(l_orderkey) AS l_orderkey FROM lineitem GROUP BY ALL""",
)
def latest_id_wins(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_partkey", "l_suppkey", "l_orderkey")
    return latest.latest_per_key(rows, ["l_partkey", "l_suppkey"], ["l_orderkey"])


@query(
    "win_10_row_number",
    "SELECT event_type, event_id, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY event_id) AS row_no FROM events",
)
def row_number(t: Tables) -> DataFrame:
    return along(t.events.select("event_type", "event_id"), ["event_type"], ["event_id"], rank="row_no")


# --- keys and hashes -----------------------------------------------------------------------------

NULLABLE_SQL = "CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END"


def _nullable(t: Tables) -> DataFrame:
    """Orders whose priority is only known while they are not finished."""
    return t.orders.withColumn("prio", F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")))


@query(
    "key_01_row_id",
    f"""SELECT o_orderkey, md5(o_orderkey || COALESCE({NULLABLE_SQL}, '.') || o_orderdate::VARCHAR) AS row_id FROM orders""",
)
def row_id(t: Tables) -> DataFrame:
    return _nullable(t).select("o_orderkey", K.row_id(["o_orderkey", "prio", "o_orderdate"]).alias("row_id"))


@query(
    "key_02_row_id_joined",
    f"""SELECT o_orderkey, md5(concat_ws('|', o_orderkey, {NULLABLE_SQL}, o_orderstatus)) AS skipping,
               md5(concat_ws('', o_orderkey, COALESCE({NULLABLE_SQL}, '.'), o_orderstatus)) AS filling FROM orders""",
)
def row_id_joined(t: Tables) -> DataFrame:
    parts = ["o_orderkey", "prio", "o_orderstatus"]
    return _nullable(t).select(
        "o_orderkey",
        K.row_id_ws(parts, "|").alias("skipping"),
        K.row_id_ws(parts, "", null=".").alias("filling"),
    )


@query(
    "key_03_row_id_all_columns",
    f"""SELECT o_orderkey, md5(COALESCE({NULLABLE_SQL}, '.') || o_orderstatus || o_custkey) AS row_id FROM orders""",
)
def row_id_all_columns(t: Tables) -> DataFrame:
    """All listed columns count, not the first that is filled: two orders of one priority stay apart."""
    return _nullable(t).select("o_orderkey", K.row_id(["prio", "o_orderstatus", "o_custkey"]).alias("row_id"))


@query(
    "key_04_state_hash",
    f"""SELECT o_orderkey, sha256(o_custkey || '||' || COALESCE({NULLABLE_SQL}, '') || '||' || o_orderstatus) AS state_hash
        FROM orders""",
)
def state_hash(t: Tables) -> DataFrame:
    return _nullable(t).select("o_orderkey", K.state_hash(["o_custkey", "prio", "o_orderstatus"]).alias("state_hash"))


@query(
    "key_05_business_key",
    "SELECT l_orderkey, l_linenumber, sha256(l_orderkey || '~' || l_linenumber) AS business_key FROM lineitem",
)
def business_key(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", K.business_key(["l_orderkey", "l_linenumber"]).alias("business_key")
    )


@query(
    "key_06_json_hash",
    """SELECT c_custkey, sha256('{"c_name":"' || c_name || '","c_nationkey":' || c_nationkey || '}') AS json_hash
       FROM customer""",
)
def json_hash(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", K.json_hash(["c_name", "c_nationkey"]).alias("json_hash"))


@query(
    "key_07_composite_key",
    f"""SELECT o_orderkey, md5(o_orderkey || COALESCE({NULLABLE_SQL}, '') || o_orderstatus) AS temp_key FROM orders""",
)
def composite_key(t: Tables) -> DataFrame:
    return _nullable(t).select("o_orderkey", K.composite_key(["o_orderkey", "prio", "o_orderstatus"]).alias("temp_key"))


@query(
    "key_08_incremental_key",
    f"""SELECT event_id, {magnitude_sql("pair_hash")} AS incremental_key
        FROM ({hash_sql(hash_sql("SELECT event_id, user_id, ts FROM events", "user_id::VARCHAR", "first_hash"), "ts::VARCHAR", "pair_hash", "first_hash")})""",
)
def incremental_key(t: Tables) -> DataFrame:
    return t.events.select("event_id", K.incremental_key("user_id", "ts").alias("incremental_key"))


@query(
    "key_09_order_row_id",
    f"""SELECT o_orderkey, COALESCE({NULLABLE_SQL}, '~') AS order_id FROM orders""",
)
def order_row_id(t: Tables) -> DataFrame:
    return _nullable(t).select("o_orderkey", K.order_row_id("prio").alias("order_id"))


@query(
    "udf_01_absolute",
    "SELECT c_custkey, ABS(CAST(trunc(c_acctbal) AS BIGINT)) AS whole FROM customer",
)
def absolute(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", K.absolute("c_acctbal").alias("whole"))


# --- set operations ------------------------------------------------------------------------------


def _people(t: Tables) -> tuple[DataFrame, DataFrame]:
    a = t.customer.select(F.col("c_nationkey").alias("nation"), F.signum("c_acctbal").cast("int").alias("sign"))
    b = t.supplier.select(F.signum("s_acctbal").cast("int").alias("sign"), F.col("s_nationkey").alias("nation"))
    return a, b


PEOPLE_A = "SELECT c_nationkey AS nation, CAST(sign(c_acctbal) AS INTEGER) AS sign FROM customer"
PEOPLE_B = "SELECT s_nationkey AS nation, CAST(sign(s_acctbal) AS INTEGER) AS sign FROM supplier"


@query("set_01_union_aligned", f"{PEOPLE_A} UNION ALL {PEOPLE_B}")
def union_aligned(t: Tables) -> DataFrame:
    return sets.union_aligned(*_people(t))


@query(
    "set_02_union_padded",
    """SELECT n_nationkey AS key, n_name AS name, n_regionkey AS region FROM nation
       UNION ALL SELECT r_regionkey, r_name, NULL FROM region""",
)
def union_padded(t: Tables) -> DataFrame:
    return sets.union_padded(
        t.nation.toDF("key", "name", "region"), t.region.select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("name"))
    )


@query("set_03_union_distinct", f"{PEOPLE_A} UNION {PEOPLE_B}")
def union_distinct(t: Tables) -> DataFrame:
    return sets.union_distinct(*_people(t))


@query("set_04_union_all", f"{PEOPLE_B} UNION ALL {PEOPLE_A} UNION ALL {PEOPLE_B}")
def union_all(t: Tables) -> DataFrame:
    a, b = _people(t)
    return sets.union_all(sets.union_all(b, a), b)


@query(
    "set_05_multiset_diff",
    f"""SELECT nation, sign, CASE WHEN n > 0 THEN 'missing' ELSE 'unexpected' END AS side, ABS(n)::BIGINT AS copies
        FROM (SELECT nation, sign, SUM(v) AS n FROM (SELECT *, 1 AS v FROM ({PEOPLE_A}) UNION ALL
              SELECT *, -1 FROM ({PEOPLE_B})) GROUP BY nation, sign) WHERE n <> 0""",
)
def multiset_diff(t: Tables) -> DataFrame:
    a, b = _people(t)
    return sets.multiset_diff(a, b.select("nation", "sign"))


@query(
    "set_06_affected_keys",
    """SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'
       UNION SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'""",
)
def affected_keys(t: Tables) -> DataFrame:
    new = t.orders.filter("o_orderpriority = '1-URGENT'").select("o_custkey")
    return sets.affected_keys(new, t.orders.filter("o_orderstatus = 'P'").select("o_custkey"))


@query(
    "win_11_hot_key_timeline",
    """WITH e AS (SELECT CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END AS key, ts, event_id FROM events)
       SELECT key, event_id, LAG(event_id) OVER w AS before, LEAD(event_id) OVER w AS after,
              ROW_NUMBER() OVER w AS place, ROW_NUMBER() OVER (PARTITION BY key ORDER BY ts DESC, event_id DESC) AS from_end
       FROM e WINDOW w AS (PARTITION BY key ORDER BY ts, event_id)""",
)
def hot_key_timeline(t: Tables) -> DataFrame:
    """A third of all rows share one key, whose timeline is cut into slices."""
    key = F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id"))
    rows = t.events.select(key.alias("key"), "ts", "event_id")
    line = along(
        rows, ["key"], ["ts", "event_id"], {"before": "event_id"}, {"after": "event_id"}, rank="place", reverse_rank="from_end", hot_rows=1000
    )
    return line.drop("ts")
