"""Queries for joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions import masks
from stratalake.operators import joins, nested
from stratalake.operators.ordered import along, chunk_groups, global_id
from stratalake.plans.registry import Tables, query

# --- joins ---------------------------------------------------------------------------------------


@query(
    "jon_01_star",
    """SELECT l_orderkey, l_linenumber, c_name AS customer, p_name AS part, s_name AS supplier FROM lineitem
       LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
       LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey""",
)
def star(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    dims = [
        (t.orders, {"l_orderkey": "o_orderkey"}, {"o_custkey": "_customer"}),
        (t.customer, {"_customer": "c_custkey"}, {"c_name": "customer"}),
        (t.part, {"l_partkey": "p_partkey"}, {"p_name": "part"}),
        (t.supplier, {"l_suppkey": "s_suppkey"}, {"s_name": "supplier"}),
    ]
    return joins.enrich_star(lines, dims).select("l_orderkey", "l_linenumber", "customer", "part", "supplier")


@query(
    "jon_02_cast_composite",
    """SELECT l_orderkey, l_linenumber, o_orderstatus FROM lineitem
       LEFT JOIN orders ON o_orderkey = l_orderkey AND substr(o_orderpriority, 1, 1) = CAST(l_linenumber AS VARCHAR)""",
)
def cast_composite(t: Tables) -> DataFrame:
    other = t.orders.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.substring("o_orderpriority", 1, 1).alias("version"),
        "o_orderstatus",
    )
    lines = t.lineitem.select("l_orderkey", "l_linenumber")
    on = [("l_orderkey", "id", "bigint"), ("l_linenumber", "version", "int")]
    return joins.enrich_cast(lines, other, on, {"o_orderstatus": "o_orderstatus"})


@query(
    "jon_03_exists_flag",
    """SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
                              THEN '1' ELSE '0' END AS migrated FROM customer""",
)
def exists_flag(t: Tables) -> DataFrame:
    pending = t.orders.filter("o_orderstatus = 'P'")
    return joins.flag_exists(t.customer.select("c_custkey"), pending, {"c_custkey": "o_custkey"}, "migrated")


@query(
    "jon_04_left_anti",
    "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')",
)
def left_anti(t: Tables) -> DataFrame:
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'")
    return joins.without(t.customer.select("c_custkey"), urgent, {"c_custkey": "o_custkey"})


@query(
    "jon_05_temporal_anti",
    """SELECT a.o_orderkey, a.o_custkey FROM orders a WHERE a.o_orderstatus <> 'P' AND NOT EXISTS (
         SELECT 1 FROM (SELECT o_custkey AS k, MIN(o_orderdate) AS first FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) b
         WHERE k = a.o_custkey AND a.o_orderdate >= first)""",
)
def temporal_anti(t: Tables) -> DataFrame:
    a = t.orders.filter("o_orderstatus <> 'P'").select("o_orderkey", "o_custkey", "o_orderdate")
    b = t.orders.filter("o_orderstatus = 'P'")
    return joins.without_from(a, b, "o_custkey", "o_orderdate", "o_orderdate").drop("o_orderdate")


@query(
    "jon_06_semi",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)",
)
def semi(t: Tables) -> DataFrame:
    debtors = t.customer.filter("c_acctbal < 0")
    return joins.within(t.orders.select("o_orderkey", "o_custkey"), debtors, {"o_custkey": "c_custkey"})


@query(
    "jon_07_constants",
    """SELECT o_orderkey, (SELECT MAX(c_custkey) FROM customer) AS top_customer,
              (SELECT COUNT(*) FROM customer) AS customers FROM orders""",
)
def constants(t: Tables) -> DataFrame:
    facts = t.customer.agg(F.max("c_custkey").alias("top_customer"), F.count(F.lit(1)).alias("customers"))
    return joins.attach_constants(t.orders.select("o_orderkey"), facts)


@query(
    "jon_08_scalar",
    "SELECT s_suppkey, (SELECT r_name FROM region WHERE r_regionkey = 0) AS home FROM supplier",
)
def scalar(t: Tables) -> DataFrame:
    return joins.attach_scalar(t.supplier.select("s_suppkey"), t.region.filter("r_regionkey = 0"), "r_name", "home")


@query(
    "jon_09_next_version",
    """SELECT o_orderkey, LEAD(o_orderkey) OVER w AS next_key, LEAD(o_orderdate) OVER w AS next_date FROM orders
       WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
)
def next_version(t: Tables) -> DataFrame:
    """The adjacent version by one window; nothing is joined to itself."""
    ahead = {"next_key": "o_orderkey", "next_date": "o_orderdate"}
    out = along(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], following=ahead)
    return out.select("o_orderkey", "next_key", "next_date")


@query(
    "jon_10_reattach_in_place",
    """SELECT o_orderkey, o_orderdate + INTERVAL 1 DAY AS due, o_totalprice > 100000 AS large FROM orders""",
)
def reattach_in_place(t: Tables) -> DataFrame:
    computed = {"due": F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"), "large": F.col("o_totalprice") > 100000}
    return joins.reattach(t.orders, computed).select("o_orderkey", "due", "large")


@query(
    "jon_11_reattach_by_id",
    """SELECT id, o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE 'open' END AS state FROM (
         SELECT *, ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) AS id FROM orders)""",
)
def reattach_by_id(t: Tables) -> DataFrame:
    """The id and what depends on it are set on the row itself."""
    numbered = global_id(t.orders, ["o_orderdate", "o_orderkey"], "id")
    state = F.when(F.col("o_orderstatus") == "F", "done").otherwise("open")
    return joins.reattach(numbered, {"state": state}).select("id", "o_orderkey", "state")


@query("jon_12_guarded_reconcile", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def guarded_reconcile(t: Tables) -> DataFrame:
    """Masked names come back from the raw rows; a raw key that occurs twice would fail the query."""
    raw = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return joins.reconcile(raw.withColumn("c_name", masks.redacted(F.col("c_name"))), raw, ["c_custkey"], ["c_name"])


@query(
    "jon_13_join_latest",
    """SELECT c_custkey, o_orderkey AS last_order, event_id AS last_event FROM customer
       LEFT JOIN (SELECT * FROM orders QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey
                  ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) ON o_custkey = c_custkey
       LEFT JOIN (SELECT * FROM events QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id
                  ORDER BY ts DESC, event_id DESC) = 1) ON user_id = c_custkey""",
)
def join_latest(t: Tables) -> DataFrame:
    orders = t.orders.select("o_custkey", "o_orderkey", F.col("o_orderdate").alias("expected_from"), F.col("o_orderkey").alias("file_id"))
    events = t.events.select("user_id", "event_id", F.col("ts").alias("expected_from"), F.col("event_id").alias("file_id"))
    sources = {
        "orders": (orders, {"c_custkey": "o_custkey"}, {"o_orderkey": "last_order"}),
        "events": (events, {"c_custkey": "user_id"}, {"event_id": "last_event"}),
    }
    return joins.join_latest(t.customer.select("c_custkey"), sources)


@query(
    "jon_14_two_roles",
    """SELECT l_orderkey, l_linenumber, cn.n_name AS customer_nation, sn.n_name AS supplier_nation FROM lineitem
       LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
       LEFT JOIN supplier ON l_suppkey = s_suppkey
       LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey""",
)
def two_roles(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey")
    keyed = joins.enrich_star(
        lines,
        [
            (t.orders, {"l_orderkey": "o_orderkey"}, {"o_custkey": "_customer"}),
            (t.customer, {"_customer": "c_custkey"}, {"c_nationkey": "_cn"}),
            (t.supplier, {"l_suppkey": "s_suppkey"}, {"s_nationkey": "_sn"}),
        ],
    )
    roles = {"_cn": {"n_name": "customer_nation"}, "_sn": {"n_name": "supplier_nation"}}
    out = joins.enrich_roles(keyed, t.nation, "n_nationkey", roles)
    return out.select("l_orderkey", "l_linenumber", "customer_nation", "supplier_nation")


@query(
    "jon_15_listed_mark",
    """SELECT doc_id, lang, doc_id IN (SELECT doc_id FROM labels) AS labelled FROM documents""",
)
def listed_mark(t: Tables) -> DataFrame:
    return joins.mark_listed(t.documents.select("doc_id", "lang"), t.labels, {"doc_id": "doc_id"}, "labelled")


@query(
    "jon_16_calendar",
    """SELECT day, o_orderkey, o_orderdate FROM (SELECT DISTINCT l_shipdate AS day FROM lineitem)
       FULL JOIN orders ON o_orderdate = day""",
)
def calendar(t: Tables) -> DataFrame:
    days = t.lineitem.select(F.col("l_shipdate").alias("day")).distinct()
    return joins.with_calendar(t.orders.select("o_orderkey", "o_orderdate"), days, "o_orderdate", "day")


@query(
    "jon_17_unmatched",
    "SELECT p_partkey, p_name FROM part LEFT JOIN lineitem ON l_partkey = p_partkey AND l_returnflag = 'R' AND l_quantity > 40 WHERE l_partkey IS NULL",
)
def unmatched(t: Tables) -> DataFrame:
    returned = t.lineitem.filter("l_returnflag = 'R' AND l_quantity > 40")
    return joins.without(t.part.select("p_partkey", "p_name"), returned, {"p_partkey": "l_partkey"})


# --- aggregations --------------------------------------------------------------------------------


def _shown(df: DataFrame, array: str, fields: list[str]) -> DataFrame:
    """Array of structs as text, so that the check compares plain values."""
    item = lambda x: F.concat_ws(":", *[x[f].cast("string") for f in fields])
    return df.withColumn(array, F.array_join(F.transform(array, item), ","))


@query(
    "agg_01_struct_array",
    """SELECT o_orderkey, COALESCE(lines, '') AS lines FROM orders LEFT JOIN (
         SELECT l_orderkey, string_agg(l_linenumber || ':' || l_partkey, ',' ORDER BY l_linenumber, l_partkey) AS lines
         FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey) ON l_orderkey = o_orderkey""",
)
def struct_array(t: Tables) -> DataFrame:
    returned = t.lineitem.filter("l_returnflag = 'R'")
    arrays = nested.collect_structs(returned, ["l_orderkey"], {"l_linenumber": "line", "l_partkey": "part"}, "lines")
    out = nested.attach_array(t.orders.select("o_orderkey"), arrays, {"o_orderkey": "l_orderkey"}, "lines")
    return _shown(out, "lines", ["line", "part"])


@query(
    "agg_01_chunked_array",
    """SELECT event_type, chunk, string_agg(event_id, ',' ORDER BY event_id) AS events, COUNT(*) AS n
       FROM (SELECT *, (ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // 100 AS chunk FROM events)
       GROUP BY event_type, chunk""",
)
def chunked_array(t: Tables) -> DataFrame:
    """Few keys with very many rows each: every array holds at most a hundred, and none is left out."""
    parts = chunk_groups(t.events.select("event_type", "event_id"), ["event_type"], ["event_id"], 100)
    arrays = nested.collect_structs(parts, ["event_type", "chunk"], {"event_id": "id"}, "events")
    return _shown(arrays.withColumn("n", F.size("events").cast("bigint")), "events", ["id"])


@query(
    "agg_02_sorted_distinct",
    """SELECT l_orderkey, string_agg(s, ',' ORDER BY s) AS suppliers
       FROM (SELECT DISTINCT l_orderkey, l_suppkey AS s FROM lineitem) GROUP BY l_orderkey""",
)
def sorted_distinct(t: Tables) -> DataFrame:
    out = nested.collect_sorted(t.lineitem, ["l_orderkey"], "l_suppkey", "suppliers")
    return out.withColumn("suppliers", F.array_join(F.transform("suppliers", lambda x: x.cast("string")), ","))


@query(
    "agg_03_collect_into",
    """SELECT l_orderkey, flag, string_agg(l_linenumber, ',' ORDER BY l_linenumber) AS lines
       FROM (SELECT l_orderkey, l_linenumber FROM lineitem)
       JOIN (SELECT DISTINCT l_orderkey, l_returnflag AS flag FROM lineitem) USING (l_orderkey) GROUP BY ALL""",
)
def collect_into(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", F.col("l_returnflag").alias("flag"), F.col("l_linenumber").alias("lines"))
    out = nested.collect_into(rows, ["l_orderkey"], "lines")
    return out.withColumn("lines", F.array_join(F.transform("lines", lambda x: x.cast("string")), ","))


@query(
    "agg_04_joined_text",
    """SELECT o_custkey, string_agg(p, ', ' ORDER BY p) AS priorities
       FROM (SELECT DISTINCT o_custkey, o_orderpriority AS p FROM orders) GROUP BY o_custkey""",
)
def joined_text(t: Tables) -> DataFrame:
    return nested.join_distinct(t.orders, ["o_custkey"], "o_orderpriority", "priorities")


@query(
    "agg_05_distinct_structs",
    """SELECT l_orderkey, string_agg(f || ':' || s, ',' ORDER BY f, s) AS states
       FROM (SELECT DISTINCT l_orderkey, l_returnflag AS f, l_linestatus AS s FROM lineitem) GROUP BY l_orderkey""",
)
def distinct_structs(t: Tables) -> DataFrame:
    fields = {"l_returnflag": "f", "l_linestatus": "s"}
    return _shown(nested.collect_distinct_structs(t.lineitem, ["l_orderkey"], fields, "states"), "states", ["f", "s"])


@query(
    "agg_06_lists_per_key",
    """SELECT l_orderkey, string_agg(l_partkey, ',' ORDER BY l_partkey) AS parts,
              string_agg(l_suppkey, ',' ORDER BY l_suppkey) AS suppliers FROM lineitem GROUP BY l_orderkey""",
)
def lists_per_key(t: Tables) -> DataFrame:
    out = nested.collect_over(t.lineitem, ["l_orderkey"], {"l_partkey": "parts", "l_suppkey": "suppliers"})
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return out.select("l_orderkey", text("parts").alias("parts"), text("suppliers").alias("suppliers"))


def _hot_events(t: Tables) -> DataFrame:
    """Events by type, a third of them under one key; some have none."""
    key = F.when(F.col("event_id") % 3 == 0, "hot").when(F.col("event_type") != "error", F.col("event_type"))
    return t.events.select(key.alias("key"), "event_id", "user_id", "event_type")


HOT_EVENTS_SQL = """SELECT *, (ROW_NUMBER() OVER (PARTITION BY key ORDER BY event_id) - 1) // 100 AS chunk FROM (
    SELECT CASE WHEN event_id % 3 = 0 THEN 'hot' WHEN event_type <> 'error' THEN event_type END AS key, event_id, user_id, event_type FROM events)"""


@query(
    "agg_06_lists_on_rows",
    f"""SELECT key, event_id, chunk, string_agg(event_id, ',' ORDER BY event_id) OVER w AS ids, string_agg(user_id, ',' ORDER BY user_id) OVER w AS users
        FROM ({HOT_EVENTS_SQL}) WINDOW w AS (PARTITION BY key, chunk)""",
)
def lists_on_rows(t: Tables) -> DataFrame:
    """All rows stay, each with the lists of its hundred."""
    out = nested.collect_over_rows(_hot_events(t), ["key"], ["event_id"], {"event_id": "ids", "user_id": "users"}, 100)
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    return out.select("key", "event_id", "chunk", text("ids"), text("users"))


@query("agg_07_first_seen", "SELECT user_id, MIN(ts) AS first_seen FROM events GROUP BY user_id")
def first_seen(t: Tables) -> DataFrame:
    return nested.first_seen(t.events, ["user_id"], "ts", "first_seen")


@query(
    "agg_08_collapse",
    """SELECT o_custkey, o_orderstatus, o_orderpriority, MIN(o_orderdate) AS o_orderdate FROM orders GROUP BY ALL""",
)
def collapse(t: Tables) -> DataFrame:
    return nested.collapse(t.orders.select("o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"), "o_orderdate")


@query(
    "agg_09_max_or_default",
    """SELECT COALESCE(MAX(o_orderdate), TIMESTAMP '1900-01-01') AS newest, COALESCE((SELECT MAX(o_orderkey) FROM orders
       WHERE o_orderstatus = 'X'), 0) AS top_id FROM orders""",
)
def max_or_default(t: Tables) -> DataFrame:
    newest = nested.max_or(t.orders, "o_orderdate", F.lit("1900-01-01").cast("timestamp_ntz"), "newest")
    none = nested.max_or(t.orders.filter("o_orderstatus = 'X'"), "o_orderkey", F.lit(0).cast("bigint"), "top_id")
    return newest.withColumn("top_id", none.scalar())


@query(
    "agg_10_action_counts",
    """SELECT COUNT(*) FILTER (event_type = 'click') AS click, COUNT(*) FILTER (event_type = 'error') AS error,
              COUNT(*) FILTER (event_type = 'none') AS none FROM events""",
)
def action_counts(t: Tables) -> DataFrame:
    return nested.action_counts(t.events, "event_type", ["click", "error", "none"])


@query(
    "agg_11_pivot",
    """SELECT o_custkey, NULLIF(COUNT(*) FILTER (year(o_orderdate) = 1996), 0) AS "1996",
              NULLIF(COUNT(*) FILTER (year(o_orderdate) = 1997), 0) AS "1997",
              NULLIF(COUNT(*) FILTER (year(o_orderdate) = 1998), 0) AS "1998" FROM orders GROUP BY o_custkey""",
)
def pivot(t: Tables) -> DataFrame:
    labelled = t.orders.select("o_custkey", F.year("o_orderdate").cast("string").alias("label"))
    return nested.pivot_counts(labelled, ["o_custkey"], "label", ["1996", "1997", "1998"])


@query(
    "agg_12_rows_json",
    """SELECT l_orderkey, '[' || string_agg('{"l_linenumber":' || l_linenumber || ',"l_returnflag":"' || l_returnflag || '"}',
              ',' ORDER BY l_linenumber, l_returnflag) || ']' AS lines FROM lineitem GROUP BY l_orderkey""",
)
def rows_json(t: Tables) -> DataFrame:
    return nested.rows_json(t.lineitem, ["l_orderkey"], ["l_linenumber", "l_returnflag"], "lines")


@query(
    "agg_12_rows_json_parts",
    f"""SELECT key, chunk + 1 AS part, CAST(ceil(n / 100) AS BIGINT) AS parts,
               '[' || string_agg('{{"event_id":' || event_id || ',"event_type":"' || event_type || '"}}', ',' ORDER BY event_id) || ']' AS events
        FROM (SELECT *, COUNT(*) OVER (PARTITION BY key) AS n FROM ({HOT_EVENTS_SQL})) GROUP BY key, chunk, n""",
)
def rows_json_parts(t: Tables) -> DataFrame:
    """A key with a third of all rows has as many texts of a hundred rows as it needs."""
    return nested.rows_json_parts(_hot_events(t), ["key"], ["event_id", "event_type"], "events", 100)


@query(
    "agg_03_collect_into_parts",
    f"""SELECT key, even, part, ids FROM (SELECT key, chunk + 1 AS part, string_agg(event_id, ',' ORDER BY event_id) AS ids FROM ({HOT_EVENTS_SQL}) GROUP BY ALL)
        JOIN (SELECT DISTINCT key, event_id % 2 = 0 AS even FROM ({HOT_EVENTS_SQL})) USING (key)""",
)
def collect_into_parts(t: Tables) -> DataFrame:
    rows = _hot_events(t).select("key", (F.col("event_id") % 2 == 0).alias("even"), F.col("event_id").alias("ids"))
    out = nested.collect_into_parts(rows, ["key"], "ids", 100)
    return out.withColumn("ids", F.array_join(F.transform("ids", lambda x: x.cast("string")), ","))


@query(
    "agg_13_fold",
    """SELECT conv_id, string_agg(turn || ':' || role, ',' ORDER BY turn, role) AS turns
       FROM (SELECT DISTINCT conv_id, turn, role FROM conversations) GROUP BY conv_id""",
)
def fold(t: Tables) -> DataFrame:
    return _shown(nested.fold(t.conversations, ["conv_id"], ["turn", "role"], "turns"), "turns", ["turn", "role"])


@query(
    "agg_14_changed_rows",
    "SELECT COUNT(*) FILTER (text <> regexp_replace(text, '[ .]+$', '')) AS changed FROM documents",
)
def changed_rows(t: Tables) -> DataFrame:
    from stratalake.functions.text import strip_trailing

    both = t.documents.select("text", strip_trailing("text").alias("after"))
    return nested.changed_rows({"text": "after"}, both, "changed")


@query(
    "srt_01_ordered_top",
    "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10",
)
def ordered_top(t: Tables) -> DataFrame:
    """Top ten report: each task keeps ten rows before they meet."""
    return t.customer.select("c_custkey", "c_name", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey").limit(10)
