"""Queries for projection, cleaning and conformance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions import temporal, text
from stratalake.operators import conform, nested
from stratalake.operators.ordered import along
from stratalake.plans.registry import Tables, query


@query(
    "prj_01_lineage",
    """SELECT event_id, TIMESTAMP '2024-03-01 06:30:00' AS ingested_datetime, 'load' AS ingested_by_process_name,
              TIMESTAMP '2024-02-29 00:00:00' AS expected_from, TIMESTAMP '2024-03-03 00:00:00' AS expected_to,
              event_type || '.json' AS input_file, TIMESTAMP '2024-03-01 06:30:00' AS modified_datetime,
              'load' AS modified_by_process_name, 'events' AS entity_name,
              sha256(event_type || '.json' || '2024-03-01 06:30:00') AS "file_ID" FROM events""",
)
def lineage(t: Tables) -> DataFrame:
    at = lambda s: F.lit(s).cast("timestamp_ntz")
    return conform.add_lineage(
        t.events.select("event_id", "event_type"),
        now=at("2024-03-01 06:30:00"),
        process="load",
        entity="events",
        file=F.concat("event_type", F.lit(".json")),
        expected_from=at("2024-02-29 00:00:00"),
        expected_to=at("2024-03-03 00:00:00"),
    ).drop("event_type")


@query(
    "prj_02_snake_headers",
    """SELECT p_partkey AS part_key, p_name AS name_full_1, p_brand AS brand1, p_type AS brand2, p_size AS size_cm FROM part""",
)
def snake_headers(t: Tables) -> DataFrame:
    cols = t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return conform.clean_headers(cols.toDF("Part Key.", "Name (full) #1", "Brand", "BRAND", "size--cm)"))


@query("prj_03_light_headers", 'SELECT s_suppkey AS "Supp_key", s_name AS "Name_full", s_acctbal AS "Bal-ance" FROM supplier')
def light_headers(t: Tables) -> DataFrame:
    cols = t.supplier.select("s_suppkey", "s_name", "s_acctbal")
    return conform.light_headers(cols.toDF("Supp.#key", "Name (full)", "Bal-ance"))


@query("prj_04_numbered_headers", "SELECT n_nationkey AS key1, n_name AS name, n_regionkey AS key2 FROM nation")
def numbered_headers(t: Tables) -> DataFrame:
    return conform.number_repeated_headers(t.nation.select("n_nationkey", "n_name", "n_regionkey").toDF("key", "name", "key"))


@query("prj_05_first_of_repeated", 'SELECT c_custkey AS "Id", c_name AS name FROM customer')
def first_of_repeated(t: Tables) -> DataFrame:
    return conform.first_of_repeated(t.customer.select("c_custkey", "c_name", "c_nationkey").toDF("Id", "name", "ID"))


@query("prj_06_drop_junk", "SELECT p_partkey, p_name FROM part")
def drop_junk(t: Tables) -> DataFrame:
    noisy = t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    return conform.drop_junk(noisy.toDF("p_partkey", "p_name", "Unnamed: 3", "@odata.etag", "_c4", " "), blank=True)


@query(
    "prj_07_camel_headers",
    """SELECT o_orderkey AS "rule6Party", o_custkey AS s78, o_orderstatus AS "appealReference" FROM orders""",
)
def camel_headers(t: Tables) -> DataFrame:
    cols = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    return conform.camel_headers(cols.toDF("  Rule   6   Party  ", "S78", "Appeal Reference"))


LINES_PER_ORDER_SQL = """
  SELECT l_orderkey, '[' || string_agg(l_linenumber, ',' ORDER BY l_linenumber) || ']' AS lines
  FROM lineitem GROUP BY l_orderkey
"""


@query("prj_08_arrays_as_text", LINES_PER_ORDER_SQL)
def arrays_as_text(t: Tables) -> DataFrame:
    arrays = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_linenumber")).alias("lines"))
    return conform.cast_to_schema(arrays, conform.relax_arrays(arrays.schema))


@query(
    "prj_09_cast_to_schema",
    """SELECT o_orderkey AS "O_OrderKey", o_totalprice, o_orderdate,
              TRY_CAST(substr(o_orderpriority, 1, 2) AS INTEGER) IS NULL AS unreadable FROM orders""",
)
def cast_to_schema(t: Tables) -> DataFrame:
    raw = conform.all_text(t.orders.select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority"))
    declared = T.StructType.fromDDL(
        "o_orderkey bigint, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority int"
    )
    typed = conform.cast_to_schema(raw.withColumnRenamed("o_orderkey", "O_OrderKey"), declared)
    return typed.withColumn("unreadable", F.col("o_orderpriority").isNull()).drop("o_orderpriority")


@query(
    "prj_10_align_types",
    "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_acctbal AS DECIMAL(12, 2))::VARCHAR AS c_acctbal FROM customer",
)
def align_types(t: Tables) -> DataFrame:
    target = T.StructType.fromDDL("c_custkey string, c_acctbal decimal(12,2), only_in_target string")
    aligned = conform.align_types(t.customer.select("c_custkey", "c_name", "c_acctbal"), target)
    return aligned.withColumn("c_acctbal", F.col("c_acctbal").cast("string"))


@query("prj_11_padded_projection", "SELECT s_name, CAST(NULL AS VARCHAR) AS s_phone, s_suppkey FROM supplier")
def padded_projection(t: Tables) -> DataFrame:
    return conform.project_padded(t.supplier, ["s_name", "s_phone", "s_suppkey"])


@query(
    "prj_12_declared_first",
    "SELECT n_name, CAST(NULL AS VARCHAR) AS n_code, n_nationkey, n_regionkey FROM nation",
)
def declared_first(t: Tables) -> DataFrame:
    return conform.declared_first(t.nation, ["n_name", "n_code"])


@query(
    "prj_13_trim_text",
    "SELECT c_custkey, lower(trim(c_name)) AS c_name, c_mktsegment FROM customer",
)
def trim_text(t: Tables) -> DataFrame:
    padded = t.customer.select(
        "c_custkey",
        F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name"),
        F.concat("c_mktsegment", F.lit("   ")).alias("c_mktsegment"),
    )
    return conform.trim_text(padded, lower=["c_name"])


@query(
    "prj_14_defaults",
    """SELECT o_orderkey, o_orderstatus, 'N' AS "IsActive", 'Orders' AS source FROM orders""",
)
def defaults(t: Tables) -> DataFrame:
    flagged = t.orders.select("o_orderkey", "o_orderstatus", F.lit("N").alias("IsActive"))
    return conform.with_defaults(flagged, {"IsActive": F.lit("Y"), "source": F.lit("Orders")})


def _spoilt_names(t: Tables) -> DataFrame:
    name = (
        F.when(F.col("c_mktsegment") == "BUILDING", '"')
        .when(F.col("c_mktsegment") == "MACHINERY", "   ")
        .when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_name"))
    )
    return t.customer.select("c_custkey", name.alias("name"))


SPOILT_SQL = """
  SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN '"' WHEN c_mktsegment = 'MACHINERY' THEN '   '
                         WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_name END AS name FROM customer
"""


@query("prj_15_usable_keys", f"SELECT * FROM ({SPOILT_SQL}) WHERE trim(name) NOT IN ('', '\"', '''')")
def usable_keys(t: Tables) -> DataFrame:
    return conform.drop_bad_keys(_spoilt_names(t), "name")


def _orders_with_lines(t: Tables) -> DataFrame:
    item = F.struct("l_linenumber", "l_partkey", "l_quantity", "l_returnflag")
    lines = t.lineitem.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(item)).alias("lines"))
    return t.orders.select("o_orderkey", "o_custkey").join(lines, F.col("o_orderkey") == F.col("l_orderkey")).drop("l_orderkey")


@query(
    "prj_16_explode_flatten",
    """SELECT o_orderkey, o_custkey, l_linenumber AS line, l_partkey AS part, l_quantity AS quantity
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
)
def explode_flatten(t: Tables) -> DataFrame:
    fields = {"l_linenumber": "line", "l_partkey": "part", "l_quantity": "quantity"}
    return nested.explode_flatten(_orders_with_lines(t), "lines", fields)


@query(
    "prj_17_explode_entities",
    """SELECT l_linenumber AS "line-number", l_partkey AS "part-key" FROM lineitem WHERE l_returnflag = 'R'""",
)
def explode_entities(t: Tables) -> DataFrame:
    """Orders without returned lines hold an empty array and give no row."""
    kept = F.filter("lines", lambda x: x["l_returnflag"] == "R")
    entity = F.transform(
        kept, lambda x: F.struct(x["l_linenumber"].alias("line-number"), x["l_partkey"].alias("part-key"))
    )
    return nested.explode_entities(_orders_with_lines(t).select(entity.alias("entities")), "entities")


@query(
    "prj_18_quoted_json",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def quoted_json(t: Tables) -> DataFrame:
    single = F.concat(F.lit("["), F.regexp_replace("props", '"', "'"), F.lit("]"))
    parsed = t.events.select("event_id", text.quoted_json(single, "array<struct<k: bigint>>").alias("items"))
    return nested.explode_flatten(parsed, "items", ["k"])


@query("prj_19_blank_to_null", f"SELECT c_custkey, CASE WHEN trim(name) <> '' THEN name END AS name FROM ({SPOILT_SQL})")
def blank_to_null(t: Tables) -> DataFrame:
    return _spoilt_names(t).withColumn("name", text.blank_to_null("name"))


@query(
    "prj_20_or_default",
    f"""SELECT c_custkey, COALESCE(name, '') AS name_or_blank,
               COALESCE(NULLIF(trim(name), ''), 'UNKNOWN') AS name_or_unknown FROM ({SPOILT_SQL})""",
)
def or_default(t: Tables) -> DataFrame:
    return _spoilt_names(t).select(
        "c_custkey",
        F.coalesce("name", F.lit("")).alias("name_or_blank"),
        text.or_default("name", "UNKNOWN").alias("name_or_unknown"),
    )


@query(
    "prj_21_code_map",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'appeals' WHEN '2-HIGH' THEN 'major projects'
              WHEN '5-LOW' THEN 'archive' ELSE o_orderpriority END AS stage FROM orders""",
)
def code_map(t: Tables) -> DataFrame:
    codes = {"1-URGENT": "appeals", "2-HIGH": "major projects", "5-LOW": "archive"}
    return t.orders.select("o_orderkey", text.map_codes("o_orderpriority", codes).alias("stage"))


@query(
    "prj_22_group_map",
    """SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'industry'
              WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE lower(c_mktsegment) END AS segment FROM customer""",
)
def group_map(t: Tables) -> DataFrame:
    groups = [(["BUILDING", "MACHINERY"], "industry"), (["HOUSEHOLD"], None)]
    return t.customer.select("c_custkey", text.map_groups("c_mktsegment", groups).alias("segment"))


@query(
    "prj_23_slug",
    """SELECT o_orderkey, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'none'
              ELSE regexp_replace(lower(o_orderpriority), '[- ]', '_', 'g') END AS slug FROM orders""",
)
def slug(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", text.slug("o_orderpriority", {"4-NOT SPECIFIED": "none"}).alias("slug"))


@query(
    "prj_24_stage_map",
    """SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'Pre-application' WHEN 'STANDARD' THEN 'Acceptance'
              ELSE lower(p_type) END AS stage FROM part""",
)
def stage_map(t: Tables) -> DataFrame:
    stages = {"ECONOMY": "Pre-application", "STANDARD": "Acceptance"}
    return t.part.select("p_partkey", text.map_codes("p_type", stages, F.lower("p_type")).alias("stage"))


@query(
    "prj_25_first_present",
    f"""SELECT c_custkey, CASE COALESCE(name, 'Hearing') WHEN '"' THEN 'WR' WHEN 'Hearing' THEN 'IH'
               ELSE COALESCE(name, 'Hearing') END AS procedure FROM ({SPOILT_SQL})""",
)
def first_present(t: Tables) -> DataFrame:
    """A blank first value blocks the second one; only null lets it through."""
    chosen = _spoilt_names(t).withColumn("fallback", F.lit("Hearing"))
    chosen = chosen.withColumn("procedure", text.first_present(["name", "fallback"]))
    return chosen.select("c_custkey", text.map_codes("procedure", {'"': "WR", "Hearing": "IH"}).alias("procedure"))


@query(
    "prj_26_role_map",
    """SELECT event_id, 'Buyer' AS role FROM events WHERE event_type IN ('purchase', 'click', 'view')""",
)
def role_map(t: Tables) -> DataFrame:
    role = text.map_groups("event_type", [(["purchase", "click", "view"], "Buyer")], F.lit(None).cast("string"))
    return t.events.select("event_id", role.alias("role")).filter("role IS NOT NULL")


@query(
    "prj_27_contact_map",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'post' WHEN 'MACHINERY' THEN 'email'
              ELSE lower(c_mktsegment) END AS contact FROM customer""",
)
def contact_map(t: Tables) -> DataFrame:
    contact = text.map_groups("c_mktsegment", [(["BUILDING"], "post"), (["MACHINERY"], "email")])
    return t.customer.select("c_custkey", contact.alias("contact"))


@query(
    "prj_28_strip_and_boolean",
    """SELECT doc_id, regexp_replace(text, '[ .]+$', '') AS text, quality = 1 AS good
       FROM documents JOIN labels USING (doc_id)""",
)
def strip_and_boolean(t: Tables) -> DataFrame:
    rows = t.documents.join(t.labels, "doc_id")
    return rows.select(
        "doc_id",
        text.strip_trailing("text").alias("text"),
        text.to_boolean(F.col("quality").cast("string")).alias("good"),
    )


@query(
    "prj_29_local_time",
    """SELECT event_id, CAST(timezone('Europe/London', timezone('UTC', ts)) AS TIMESTAMP) AS local_time FROM events""",
)
def local_time(t: Tables) -> DataFrame:
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    return t.events.select("event_id", temporal.utc_to_local(iso).cast("timestamp_ntz").alias("local_time"))


@query(
    "prj_30_not_before",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1996-06-01' OR o_orderdate IS NULL",
)
def not_before(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_orderdate").filter(temporal.not_before("o_orderdate", "1996-06-01"))


@query("prj_31_minute_text", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M') AS minute FROM events")
def minute_text(t: Tables) -> DataFrame:
    return t.events.select("event_id", temporal.minute_text(F.col("ts").cast("string")).alias("minute"))


@query(
    "prj_32_iso_suffix",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00.000Z' AS iso_day,
              strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') || '+0000' AS iso_micros FROM orders""",
)
def iso_suffix(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        temporal.iso_midnight(F.col("o_orderdate").cast("date")).alias("iso_day"),
        temporal.iso_micros("o_orderdate").alias("iso_micros"),
    )


@query(
    "prj_33_short_prefix",
    """SELECT c_custkey, CASE WHEN length(c_custkey::VARCHAR) < 3 THEN '00' || c_custkey ELSE c_custkey::VARCHAR END AS staff_id
       FROM customer""",
)
def short_prefix(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", text.prefix_short(F.col("c_custkey").cast("string"), 3).alias("staff_id"))


@query(
    "prj_34_joined_parts",
    f"""SELECT c_custkey, c_nationkey || '-' || c_custkey AS reference, name || '-' || c_custkey AS strict_reference,
               CASE WHEN trim(name) <> '' THEN trim(name) || ' ' ELSE '' END || c_mktsegment AS address
        FROM ({SPOILT_SQL}) JOIN customer USING (c_custkey)""",
)
def joined_parts(t: Tables) -> DataFrame:
    rows = _spoilt_names(t).join(t.customer, "c_custkey")
    return rows.select(
        "c_custkey",
        text.reference_of("c_nationkey", "c_custkey").alias("reference"),
        text.reference_of("name", "c_custkey").alias("strict_reference"),
        text.joined(["name", "c_mktsegment"]).alias("address"),
    )


@query("prj_35_presence", f"SELECT c_custkey, name IS NOT NULL AS has_name FROM ({SPOILT_SQL})")
def presence(t: Tables) -> DataFrame:
    return _spoilt_names(t).select("c_custkey", F.col("name").isNotNull().alias("has_name"))


@query(
    "prj_36_tri_state",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'true' WHEN o_orderstatus = 'O' THEN 'false' END AS published
       FROM orders""",
)
def tri_state(t: Tables) -> DataFrame:
    flag = text.tri_state("o_orderstatus", ["F"], ["O"])
    return t.orders.select("o_orderkey", flag.cast("string").alias("published"))


@query(
    "prj_37_padded_sources",
    """SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, '1' AS migrated, 'a' AS source FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL, '0', 'b' FROM supplier""",
)
def padded_sources(t: Tables) -> DataFrame:
    a = t.customer.select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    b = t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    a = conform.pad_sources(a, {"migrated": "1", "source": "a"}, {})
    b = conform.pad_sources(b, {"migrated": "0", "source": "b"}, {"segment": "string"})
    return a.unionByName(b)


ORDER_VERSIONS_SQL = """
  SELECT *, CASE WHEN ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
                 THEN 'Y' ELSE 'N' END AS "IsActive" FROM orders
"""


def order_versions(t: Tables) -> DataFrame:
    """Orders as versions of their customer: the newest one is active."""
    ahead = along(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], following={"_later": "o_orderkey"})
    return ahead.withColumn("IsActive", F.when(F.col("_later").isNull(), "Y").otherwise("N")).drop("_later")


@query(
    "prj_38_active_only",
    f"""SELECT DISTINCT o_custkey, o_orderstatus FROM ({ORDER_VERSIONS_SQL}) WHERE "IsActive" = 'Y'""",
)
def active_only(t: Tables) -> DataFrame:
    return conform.active_only(order_versions(t), ["o_custkey", "o_orderstatus"], distinct=True)


@query(
    "prj_39_either_filter",
    "SELECT event_id, event_type, user_id FROM events WHERE event_type = 'purchase' OR props = '{\"k\": 1}'",
)
def either_filter(t: Tables) -> DataFrame:
    keep = (F.col("event_type") == "purchase") | (F.col("props") == '{"k": 1}')
    return t.events.select("event_id", "event_type", "user_id", "props").filter(keep).drop("props")


@query(
    "prj_40_keyword_search",
    """SELECT doc_id, lang, source FROM documents
       WHERE contains(upper(text), 'THE') OR contains(upper(lang), 'THE') OR contains(upper(source), 'THE')""",
)
def keyword_search(t: Tables) -> DataFrame:
    return conform.search(t.documents, ["text", "lang", "source"], "the").select("doc_id", "lang", "source")


@query("prj_41_html_entity", "SELECT page_id, replace(html, '&#039;', '''') AS html FROM pages")
def html_entity(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.unescape_apostrophe("html").alias("html"))


@query(
    "prj_42_surrogate_code",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2 WHEN 'HOUSEHOLD' THEN 3
              ELSE 0 END AS segment_code FROM customer""",
)
def surrogate_code(t: Tables) -> DataFrame:
    codes = {"BUILDING": 1, "MACHINERY": 2, "HOUSEHOLD": 3}
    return t.customer.select("c_custkey", text.map_codes("c_mktsegment", codes, F.lit(0)).alias("segment_code"))


@query(
    "prj_43_all_text_numbered",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_mktsegment, 'crm' AS origin,
              ROW_NUMBER() OVER (PARTITION BY c_mktsegment ORDER BY CAST(c_custkey AS VARCHAR)) AS row_no FROM customer""",
)
def all_text_numbered(t: Tables) -> DataFrame:
    plain = conform.all_text(t.customer.select("c_custkey", "c_mktsegment"), {"origin": "crm"})
    return along(plain, ["c_mktsegment"], ["c_custkey"], rank="row_no")
