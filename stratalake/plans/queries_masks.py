"""Queries for masking, data checks and the run log. Seeded masks use md5 so that SQL can recompute them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions import masks
from stratalake.operators import masking, nested, quality, sets
from stratalake.plans.murmur import hash_sql, magnitude_sql
from stratalake.plans.registry import Tables, query


def _draw(seed: str, n: int, salt: str = "") -> str:
    """SQL for the number a seeded mask draws."""
    text = f"({seed}) || '{salt}'" if salt else seed
    return f"(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) % {n})"


def _people(t: Tables) -> DataFrame:
    """Customers with the personal columns the masks are for; households keep some of them to themselves."""
    shy = F.col("c_mktsegment") == "HOUSEHOLD"
    return t.customer.select(
        F.col("c_custkey").cast("string").alias("PersNo"),
        F.when(~shy, F.col("c_name")).alias("firstName"),
        F.concat("c_name", F.lit("@Example.com")).alias("email"),
        F.when(~shy, F.lit("AB123456C")).alias("ni_number"),
        F.when(~shy, F.lit("1980-01-01").cast("date")).alias("birth_date"),
        F.when(~shy, F.lit(44)).alias("age"),
        F.when(~shy, F.lit(30_000)).alias("salary"),
        F.when(
            ~shy,
            F.struct(
                F.col("c_name").alias("line1"),
                F.lit(None).cast("string").alias("line2"),
                F.concat(F.lit(" BS"), "c_nationkey", F.lit("  6PN")).alias("postcode"),
            ),
        ).alias("Postal_Adress"),
    )


PEOPLE_SQL = """
  SELECT CAST(c_custkey AS VARCHAR) AS "PersNo", c_mktsegment <> 'HOUSEHOLD' AS filled, c_name || '@Example.com' AS email,
         c_name, c_nationkey FROM customer
"""
# An example classification list as a catalogue would give it.
CLASSIFIED = (
    {"column_name": "first_name", "classifications": ["First Name"]},
    {"column_name": "value[].email", "classifications": ["MICROSOFT.PERSONAL.EMAIL"]},
    {"column_name": "NI Number", "classifications": ["NI Number"]},
    {"column_name": "BirthDate", "classifications": ["Date of Birth"]},
    {"column_name": "Age", "classifications": ["Person's Age"]},
    {"column_name": "salary", "classifications": ["Annual Salary"]},
    {"column_name": "Postal Address", "classifications": ["All Physical Addresses"]},
    {"column_name": "shoe size", "classifications": ["First Name"]},
)
POLICY = masking.MaskingPolicy(seed_column="PersNo", flavour="md5")


@query(
    "ano_01_seed",
    """SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS explicit, COALESCE(segment, CAST(c_custkey AS VARCHAR)) AS known,
              sha256(c_custkey || '|' || COALESCE(segment, '<NULL>')) AS whole_row
       FROM (SELECT c_custkey, NULLIF(c_mktsegment, 'HOUSEHOLD') AS segment FROM customer)""",
)
def seed(t: Tables) -> DataFrame:
    segment = F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment"))
    rows = t.customer.select("c_custkey", segment.alias("segment"))
    staff = rows.select(F.col("segment").alias("Staff Number"), F.col("c_custkey").alias("PersNo"))
    known = staff.select(F.col("PersNo").alias("k"), masks.seed_for(staff.columns).alias("known"))
    own = rows.select(
        "c_custkey",
        masks.seed_for(rows.columns, "c_custkey").alias("explicit"),
        masks.seed_for(rows.columns).alias("whole_row"),
    )
    return own.join(known, F.col("c_custkey") == F.col("k")).drop("k")


@query(
    "ano_02_fake_number",
    f"""SELECT "PersNo", CASE WHEN filled THEN
            substr('{masks.NUMBER_LETTERS}', {_draw('"PersNo"', 24, '_ni1')} + 1, 1)
            || substr('{masks.NUMBER_LETTERS}', {_draw('"PersNo"', 24, '_ni2')} + 1, 1)
            || lpad({_draw('"PersNo"', 1000000, '_nid')}::VARCHAR, 6, '0')
            || substr('{masks.NUMBER_FINALS}', {_draw('"PersNo"', 4, '_nil')} + 1, 1) END AS ni_number FROM ({PEOPLE_SQL})""".replace(
        "+ 1, 1)", "+ 1)::INTEGER, 1)"
    ).replace("', (CAST", "', ((CAST"),
)
def fake_number(t: Tables) -> DataFrame:
    masked = masking.mask_columns(_people(t), {"ni_number": "number"}, "PersNo", "md5")
    return masked.select("PersNo", "ni_number")


def _hashed_people() -> str:
    """People with the Murmur hash of their number and each salt."""
    rows = PEOPLE_SQL
    for salt in masks.NUMBER_SALTS:
        rows = hash_sql(rows, f"\"PersNo\" || '{salt}'", f"hash{salt}")
    return rows


def _picked(letters: str, salt: str) -> str:
    return f"substr('{letters}', ({magnitude_sql(f'hash{salt}')} % {len(letters)})::INTEGER + 1, 1)"


@query(
    "ano_02_fake_number_murmur",
    f"""SELECT "PersNo", CASE WHEN filled THEN
            {_picked(masks.NUMBER_LETTERS, "_ni1")} || {_picked(masks.NUMBER_LETTERS, "_ni2")}
            || lpad(({magnitude_sql("hash_nid")} % 1000000)::VARCHAR, 6, '0') || {_picked(masks.NUMBER_FINALS, "_nil")} END AS ni_number
        FROM ({_hashed_people()})""",
)
def fake_number_murmur(t: Tables) -> DataFrame:
    """The same with the hash existing masked data was made with."""
    return masking.mask_columns(_people(t), {"ni_number": "number"}, "PersNo").select("PersNo", "ni_number")


@query("ano_03_hashed_email", f'SELECT "PersNo", sha256(lower(email)) AS email FROM ({PEOPLE_SQL})')
def hashed_email(t: Tables) -> DataFrame:
    return masking.mask_columns(_people(t), {"email": "email"}).select("PersNo", "email")


@query("ano_04_redacted_name", f"""SELECT "PersNo", CASE WHEN filled THEN 'REDACTED' END AS "firstName" FROM ({PEOPLE_SQL})""")
def redacted_name(t: Tables) -> DataFrame:
    return masking.mask_columns(_people(t), {"firstName": "name"}).select("PersNo", "firstName")


@query(
    "ano_05_fake_birth_date",
    f"""SELECT "PersNo", CASE WHEN filled THEN DATE '1955-01-01' + {_draw('"PersNo"', 18627)}::INTEGER END AS birth_date
        FROM ({PEOPLE_SQL})""",
)
def fake_birth_date(t: Tables) -> DataFrame:
    return masking.mask_columns(_people(t), {"birth_date": "birth_date"}, "PersNo", "md5").select("PersNo", "birth_date")


@query(
    "ano_06_fake_numbers",
    f"""SELECT "PersNo", CASE WHEN filled THEN {_draw('"PersNo"', 53)} + 18 END AS age,
               CASE WHEN filled THEN {_draw('"PersNo"', 80001)} + 20000 END AS salary FROM ({PEOPLE_SQL})""",
)
def fake_numbers(t: Tables) -> DataFrame:
    return masking.mask_columns(_people(t), {"age": "age", "salary": "salary"}, "PersNo", "md5").select("PersNo", "age", "salary")


ADDRESS_SQL = """CASE WHEN filled THEN 'REDACTED' END AS line1, CASE WHEN filled THEN 'REDACTED' END AS line2,
                 CASE WHEN filled THEN 'BS' || c_nationkey END AS postcode"""


@query("ano_07_address", f'SELECT "PersNo", {ADDRESS_SQL} FROM ({PEOPLE_SQL})')
def address(t: Tables) -> DataFrame:
    masked = masking.mask_columns(_people(t), {"Postal_Adress": "address"})
    return masked.select("PersNo", "Postal_Adress.*")


@query(
    "ano_08_keep_ends",
    """SELECT c_custkey, left(c_name, 1) || repeat('*', length(c_name) - 2) || right(c_name, 1) AS c_name FROM customer""",
)
def keep_ends(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", masks.keep_ends(F.col("c_name")).alias("c_name"))


MASKED_SQL = f"""
  SELECT "PersNo", CASE WHEN filled THEN 'REDACTED' END AS "firstName", sha256(lower(email)) AS email,
         CASE WHEN filled THEN {_draw('"PersNo"', 53)} + 18 END AS age,
         CASE WHEN filled THEN {_draw('"PersNo"', 80001)} + 20000 END AS salary, {ADDRESS_SQL} FROM ({PEOPLE_SQL})
"""


def _flat(df: DataFrame) -> DataFrame:
    return df.select("PersNo", "firstName", "email", "age", "salary", "Postal_Adress.*")


@query("ano_09_matched_names", MASKED_SQL)
def matched_names(t: Tables) -> DataFrame:
    """Names are matched whatever their style: a misspelt column and a path still find theirs."""
    return _flat(masking.mask_classified(_people(t), CLASSIFIED, POLICY))


@query(
    "ano_10_allowed_only",
    f"""SELECT "PersNo", CASE WHEN filled THEN 'REDACTED' END AS "firstName", email, CASE WHEN filled THEN 44 END AS age
        FROM ({PEOPLE_SQL})""",
)
def allowed_only(t: Tables) -> DataFrame:
    policy = masking.MaskingPolicy(allowlist=frozenset({"First Name"}), seed_column="PersNo")
    return masking.mask_classified(_people(t), CLASSIFIED, policy).select("PersNo", "firstName", "email", "age")


@query(
    "ano_11_summary",
    """SELECT 'Postal_Adress, age, birth_date, email, firstName, ni_number, salary' AS masked,
              'shoe size: not_in_dataframe' AS skipped, COUNT(*) AS changed_rows FROM customer""",
)
def summary(t: Tables) -> DataFrame:
    return masking.masking_summary(_people(t), CLASSIFIED, POLICY)


@query(
    "ano_12_policy",
    f"""SELECT "PersNo", CASE WHEN filled THEN {_draw("CASE WHEN filled THEN c_name END", 53)} + 18 END AS age FROM ({PEOPLE_SQL})""",
)
def policy(t: Tables) -> DataFrame:
    """A policy document may name another seed for one entity."""
    raw = {
        "classification_allowlist": ["Person's Age"],
        "seed_column": "PersNo",
        "entity_seed_columns": {"people": "firstName"},
    }
    from dataclasses import replace

    chosen = replace(masking.MaskingPolicy.from_mapping(raw), flavour="md5")
    return masking.mask_classified(_people(t), CLASSIFIED, chosen, "people").select("PersNo", "age")


@query(
    "ano_13_environments",
    f"""SELECT e AS environment, COUNT(*) FILTER (e IN ('dev', 'Test', 'build') AND filled) AS redacted
        FROM ({PEOPLE_SQL}), (VALUES ('dev'), ('Test'), ('build'), ('PROD'), ('elsewhere')) v(e) GROUP BY e""",
)
def environments(t: Tables) -> DataFrame:
    out = None
    for env in ("dev", "Test", "build", "PROD", "elsewhere"):
        masked = masking.mask_for_environment(_people(t), CLASSIFIED, env, POLICY)
        one = masked.agg(F.count_if(F.col("firstName") == masks.REDACTED).alias("redacted"))
        one = one.select(F.lit(env).alias("environment"), "redacted")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "ano_14_remask",
    f"""SELECT "PersNo", sha256(lower(email)) AS email, CASE WHEN filled THEN 'REDACTED' END AS "firstName" FROM ({PEOPLE_SQL})""",
)
def remask(t: Tables) -> DataFrame:
    """Old masks in place are replaced by today's, made from the raw values."""
    raw = _people(t).select("PersNo", "email", "firstName")
    old = raw.withColumns({c: masks.keep_ends(F.col(c)) for c in ("email", "firstName")})
    return masking.remask(old, raw, ["PersNo"], {"email": "email", "firstName": "name"})


@query("ano_15_remask_nested", f'SELECT "PersNo", sha256(lower(email)) AS email FROM ({PEOPLE_SQL})')
def remask_nested(t: Tables) -> DataFrame:
    """The raw side holds its records in arrays of at most a hundred."""
    raw = _people(t).select("PersNo", "email")
    page = F.floor(F.col("PersNo").cast("bigint") / 100)
    docs = raw.groupBy(page.alias("page")).agg(F.collect_list(F.struct("PersNo", "email")).alias("value"))
    flat = nested.explode_entities(docs, "value")
    old = _people(t).select("PersNo", masks.keep_ends(F.col("email")).alias("email"))
    return masking.remask(old, flat, ["PersNo"], {"email": "email"})


@query(
    "ano_16_old_masks",
    f"""SELECT "PersNo" FROM ({PEOPLE_SQL}) WHERE filled""",
)
def old_masks(t: Tables) -> DataFrame:
    rows = _people(t).select("PersNo", masks.keep_ends(F.col("firstName")).alias("firstName"), "email")
    return masking.masked_in_place(rows).select("PersNo")


# --- run log and checks --------------------------------------------------------------------------


def _run_log(t: Tables) -> DataFrame:
    """Every event as a started run of its type."""
    return t.events.select(
        F.col("event_id").cast("string").alias("run_id"),
        F.col("event_type").alias("entity_name"),
        F.lit("standardise").alias("stage_name"),
        F.col("props").alias("execution_parameters"),
        F.col("ts").cast("timestamp").alias("execution_start_time"),
        F.lit(None).cast("timestamp").alias("execution_finish_time"),
        F.lit(None).cast("boolean").alias("successful"),
        F.lit(None).cast("string").alias("result_text"),
    )


RUN_LOG_SQL = """
  SELECT CAST(event_id AS VARCHAR) AS run_id, event_type AS entity_name, 'standardise' AS stage_name, props AS execution_parameters,
         ts AS execution_start_time, CASE WHEN event_type <> 'signup' THEN ts + INTERVAL 5 MINUTE END AS execution_finish_time,
         CASE WHEN event_type <> 'signup' THEN event_type || ' done' END AS result_text FROM events
"""


@query("ops_01_run_log", RUN_LOG_SQL)
def run_log(t: Tables) -> DataFrame:
    """Clicks are in the log already and get their result; the other runs are created, then finished but for signups."""
    started = _run_log(t)
    done = {
        "execution_finish_time": F.col("execution_start_time") + F.expr("INTERVAL 5 MINUTE"),
        "successful": F.lit(True),
        "result_text": F.concat("entity_name", F.lit(" done")),
    }
    fresh = started.filter("entity_name <> 'click'").withColumn("row_action", F.lit("create"))
    log = quality.log_runs(started.filter("entity_name = 'click'"), fresh)
    finished = started.filter("entity_name <> 'signup'").withColumns({**done, "execution_parameters": F.lit("ignored")})
    log = quality.log_runs(log, finished.withColumn("row_action", F.lit("update")))
    naive = {c: F.col(c).cast("timestamp_ntz") for c in ("execution_start_time", "execution_finish_time")}
    return log.withColumns(naive).drop("successful")


@query(
    "ops_02_runs_of",
    f"""SELECT run_id, entity_name, execution_start_time FROM ({RUN_LOG_SQL}) WHERE entity_name = 'click'""",
)
def runs_of(t: Tables) -> DataFrame:
    picked = quality.runs_of(_run_log(t), entity="click", stage="standardise")
    return quality.latest_runs(picked).select(
        "run_id", "entity_name", F.col("execution_start_time").cast("timestamp_ntz")
    )


@query(
    "ops_03_stage_counts",
    """SELECT COUNT(*) FILTER (o_orderstatus = 'F') AS create_count, COUNT(*) FILTER (o_orderstatus = 'O') AS update_count,
              COUNT(*) FILTER (o_orderstatus = 'P') AS delete_count FROM orders""",
)
def stage_counts(t: Tables) -> DataFrame:
    """Counted while the rows are written, not by running the plan again."""
    from stratalake.session import fresh_path

    action = F.when(F.col("o_orderstatus") == "F", "create").when(F.col("o_orderstatus") == "O", "update").otherwise("delete")
    watched, seen = quality.observe_actions(t.orders.withColumn("act", action), "stage", "act")
    watched.write.parquet(fresh_path(t.spark, "observed"))
    return t.spark.createDataFrame([seen.get])


@query(
    "ops_04_frame_report",
    """SELECT side, COUNT(*) AS rows, SUM(copies)::BIGINT AS copies FROM (
         SELECT o_custkey, o_orderstatus, CASE WHEN SUM(v) > 0 THEN 'missing' ELSE 'unexpected' END AS side, ABS(SUM(v)) AS copies
         FROM (SELECT o_custkey, o_orderstatus, 1 AS v FROM orders
               UNION ALL SELECT o_custkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'F' ELSE o_orderstatus END, -1 FROM orders)
         GROUP BY o_custkey, o_orderstatus HAVING SUM(v) <> 0) GROUP BY side""",
)
def frame_report(t: Tables) -> DataFrame:
    expected = t.orders.select("o_custkey", "o_orderstatus")
    status = F.when(F.col("o_orderpriority") == "5-LOW", "F").otherwise(F.col("o_orderstatus"))
    report = sets.multiset_diff(expected, t.orders.select("o_custkey", status.alias("o_orderstatus")))
    return report.groupBy("side").agg(F.count(F.lit(1)).alias("rows"), F.sum("copies").alias("copies"))


@query(
    "ops_05_rule_violations",
    """SELECT doc_id, concat_ws(',', CASE WHEN lang <> 'en' THEN 'english' END, CASE WHEN quality IS NULL THEN 'labelled' END,
              CASE WHEN NOT COALESCE(toxic = 0, FALSE) THEN 'clean' END,
              CASE WHEN NOT regexp_matches(stamp, 'T') THEN 'timestamp' END) AS reasons
       FROM (SELECT *, source || n_chars AS stamp FROM documents) LEFT JOIN labels USING (doc_id)
       WHERE lang <> 'en' OR quality IS NULL OR NOT COALESCE(toxic = 0, FALSE) OR NOT regexp_matches(stamp, 'T')""",
)
def rule_violations(t: Tables) -> DataFrame:
    rows = t.documents.withColumn("stamp", F.concat("source", "n_chars")).join(t.labels, "doc_id", "left")
    rules = {
        "english": F.col("lang") == "en",
        "labelled": quality.required("quality"),
        "clean": F.col("toxic") == 0,
        "timestamp": quality.optional_timestamp("stamp"),
    }
    broken = quality.violations(rows, ["doc_id"], rules)
    return broken.withColumn("reasons", F.array_join("reasons", ","))


@query(
    "ops_06_same_count",
    "SELECT COUNT(*) AS before_rows, COUNT(*) AS after_rows, TRUE AS same FROM customer",
)
def same_count(t: Tables) -> DataFrame:
    masked = masking.mask_classified(_people(t), CLASSIFIED, POLICY)
    return quality.same_count(t.customer, masked)
