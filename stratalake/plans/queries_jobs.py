"""Queries for the entity jobs, over source tables derived from the star schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.plans import curate as C
from stratalake.plans import harmonise as H
from stratalake.plans import standardise as S
from stratalake.plans.landing import land_drops, land_messages
from stratalake.plans.queries_sources import MESSAGES_SQL, _messages, _scratch_table
from stratalake.plans.registry import Tables, query
from stratalake.session import fresh_path
from stratalake.sources.manifest import Landed
from stratalake.sources.routing import SourceDefinition
from stratalake.sources.sinks import write_files

SNAPSHOT = "2024-02-01"


def at(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def shaped(df: DataFrame, columns: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """The listed columns, null text where no value is given."""
    return df.select(*[values.get(c, F.lit(None).cast("string")).alias(c) for c in columns])


def naive(df: DataFrame, *times: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


def row_id_sql(columns: Sequence[str], values: Mapping[str, str]) -> str:
    """SQL of the row id over a column list of which only some columns are filled."""
    return "md5(" + " || ".join(f"COALESCE(CAST({values[c]} AS VARCHAR), '.')" if c in values else "'.'" for c in columns) + ")"


def ranked_sql(base: str, key: str, known: str, id_name: str) -> str:
    """SQL of a rank history over rows with ``"IngestionDate"``."""
    return f"""SELECT *, ROW_NUMBER() OVER (ORDER BY "IngestionDate", {key}) AS "{id_name}",
        LEAD("IngestionDate") OVER (PARTITION BY {key} ORDER BY "IngestionDate") AS "ValidTo",
        CASE WHEN LEAD("IngestionDate") OVER (PARTITION BY {key} ORDER BY "IngestionDate") IS NULL THEN 'Y' ELSE 'N' END AS "IsActive",
        CASE WHEN {key} IN ({known}) THEN '1' ELSE '0' END AS "Migrated" FROM ({base})"""


def message_book(since: Column) -> dict[str, Column]:
    return {
        "Migrated": F.lit("1"),
        "ODTSourceSystem": F.lit("ODT"),
        "SourceSystemID": F.lit("7"),
        "IngestionDate": since,
        "ValidTo": F.lit(""),
        "RowID": F.lit(""),
        "IsActive": F.lit("Y"),
    }


# Columns, book, in order.
BOOK = [
    "Migrated",
    "ODTSourceSystem",
    "SourceSystemID",
    "IngestionDate",
    "ValidTo",
    "RowID",
    "IsActive",
]


def source_system(t: Tables) -> DataFrame:
    """The one active source-system row, from the region table."""
    return t.region.filter("r_regionkey = 0").select(
        F.lit("7").alias("SourceSystemID"),
        at("2024-01-15").alias("IngestionDate"),
        F.lit(None).cast("string").alias("ValidTo"),
        F.lit("Y").alias("IsActive"),
    )


# --- standardised --------------------------------------------------------------------------------


def utc(year: int, month: int, day: int) -> datetime:
    return datetime(year, month, day, tzinfo=timezone.utc)


def _opened_twice(runs: Sequence[Landed]) -> Column:
    """Files that more than one run opened."""
    every = [p for r in runs for p in r.paths]
    return F.lit(len(every) - len(set(every))).cast("long")


@query(
    "ent_s1_messages",
    f"""SELECT message_id, message_type, CASE WHEN event_id % 8 < 5 THEN TIMESTAMP '2024-03-01' ELSE TIMESTAMP '2024-03-02' END AS expected_from,
               ts AS ingested_datetime, event_id % 8 AS slot, 0::BIGINT AS opened_twice
        FROM (SELECT CAST(message_id AS BIGINT) AS event_id, * FROM ({MESSAGES_SQL}))""",
)
def s1_messages(t: Tables) -> DataFrame:
    """Every message lands twice in its file. The second run finds the files of the first beside new ones, the third
    nothing new. Folder names hold blanks and percent signs."""
    raw = _messages(t).drop("ts", "input_file").withColumn("slot", F.concat(F.pmod(F.col("message_id").cast("long"), 8), F.lit(" 50%")))
    schema = T.StructType([f for f in raw.schema.fields if f.name != "slot"])
    landing, manifest, table = fresh_path(t.spark, "landed messages"), fresh_path(t.spark, "manifest"), _scratch_table(t, "messages")
    runs = []
    for wanted, when in ((F.col("slot") < "5", utc(2024, 3, 1)), (F.col("slot") >= "5", utc(2024, 3, 2)), (F.lit(False), utc(2024, 3, 3))):
        some = raw.filter(wanted)
        write_files(some.unionByName(some).repartition("slot"), landing, "json", "append", partition_by="slot")
        runs.append(land_messages(t.spark, landing, schema, table, manifest, when, most=3))
    slot = F.regexp_extract("input_file", r"landed messages[^/]*/slot=(\d) 50%25/", 1).cast("long")
    out = t.spark.table(table).select("message_id", "message_type", "expected_from", "ingested_datetime", slot.alias("slot"), _opened_twice(runs).alias("opened_twice"))
    return naive(out, "expected_from", "ingested_datetime")


def _drop(t: Tables) -> DataFrame:
    """Parts as a drop with awkward headers and a junk column."""
    raw = t.part.select(
        F.col("p_partkey").cast("string"), "p_name", F.col("p_size").cast("string"), F.col("p_retailprice").cast("string"), "p_type"
    )
    return raw.toDF("Part Key", "Name.", "SIZE (cm)", "price", "Unnamed: 4")


def _landed(df: DataFrame, folder: str, name: str, ending: str) -> None:
    """The frame's files in a folder, as ``<name>_<number><ending>``."""
    spark, own = df.sparkSession, f"{folder}/_written_{name}"
    write_files(df, own, ending[1:], options={"header": "true", "escape": "\\"} if ending == ".csv" else {})
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for n, file in enumerate(f for f in fs.listStatus(path(own)) if f.getPath().getName().startswith("part-")):
        fs.rename(file.getPath(), path(folder, f"{name}_{n}{ending}"))
    fs.delete(path(own), True)


PART_DECLARED = "part_key bigint, size_cm int, price array<string>"
PART_FILES = [
    SourceDefinition("parts [old", "never", enabled=False),
    SourceDefinition("parts [small", "small_parts", lateness_days=3),
    SourceDefinition("parts", "parts", lateness_days=3),
]


def _in_scratch(t: Tables, definitions: Sequence[SourceDefinition]) -> list[SourceDefinition]:
    return [replace(d, table=_scratch_table(t, d.table)) for d in definitions]


@query(
    "ent_s2_csv_drop",
    """SELECT p_partkey AS part_key, p_name AS name, p_size AS size_cm, CAST(p_retailprice AS DECIMAL(12, 2))::VARCHAR AS price,
              CASE WHEN p_size > 40 THEN p_brand END AS made_by,
              TIMESTAMP '2024-01-31' AS expected_from, TIMESTAMP '2024-02-03' AS expected_to,
              CASE WHEN p_size <= 10 THEN 'parts [small' ELSE 'parts' END AS entity_name, 0::BIGINT AS opened_twice FROM part""",
)
def s2_csv_drop(t: Tables) -> DataFrame:
    """Files of a dated folder go to two tables by their names; a later file has its columns in another order and one
    more. The declared array stays text. Files of other kinds and of other names stay where they are."""
    root, manifest = fresh_path(t.spark, "csv drops 50%"), fresh_path(t.spark, "manifest")
    definitions, folder, size = _in_scratch(t, PART_FILES), f"{root}/{SNAPSHOT}", F.col("`SIZE (cm)`").cast("int")
    drop, made_by = _drop(t), t.part.select(F.col("p_partkey").cast("string").alias("Part Key"), F.col("p_brand").alias("Made_By"))
    runs = []
    for day in (1, 2, 3):
        if day == 1:
            _landed(drop.filter(size <= 10), folder, "parts [small] {a}", ".csv")
            _landed(drop.filter((size > 10) & (size <= 40)), folder, "parts 100%", ".csv")
            _landed(drop.filter(size > 45), folder, "other", ".csv")
        if day == 2:
            _landed(drop.filter(size > 40).join(made_by, "Part Key").select("Made_By", "price", "`Part Key`", "`Name.`", "`SIZE (cm)`"), folder, "parts late", ".csv")
            _landed(drop.filter(size > 45), folder, "parts", ".json")
        runs += land_drops(
            t.spark, root, date.fromisoformat(SNAPSHOT), definitions, lambda d: T.StructType.fromDDL(PART_DECLARED), manifest, utc(2024, 3, day), process="drop", multi_line=False
        ).values()
    small, large = (t.spark.table(d.table) for d in definitions if d.enabled)
    out = small.unionByName(large, allowMissingColumns=True).withColumn("price", F.col("price").cast("decimal(12,2)").cast("string"))
    return naive(out, "expected_from", "expected_to").select(
        "part_key", "name", "size_cm", "price", "made_by", "expected_from", "expected_to", "entity_name", _opened_twice(runs).alias("opened_twice")
    )


@query(
    "ent_s3_api_drop_masked",
    """SELECT p_partkey AS part_key, 'REDACTED' AS name, p_size > 25 AS from_json, 0::BIGINT AS opened_twice FROM part""",
)
def s3_api_drop(t: Tables) -> DataFrame:
    """CSV and JSON files of one drop in one table, with the masks of a test environment."""
    from stratalake.operators.masking import mask_for_environment

    listed = [{"column_name": "Name", "classifications": ["All Full Names"]}]
    root, manifest = fresh_path(t.spark, "api drops"), fresh_path(t.spark, "manifest")
    definitions, folder, size = _in_scratch(t, PART_FILES[2:]), f"{root}/{SNAPSHOT}", F.col("`SIZE (cm)`").cast("int")
    runs = []
    for name, ending, rows in (("parts", ".csv", size <= 25), ("parts+1", ".json", size > 25)):
        _landed(_drop(t).filter(rows), folder, name, ending)
        runs += land_drops(
            t.spark, root, date.fromisoformat(SNAPSHOT), definitions, lambda d: T.StructType.fromDDL(PART_DECLARED), manifest, utc(2024, 3, 1),
            process="drop", endings=(".csv", ".json"), strict=True, multi_line=False, mask=lambda d: lambda df: mask_for_environment(df, listed, "TEST"),
        ).values()
    out = t.spark.table(definitions[0].table)
    return out.select("part_key", "name", F.endswith("input_file", F.lit(".json")).alias("from_json"), _opened_twice(runs).alias("opened_twice"))


@query(
    "ent_s4_directory",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS surname, TIMESTAMP '2024-01-31' AS expected_from,
              TIMESTAMP '2024-02-01' AS expected_to FROM customer""",
)
def s4_directory(t: Tables) -> DataFrame:
    user = F.struct(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("surname"))
    docs = t.customer.groupBy(F.floor(F.col("c_custkey") / 100).alias("page")).agg(F.collect_list(user).alias("value"))
    out = S.directory_users(docs, at("2024-03-01"), F.lit(SNAPSHOT), 1)
    return naive(out.drop("ingested_datetime"), "expected_from", "expected_to")


@query(
    "ent_s5_attribute_matrix",
    """SELECT c_mktsegment AS attribute, c_name AS "appealReference", CAST(c_nationkey AS VARCHAR) AS s78 FROM customer
       WHERE c_acctbal >= 0""",
)
def s5_attribute_matrix(t: Tables) -> DataFrame:
    """Debtors have no usable attribute."""
    raw = t.customer.select(
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).otherwise("'"), "c_name", "c_nationkey", "c_custkey", "c_custkey"
    )
    return S.attribute_matrix(raw.toDF("attribute", "Appeal   Reference", "S78", "_c3", " "))


@query("ent_s6_listed_entities", 'SELECT s_suppkey AS entity, s_name AS "listed-name" FROM supplier, nation WHERE s_nationkey = n_nationkey AND n_regionkey <= 2 UNION ALL SELECT s_suppkey, s_name FROM supplier')
def s6_listed_entities(t: Tables) -> DataFrame:
    """Documents of at most ten suppliers; those of the first regions come in two documents."""
    item = F.struct(F.col("s_suppkey").alias("entity"), F.col("s_name").alias("listed-name"))

    def pages(rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.floor(F.col("s_suppkey") / 10)).agg(F.collect_list(item).alias("entities")).select("entities")

    near = t.nation.filter("n_regionkey <= 2")
    again = t.supplier.join(near, F.col("s_nationkey") == F.col("n_nationkey"), "left_semi")
    return S.listed_entities(pages(t.supplier).unionByName(pages(again)))


def _case_tables(t: Tables) -> tuple[DataFrame, list[S.Related], dict]:
    base = t.orders.select(
        F.col("o_custkey").alias("caseuniqueid"),
        F.col("o_orderkey").alias("casenodeid"),
        F.col("o_orderstatus").alias("abbreviation"),
        F.col("o_orderdate").alias("expected_from"),
        F.col("o_orderkey").alias("file_id"),
    )
    sites = t.lineitem.select(
        F.col("l_orderkey").alias("casenodeid"),
        F.col("l_partkey").alias("site"),
        F.col("l_shipdate").alias("expected_from"),
        F.col("l_linenumber").alias("modified_datetime"),
        F.col("l_extendedprice").alias("file_id"),
    )
    wishes = t.orders.select(
        F.col("o_custkey").alias("ref"),
        F.when(F.col("o_orderstatus") == "F", "Written Reps").when(F.col("o_orderstatus") == "P", " ").alias("appellant"),
        F.lit("Public Inquiry").alias("authority"),
        F.col("o_orderdate").alias("expected_from"),
        F.col("o_orderkey").alias("file_id"),
    )
    related = [
        S.Related(sites, {"casenodeid": "casenodeid"}, {"site": "site"}),
        S.Related(wishes, {"caseuniqueid": "ref"}, {"appellant": "appellant", "authority": "authority"}),
    ]
    lists = {"specialisms": (t.orders.select(F.col("o_custkey").alias("ref"), "o_orderpriority"), "ref", "o_orderpriority")}
    return base, related, lists


CASES_SQL = """
  WITH base AS (SELECT * FROM orders QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
  site AS (SELECT l_orderkey, l_partkey FROM lineitem QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey
           ORDER BY l_shipdate DESC, l_linenumber DESC, l_extendedprice DESC) = 1),
  spec AS (SELECT o_custkey, string_agg(p, ', ' ORDER BY p) AS specialisms
           FROM (SELECT DISTINCT o_custkey, o_orderpriority AS p FROM orders) GROUP BY o_custkey)
  SELECT o_custkey AS "caseReference", o_orderkey AS "caseId", o_orderstatus AS abbreviation, l_partkey AS site, specialisms,
         CASE o_orderstatus WHEN 'F' THEN 'WR' WHEN 'P' THEN NULL ELSE 'LI' END AS "caseProcedure"
  FROM base LEFT JOIN site ON l_orderkey = o_orderkey LEFT JOIN spec USING (o_custkey)
"""


def _cases(t: Tables) -> DataFrame:
    base, related, lists = _case_tables(t)
    out = S.cases(
        base,
        "caseuniqueid",
        related,
        lists,
        {"caseuniqueid": "caseReference", "casenodeid": "caseId"},
        ("caseProcedure", "appellant", "authority"),
    )
    return out.drop("expected_from", "file_id")


@query("ent_s7_cases", CASES_SQL)
def s7_cases(t: Tables) -> DataFrame:
    return _cases(t)


@query(
    "ent_s8_cases_with_grounds",
    f"""SELECT c.*, grounds, c_name AS "leadCase" FROM ({CASES_SQL}) c
        LEFT JOIN (SELECT o_custkey, string_agg(s || ':' || strftime(d, '%Y-%m-%d'), ',' ORDER BY s, d) AS grounds
                   FROM (SELECT DISTINCT o_custkey, o_orderstatus AS s, o_orderdate AS d FROM orders) GROUP BY o_custkey)
          ON o_custkey = "caseReference"
        LEFT JOIN customer ON c_custkey = "caseReference" """,
)
def s8_cases_with_grounds(t: Tables) -> DataFrame:
    """The longer family: nested grounds and one more stage on top of the shared ones."""
    from stratalake.operators.joins import enrich

    grounds = S.appeal_grounds(t.orders, "o_custkey", "o_orderstatus", "o_orderdate", "grounds")
    item = lambda g: F.concat_ws(":", g["appealGroundLetter"], F.date_format(g["groundForAppealStartDate"], "yyyy-MM-dd"))
    shown = grounds.withColumn("grounds", F.array_join(F.transform("grounds", item), ","))
    out = enrich(_cases(t), shown, {"caseReference": "o_custkey"}, {"grounds": "grounds"})
    return enrich(out, t.customer, {"caseReference": "c_custkey"}, {"c_name": "leadCase"})


# --- harmonised: messages and documents ----------------------------------------------------------


@query(
    "ent_h1_message_entity",
    f"""WITH m AS (SELECT message_id, user_id, ts, message_enqueued_time_utc AS since, CASE message_type WHEN 'signup' THEN 'create'
              WHEN 'click' THEN 'update' WHEN 'purchase' THEN 'update' ELSE 'delete' END AS act FROM ({MESSAGES_SQL})),
        day AS (SELECT MAX(CAST(ts AS DATE)) AS d FROM m),
        old AS (SELECT * FROM m, day WHERE CAST(ts AS DATE) < d AND act <> 'delete'),
        new AS (SELECT * FROM m, day WHERE message_id NOT IN (SELECT message_id FROM old)),
        closing AS (SELECT user_id, MIN(since) AS f FROM new WHERE act <> 'create' GROUP BY user_id)
        SELECT message_id, user_id, since AS "IngestionDate", f AS "ValidTo", CASE WHEN f IS NULL THEN 'Y' ELSE 'N' END AS "IsActive",
               '0' AS "SourceSystemID" FROM old LEFT JOIN closing USING (user_id)
        UNION ALL SELECT message_id, user_id, since, NULL, 'Y', '0' FROM new WHERE act <> 'delete'""",
)
def h1_message_entity(t: Tables) -> DataFrame:
    """History of all days but the last, then everything that is not in it."""
    kind = (
        F.when(F.col("message_type") == "signup", "Create")
        .when(F.col("message_type") == "click", "Publish")
        .when(F.col("message_type") == "purchase", "Update")
        .otherwise("Delete")
    )
    rows = _messages(t).withColumns({"message_type": kind, "ingested_datetime": F.col("ts")}).drop("value", "input_file")
    last = F.to_date(rows.agg(F.max("ts")).scalar())
    system = t.region.filter("r_regionkey = 0").select(F.col("r_regionkey").alias("SourceSystemID"))
    before = H.message_entity(rows.filter(F.to_date("ts") < last).drop("ts"), None, "user_id", "EntityID", system)
    out = H.message_entity(rows.drop("ts"), before, "user_id", "EntityID", system)
    return out.select("message_id", "user_id", "IngestionDate", "ValidTo", "IsActive", "SourceSystemID")


@query(
    "ent_h2_extract_documents",
    f"""SELECT *, {row_id_sql(H.EXTRACT_DOCUMENT_ROW_ID, {
        "documentId": '"documentId"', "version": "version", "filename": "filename", "size": "size", "caseRef": '"caseRef"',
        "Migrated": "'0'", "ODTSourceSystem": "'Horizon'", "IngestionDate": "TIMESTAMP '2024-02-01'"})} AS "RowID",
        ROW_NUMBER() OVER (ORDER BY md5("documentId" || filename || version)) AS "AIEDocumentDataID"
        FROM (SELECT CAST(doc_id AS VARCHAR) AS "documentId", '1' AS version, source || lang AS filename,
                     CAST(n_chars AS VARCHAR) AS size, lang AS "caseRef", 'Y' AS "IsActive" FROM documents)""",
)
def h2_extract_documents(t: Tables) -> DataFrame:
    """Two loads; only the newer one counts."""
    cols = [c for c in H.EXTRACT_DOCUMENT_ROW_ID if c not in BOOK and c != "AIEDocumentDataID"] + ["expected_from"]
    values = {
        "documentId": F.col("doc_id").cast("string"),
        "version": F.lit("1"),
        "filename": F.concat("source", "lang"),
        "size": F.col("n_chars").cast("string"),
        "caseRef": F.col("lang"),
    }
    new = shaped(t.documents, cols, {**values, "expected_from": at(SNAPSHOT)})
    old = shaped(t.documents, cols, {**values, "expected_from": at("2024-01-01")})
    out = H.extract_documents(new.unionByName(old))
    return out.select("documentId", "version", "filename", "size", "caseRef", "IsActive", "RowID", "AIEDocumentDataID")


PROJECT_DOC_MESSAGE = [c for c in H.PROJECT_DOCUMENT_ROW_ID if c not in BOOK] + ["documentReference", "representative"] + BOOK


def _project_documents(t: Tables) -> DataFrame:
    """All documents as legacy ones; those in two languages come as messages too, dated by language."""
    docs = t.documents.withColumn("doc_id", F.col("doc_id").cast("string"))
    since = F.when(F.col("lang") == "en", at("2024-01-01")).otherwise(at("2024-03-01"))
    messages = shaped(
        docs.filter("lang IN ('en', 'fr')"),
        PROJECT_DOC_MESSAGE,
        {
            "documentId": F.col("doc_id"),
            "filename": F.col("source"),
            "version": F.lit("1"),
            "size": F.col("n_chars").cast("string"),
            "caseRef": F.col("lang"),
            "caseType": F.lit("Big Case"),
            "publishedStatus": F.lit("Depublished"),
            **message_book(since),
        },
    )
    legacy = shaped(
        docs,
        [*H.PROJECT_DOCUMENT_LEGACY, "expected_from"],
        {
            "dataId": F.col("doc_id"),
            "name": F.col("source"),
            "version": F.lit("1"),
            "dataSize": F.col("n_chars").cast("string"),
            "caseReference": F.col("lang"),
            "publishedStatus": F.lit("Ready To Publish"),
            "expected_from": at(SNAPSHOT),
        },
    )
    extract = shaped(
        docs.join(t.labels.select(F.col("doc_id").cast("string"), "quality"), "doc_id"),
        ["DocumentId", "version", "size", *H.PROJECT_DOCUMENT_EXTRACT],
        {
            "DocumentId": F.col("doc_id"),
            "version": F.lit("1"),
            "size": F.col("n_chars").cast("string"),
            "mime": F.col("quality").cast("string"),
        },
    )
    return H.project_documents(messages, legacy, extract)


PROJECT_DOCUMENTS_SQL = f"""
  {ranked_sql('''
    SELECT CAST(doc_id AS VARCHAR) AS "documentId", source AS filename, lang AS "caseRef", NULL AS mime, 'ODT' AS "ODTSourceSystem",
           CASE lang WHEN 'en' THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-03-01' END AS "IngestionDate",
           md5(doc_id || source || '1') AS pk, n_chars FROM documents WHERE lang IN ('en', 'fr')
    UNION ALL SELECT CAST(doc_id AS VARCHAR), source, lang, CAST(quality AS VARCHAR), 'Horizon', TIMESTAMP '2024-02-01',
           md5(doc_id || source || '1'), n_chars FROM documents LEFT JOIN labels USING (doc_id) ''',
    'pk', "SELECT md5(doc_id || source || '1') FROM documents WHERE lang IN ('en', 'fr')", 'NSIPDocumentID')}
"""


@query(
    "ent_h3_project_documents",
    f"""SELECT "documentId", filename, "caseRef", mime, "ODTSourceSystem", "IngestionDate", "ValidTo", "IsActive", "Migrated",
               "NSIPDocumentID", CASE "ODTSourceSystem" WHEN 'ODT' THEN {row_id_sql(H.PROJECT_DOCUMENT_ROW_ID, {
        "documentId": '"documentId"', "caseRef": '"caseRef"', "version": "'1'", "filename": "filename", "size": "n_chars",
        "caseType": "'Big Case'", "publishedStatus": "'Depublished'", "Migrated": "'1'", "ODTSourceSystem": '"ODTSourceSystem"',
        "IngestionDate": '"IngestionDate"', "ValidTo": "''"})} ELSE {row_id_sql(H.PROJECT_DOCUMENT_ROW_ID, {
        "documentId": '"documentId"', "caseRef": '"caseRef"', "version": "'1'", "filename": "filename", "size": "n_chars",
        "mime": "mime", "publishedStatus": "'Ready To Publish'", "Migrated": "'0'", "ODTSourceSystem": '"ODTSourceSystem"',
        "IngestionDate": '"IngestionDate"'})} END AS "RowID" FROM ({PROJECT_DOCUMENTS_SQL})""",
)
def h3_project_documents(t: Tables) -> DataFrame:
    out = _project_documents(t).select(
        "documentId", "filename", "caseRef", "mime", "ODTSourceSystem", "IngestionDate", "ValidTo", "IsActive", "Migrated",
        "NSIPDocumentID", "RowID",
    )
    return naive(out, "IngestionDate", "ValidTo")


APPEAL_DOC_MESSAGE = [c for c in H.APPEAL_DOCUMENT_ROW_ID if c not in BOOK] + BOOK


def _appeal_documents(t: Tables) -> DataFrame:
    docs = t.documents.withColumn("doc_id", F.col("doc_id").cast("string"))
    messages = shaped(
        docs.filter("lang = 'en'"),
        APPEAL_DOC_MESSAGE,
        {
            "documentId": F.col("doc_id"),
            "filename": F.col("source"),
            "version": F.lit("1"),
            "caseType": F.lit("Call-In Application"),
            "caseReference": F.col("lang"),
            **message_book(at("2024-01-01")),
        },
    )
    legacy = shaped(
        docs,
        [*H.APPEAL_DOCUMENT_LEGACY, "expected_from", "ingested_datetime"],
        {
            "documentId": F.col("doc_id"),
            "filename": F.col("source"),
            "version": F.lit("1"),
            "size": F.col("n_chars").cast("string"),
            "caseReference": F.col("lang"),
            "caseworkType": F.lit("Planning Appeal (A)"),
            "expected_from": at(SNAPSHOT),
            "ingested_datetime": at(SNAPSHOT),
        },
    )
    extract = shaped(docs.filter(F.lit(False)), ["documentid", "version", "size", *H.APPEAL_DOCUMENT_EXTRACT], {})
    return H.appeal_documents(messages, legacy, extract)


@query(
    "ent_h4_appeal_documents",
    ranked_sql(
        """SELECT CAST(doc_id AS VARCHAR) AS "documentId", source AS filename, NULL AS "originalFilename", 'Call-In Application' AS "caseType",
                  TIMESTAMP '2024-01-01' AS "IngestionDate", md5(doc_id || source || '1') AS pk FROM documents WHERE lang = 'en'
           UNION ALL SELECT CAST(doc_id AS VARCHAR), source, source, 'Planning Appeal (A)', TIMESTAMP '2024-02-01',
                  md5(doc_id || source || '1') FROM documents""",
        "pk",
        "SELECT md5(doc_id || source || '1') FROM documents WHERE lang = 'en'",
        "AppealsDocumentMetadataID",
    ).replace("SELECT *,", "SELECT * EXCLUDE (pk),", 1),
)
def h4_appeal_documents(t: Tables) -> DataFrame:
    out = _appeal_documents(t).select(
        "documentId", "filename", "originalFilename", "caseType", "IngestionDate", "AppealsDocumentMetadataID", "ValidTo",
        "IsActive", "Migrated",
    )
    return naive(out, "IngestionDate", "ValidTo")


# --- harmonised: project families ----------------------------------------------------------------

REPRESENTATION_MESSAGE = [
    "NSIPRepresentationID", "representationId", *[c for c in H.REPRESENTATION_ROW_ID if c not in ("NSIPRepresentationID", "representationId", "attachmentIds")],
    "attachmentIds", *BOOK,
]


def _representations(t: Tables) -> DataFrame:
    """Urgent orders came as messages; every order is a legacy representation with one row per line."""
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'")
    messages = shaped(
        urgent,
        REPRESENTATION_MESSAGE,
        {
            "representationId": F.col("o_orderkey").cast("int"),
            "caseRef": F.col("o_orderpriority"),
            "status": F.lit("Complete"),
            "redacted": F.lit(False),
            "attachmentIds": F.array(F.col("o_custkey").cast("string")),
            **message_book(at("2024-01-01")),
        },
    )
    cols = [
        "relevantrepid",
        "casereference",
        "casenodeid",
        "RelevantRepStatus",
        "representationoriginal",
        "representationredacted",
        "redactedBy",
        "notes",
        "RelRepOnBehalfOf",
        "contactId",
        "agentcontactid",
        "RelRepOrganisation",
        "dateReceived",
        "attachmentId",
        "ingested_datetime",
    ]
    lines = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    legacy = shaped(
        lines,
        cols,
        {
            "relevantrepid": F.col("o_orderkey").cast("string"),
            "casereference": F.col("o_orderpriority"),
            "casenodeid": F.col("o_custkey") + 1,
            "RelevantRepStatus": F.lit("In Progress"),
            "RelRepOnBehalfOf": F.lit("Myself"),
            "attachmentId": F.col("l_linenumber").cast("string"),
            "ingested_datetime": at(SNAPSHOT),
        },
    ).distinct()
    return H.representations(messages, legacy, source_system(t))


@query(
    "ent_h5_representations",
    ranked_sql(
        """SELECT o_orderkey::INTEGER AS "representationId", NULL AS "referenceId", 'Complete' AS status,
                  o_custkey::VARCHAR AS attachments, TIMESTAMP '2024-01-01' AS "IngestionDate" FROM orders WHERE o_orderpriority = '1-URGENT'
           UNION ALL SELECT o_orderkey::INTEGER, o_orderpriority || '-' || o_orderkey, 'In Progress',
                  string_agg(n, ',' ORDER BY n), TIMESTAMP '2024-01-15'
           FROM (SELECT DISTINCT l_orderkey, l_linenumber AS n FROM lineitem) JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""",
        '"representationId"',
        "SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'",
        "NSIPRepresentationID",
    ),
)
def h5_representations(t: Tables) -> DataFrame:
    out = _representations(t).select(
        "representationId", "referenceId", "status", F.array_join("attachmentIds", ",").alias("attachments"), "IngestionDate",
        "ValidTo", "IsActive", "Migrated", "NSIPRepresentationID",
    )
    return naive(out, "IngestionDate", "ValidTo")


ADVICE_MESSAGE = [c for c in H.ADVICE_ROW_ID if c not in BOOK] + ["AttachmentModifyDate"] + BOOK


def _advice(t: Tables) -> DataFrame:
    """Pending orders came as messages; the newest legacy load lacks the finished orders."""
    messages = shaped(
        t.orders.filter("o_orderstatus = 'P'"),
        ADVICE_MESSAGE,
        {
            "adviceId": F.col("o_orderkey").cast("int"),
            "agent": F.lit("None"),
            "status": F.lit("Checked"),
            "attachmentIds": F.array(F.col("o_custkey").cast("string")),
            **message_book(at("2024-01-01")),
        },
    )
    cols = [
        "advicenodeid",
        "casenodeid",
        "enquirerfirstname",
        "enquirerlastname",
        "enquirerOrganisation",
        "enqirymethod",
        "adviceStatus",
        "attachmentdataID",
        "expected_from",
        "ingested_datetime",
    ]

    def load(rows: DataFrame, day: str) -> DataFrame:
        return shaped(
            rows,
            cols,
            {
                "advicenodeid": F.col("o_orderkey").cast("string"),
                "casenodeid": F.col("o_custkey").cast("string"),
                "enquirerfirstname": F.lit("A"),
                "enquirerlastname": F.col("o_orderpriority"),
                "enqirymethod": F.lit("Phone"),
                "adviceStatus": F.lit("Not Checked"),
                "attachmentdataID": F.col("o_custkey").cast("string"),
                "expected_from": at(day),
                "ingested_datetime": at(day),
            },
        )

    legacy = load(t.orders, "2023-12-01").unionByName(load(t.orders.filter("o_orderstatus <> 'F'"), SNAPSHOT))
    # Finished orders that are gone from the newest load still have their message rows closed.
    closed = shaped(
        t.orders.filter("o_orderstatus = 'F'"),
        ADVICE_MESSAGE,
        {
            "adviceId": F.col("o_orderkey").cast("int"),
            "status": F.lit("Checked"),
            "agent": F.lit("None"),
            "attachmentIds": F.array(F.col("o_custkey").cast("string")),
            **message_book(at("2024-01-02")),
        },
    )
    return H.advice(messages.unionByName(closed), legacy)


@query(
    "ent_h6_advice",
    f"""SELECT "adviceId", "from", status, attachments, "IngestionDate", "Migrated", "NSIPAdviceID",
               CASE WHEN gone THEN 'N' ELSE "IsActive" END AS "IsActive",
               CASE WHEN gone OR "IsActive" = 'N' THEN COALESCE("ValidTo", CAST(CAST("IngestionDate" AS DATE) + INTERVAL 1 DAY AS TIMESTAMP)) END AS "ValidTo"
        FROM ({ranked_sql('''
          SELECT o_orderkey::INTEGER AS "adviceId", NULL AS "from", 'Checked' AS status, o_custkey::VARCHAR AS attachments,
                 CASE o_orderstatus WHEN 'P' THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-01-02' END AS "IngestionDate",
                 o_orderstatus = 'F' AS gone FROM orders WHERE o_orderstatus IN ('P', 'F')
          UNION ALL SELECT o_orderkey::INTEGER, 'A ' || o_orderpriority, 'Not Checked', o_custkey::VARCHAR, TIMESTAMP '2024-02-01', FALSE
          FROM orders WHERE o_orderstatus <> 'F' ''', '"adviceId"', "SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('P', 'F')", 'NSIPAdviceID')})""",
)
def h6_advice(t: Tables) -> DataFrame:
    out = _advice(t).select(
        "adviceId", "from", "status", F.array_join("attachmentIds", ",").alias("attachments"), "IngestionDate", "Migrated",
        "NSIPAdviceID", "IsActive", "ValidTo",
    )
    return naive(out, "IngestionDate", "ValidTo")


def _timetable(t: Tables) -> DataFrame:
    """Each customer is a case: its first order is the message event, legacy has one event per order."""
    orders = t.orders.select(F.col("o_custkey").cast("string").alias("case"), "o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    event = F.struct(
        F.col("o_orderkey").cast("int").alias("eventId"),
        F.col("o_orderstatus").alias("type"),
        F.col("o_orderpriority").alias("eventTitle"),
        F.lit("  ").alias("eventTitleWelsh"),
        F.lit("text").alias("description"),
        F.lit(None).cast("string").alias("descriptionWelsh"),
        F.col("o_orderdate").cast("string").alias("date"),
        F.lit("no date").alias("eventDeadlineStartDate"),
    )
    first = orders.groupBy("case").agg(F.array(F.min_by(event, "o_orderkey")).alias("events"))
    messages = first.select(
        F.lit(None).cast("long").alias("NSIPExaminationTimetableID"),
        F.col("case").alias("caseReference"),
        F.lit(True).alias("published"),
        "events",
        *[c.alias(n) for n, c in message_book(at("2024-01-01")).items()],
    )
    # One legacy event per case, its newest order, so that the order within a case is fixed.
    newest = orders.groupBy("case").agg(F.max_by(F.struct("o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate"), "o_orderkey").alias("e"))
    legacy = newest.select(
        F.col("case").alias("CaseReference"),
        F.col("e.o_orderkey").cast("string").alias("ID"),
        F.col("e.o_orderstatus").alias("typeofexamination"),
        F.col("e.o_orderpriority").alias("Name"),
        *[F.lit(None).cast("string").alias(c) for c in ("NameWelsh", "Description", "DescriptionWelsh", "DeadlineStartDateTime")],
        F.col("e.o_orderdate").cast("string").alias("Date"),
        at(SNAPSHOT).alias("expected_from"),
        at(SNAPSHOT).alias("ingested_datetime"),
    )
    state = F.when(F.col("c_acctbal") < 0, "Not Published").when(F.col("c_mktsegment") == "BUILDING", "Published").otherwise("Other")
    states = t.customer.select(
        F.col("c_custkey").cast("string").alias("CaseReference"), state.alias("ExamTimetablePublishStatus"), at(SNAPSHOT).alias("ingested_datetime")
    )
    return H.exam_timetable(messages, legacy, states)


@query(
    "ent_h7_exam_timetable",
    ranked_sql(
        """SELECT o_custkey::VARCHAR AS "caseReference", 'true' AS published, MIN(o_orderkey)::INTEGER AS "eventId",
                  NULL AS "eventTitleWelsh", strftime(MIN_BY(o_orderdate, o_orderkey), '%Y-%m-%d %H:%M') AS "eventDate",
                  TIMESTAMP '2024-01-01' AS "IngestionDate" FROM orders GROUP BY o_custkey
           UNION ALL SELECT o_custkey::VARCHAR, MAX(CASE WHEN c_acctbal < 0 THEN 'false' WHEN c_mktsegment = 'BUILDING' THEN 'true' END),
                  MAX(o_orderkey)::INTEGER, NULL, strftime(MAX_BY(o_orderdate, o_orderkey), '%Y-%m-%d %H:%M'), TIMESTAMP '2024-02-01'
           FROM orders LEFT JOIN customer ON c_custkey = o_custkey GROUP BY o_custkey""",
        '"caseReference"',
        "SELECT o_custkey::VARCHAR FROM orders",
        "NSIPExaminationTimetableID",
    ),
)
def h7_exam_timetable(t: Tables) -> DataFrame:
    out = _timetable(t).select(
        "caseReference", F.col("published").cast("string"), "eventId", "eventTitleWelsh", "eventDate", "IngestionDate",
        "NSIPExaminationTimetableID", "ValidTo", "IsActive", "Migrated",
    )
    return naive(out, "IngestionDate", "ValidTo")


MEETINGS_TYPE = "array<struct<meetingId:string,meetingAgenda:string,meetingDate:string,meetingType:string>>"


def _project_versions(t: Tables) -> DataFrame:
    """Urgent orders are project versions sent as messages; the others are legacy versions with one row per line."""
    book = {"ODTSourceSystem": F.lit("ODT"), "SourceSystemID": F.lit("7"), "ValidTo": F.lit(None).cast("string"), "RowID": F.lit("")}
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'")
    messages = urgent.select(
        F.lit(None).cast("long").alias("NSIPProjectInfoInternalID"),
        F.col("o_custkey").alias("caseId"),
        F.col("o_orderkey").cast("string").alias("caseReference"),
        F.col("o_orderstatus").alias("stage"),
        F.array(F.lit("sent")).alias("regions"),
        F.array().cast("array<string>").alias("inspectorIds"),
        F.lit(None).cast(H.INVOICES_TYPE).alias("invoices"),
        F.lit(None).cast(MEETINGS_TYPE).alias("meetings"),
        F.timestamp_micros(F.unix_micros(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey")).alias("IngestionDate"),
        *[c.alias(n) for n, c in book.items()],
    )
    lines = t.orders.filter("o_orderpriority <> '1-URGENT'").join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    invoice = F.format_string(
        "[{'invoiceStage': '%s', 'invoiceNumber': '%d', 'amountDue': %d}]", "o_orderstatus", "o_orderkey", "o_custkey"
    )
    meeting = F.format_string("[{'meetingId': '%d', 'meetingAgenda': '%s', 'meetingType': 'x'}]", F.col("o_custkey") * 2, "o_orderstatus")
    legacy = lines.select(
        F.lit(None).cast("long").alias("NSIPProjectInfoInternalID"),
        F.col("o_custkey").alias("caseId"),
        F.col("o_custkey").alias("HorizonCaseNumber"),
        F.col("o_orderkey").cast("string").alias("caseReference"),
        F.col("o_orderstatus").alias("stage"),
        F.col("l_linenumber").cast("string").alias("region"),
        F.col("l_suppkey").cast("string").alias("inspectorIds"),
        invoice.alias("invoices"),
        meeting.alias("meetings"),
        F.timestamp_micros(F.unix_micros(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey")).alias("IngestionDate"),
        F.lit("Horizon").alias("ODTSourceSystem"),
        F.lit(None).cast("string").alias("SourceSystemID"),
        F.lit(None).cast("string").alias("ValidTo"),
        F.lit("").alias("RowID"),
    )
    return H.projects(messages, legacy)


PROJECTS_SQL = ranked_sql(
    """SELECT o_custkey AS "caseId", o_orderkey::VARCHAR AS "caseReference", 'sent' AS regions, NULL AS invoice,
              o_orderdate + to_microseconds(o_orderkey) AS "IngestionDate" FROM orders WHERE o_orderpriority = '1-URGENT'
       UNION ALL SELECT o_custkey, o_orderkey::VARCHAR, string_agg(l_linenumber, ',' ORDER BY l_linenumber::VARCHAR), o_orderkey::VARCHAR,
              o_orderdate + to_microseconds(o_orderkey) AS since FROM orders JOIN lineitem ON l_orderkey = o_orderkey
              LEFT JOIN (SELECT o_custkey AS k, MIN(o_orderdate + to_microseconds(o_orderkey)) AS first FROM orders
                         WHERE o_orderpriority = '1-URGENT' GROUP BY 1) ON k = o_custkey
       WHERE o_orderpriority <> '1-URGENT' AND (first IS NULL OR o_orderdate + to_microseconds(o_orderkey) < first) GROUP BY ALL""",
    '"caseId"',
    "SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'",
    "NSIPProjectInfoInternalID",
)


@query("ent_h8_projects", PROJECTS_SQL)
def h8_projects(t: Tables) -> DataFrame:
    out = _project_versions(t).select(
        "caseId", "caseReference", F.array_join("regions", ",").alias("regions"), F.col("invoices")[0]["invoiceNumber"].alias("invoice"),
        "IngestionDate", "NSIPProjectInfoInternalID", "ValidTo", "IsActive", "Migrated",
    )
    return naive(out, "IngestionDate", "ValidTo")


MEETINGS_SQL = f"""
  SELECT "caseId", ("caseId" * 2)::VARCHAR AS "meetingId", o_orderstatus AS "meetingAgenda", p."IngestionDate",
         ROW_NUMBER() OVER (ORDER BY "caseId", "IngestionDate") AS "NSIPMeetingId",
         LEAD(p."IngestionDate") OVER (PARTITION BY "caseId" ORDER BY p."IngestionDate") AS "ValidTo",
         CASE WHEN LEAD(p."IngestionDate") OVER (PARTITION BY "caseId" ORDER BY p."IngestionDate") IS NULL THEN 'Y' ELSE 'N' END AS "IsActive"
  FROM ({PROJECTS_SQL}) p JOIN orders ON o_orderkey::VARCHAR = "caseReference" WHERE invoice IS NOT NULL
"""


def _meetings(t: Tables) -> DataFrame:
    from stratalake.session import materialise

    return H.meetings(materialise(_project_versions(t), "projects"), None)


@query("ent_h9_meetings", MEETINGS_SQL)
def h9_meetings(t: Tables) -> DataFrame:
    out = _meetings(t).select("caseId", "meetingId", "meetingAgenda", "IngestionDate", "NSIPMeetingId", "ValidTo", "IsActive")
    return naive(out, "IngestionDate", "ValidTo")


def _invoices(t: Tables) -> DataFrame:
    from stratalake.session import materialise

    versions = materialise(_project_versions(t), "projects")
    empty = T.StructType.fromDDL(
        "NSIPInvoiceID bigint, NSIPProjectInfoInternalID bigint, caseId bigint, caseReference string, invoiceStage string, "
        "invoiceNumber string, amountDue double, paymentDueDate string, invoicedDate string, paymentDate string, "
        "refundCreditNoteNumber string, refundAmount double, refundIssueDate string, Migrated int, ODTSourceSystem string, "
        "SourceSystemID string, IngestionDate timestamp, ValidTo timestamp, RowID string, IsActive string"
    )
    return H.invoices(versions, t.spark.createDataFrame([], empty), at("2024-06-01"))


@query(
    "ent_h10_invoices",
    f"""SELECT "caseId", invoice AS "invoiceNumber", CAST("caseId" AS DOUBLE) AS "amountDue", 1 AS "Migrated", 'Y' AS "IsActive",
               ROW_NUMBER() OVER (ORDER BY "caseReference", "IngestionDate") AS "NSIPInvoiceID"
        FROM ({PROJECTS_SQL}) WHERE invoice IS NOT NULL""",
)
def h10_invoices(t: Tables) -> DataFrame:
    return _invoices(t).select("caseId", "invoiceNumber", "amountDue", "Migrated", "IsActive", "NSIPInvoiceID")


# --- harmonised: people --------------------------------------------------------------------------


def _directory(t: Tables) -> DataFrame:
    user = lambda df, day: df.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_nationkey").cast("string").alias("employeeId"),
        F.col("c_mktsegment").alias("givenName"),
        F.col("c_name").alias("surname"),
        F.concat("c_name", F.lit("@example.com")).alias("userPrincipalName"),
        at(day).alias("expected_from"),
    )
    standardised = user(t.customer, SNAPSHOT).unionByName(user(t.customer, "2024-01-01"))
    known = t.customer.filter("c_acctbal >= 0").withColumn(
        "c_mktsegment", F.when(F.col("c_mktsegment") == "BUILDING", "OTHER").otherwise(F.col("c_mktsegment"))
    )
    before = user(known, "2024-01-01").withColumnRenamed("expected_from", "IngestionDate")
    current = before.select(
        F.col("id").cast("long").alias("EmployeeEntraId"),
        "employeeId",
        "id",
        "givenName",
        "surname",
        "userPrincipalName",
        F.lit("0").alias("Migrated"),
        F.lit("EntraID").alias("ODTSourceSystem"),
        F.lit("7").alias("SourceSystemID"),
        "IngestionDate",
        F.lit(None).cast("timestamp").alias("ValidTo"),
        H.row_id(H.DIRECTORY_ROW_ID).alias("RowID"),
        F.lit("Y").alias("IsActive"),
    )
    return H.directory_users(standardised, current, source_system(t))


@query(
    "ent_h11_directory_users",
    """WITH old AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'OTHER' ELSE c_mktsegment END AS g,
                          c_mktsegment = 'BUILDING' AS changed FROM customer WHERE c_acctbal >= 0),
       rows AS (SELECT c_custkey::VARCHAR AS id, g AS "givenName", TIMESTAMP '2024-01-01' AS "IngestionDate",
                       CASE WHEN changed THEN TIMESTAMP '2024-01-31' END AS "ValidTo",
                       CASE WHEN changed THEN 'N' ELSE 'Y' END AS "IsActive", c_custkey AS old_id FROM old
                UNION ALL SELECT c_custkey::VARCHAR, c_mktsegment, TIMESTAMP '2024-02-01', NULL, 'Y', NULL FROM customer
                WHERE c_acctbal < 0 OR c_mktsegment = 'BUILDING')
       SELECT * EXCLUDE (old_id), ROW_NUMBER() OVER (ORDER BY old_id NULLS LAST, id) AS "EmployeeEntraId", '7' AS "SourceSystemID" FROM rows""",
)
def h11_directory_users(t: Tables) -> DataFrame:
    out = _directory(t).select("id", "givenName", "IngestionDate", "ValidTo", "IsActive", "EmployeeEntraId", "SourceSystemID")
    return naive(out, "IngestionDate", "ValidTo")


def _hr_inspectors(t: Tables) -> DataFrame:
    """Customers as staff: orders are their posts, priorities their specialisms, events their addresses.

    Staff numbers have two leading zeros that the directory leaves out.
    """
    number = lambda c: F.concat(F.lit("00"), F.col(c).cast("string"))
    key = number("c_custkey")
    live = t.customer.select(
        key.alias("staff_number"),
        F.concat("c_name", F.lit("@example.com")).alias("email_address"),
        F.col("c_mktsegment").alias("given_names"),
        F.col("c_name").alias("family_name"),
        F.lit("2020-01-01").alias("date_in"),
        F.col("c_nationkey").cast("string").alias("grade"),
        F.lit("Y").alias("isActive"),
        F.when(F.col("c_acctbal") < 0, "NON-ACTIVE").otherwise("ACTIVE").alias("active_status"),
    )
    staff = number("o_custkey")
    specialisms = t.orders.select(
        staff.alias("StaffNumber"),
        F.col("o_orderpriority").alias("QualificationName"),
        F.col("o_orderstatus").alias("Proficien"),
        F.concat(F.col("o_orderdate").cast("string"), F.lit("#"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("ValidFrom"),
        F.lit(1).alias("Current"),
    )
    directory = t.customer.select(
        F.concat(F.lit("d"), F.col("c_custkey")).alias("id"),
        F.col("c_custkey").cast("string").alias("employeeId"),
        F.when(F.col("c_mktsegment") == "FURNITURE", "N").otherwise("Y").alias("isActive"),
    )
    address = t.events.select(
        number("user_id").alias("StaffNumber"),
        F.concat(F.col("ts").cast("string"), F.lit("#"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("IngestionDate"),
        F.col("event_type").alias("StreetandHouseNumber"),
        *[F.lit(None).cast("string").alias(c) for c in ("2ndAddressLine", "City", "District", "PostalCode")],
    )
    hr = t.orders.select(
        staff.alias("PersNo"),
        F.col("o_orderkey").cast("string").alias("Position1"),
        *[F.lit(None).cast("string").alias(c) for c in ("FTE", "PersonnelArea", "PersonnelSubArea", "OrganizationalUnit", "NameofManagerOM", "SourceSystemID")],
        F.concat(F.col("o_orderdate").cast("string"), F.lit("#"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("ingestionDate"),
    )
    return H.hr_inspectors(live, specialisms, directory, address, hr, "staff_number", "email_address")


HR_SQL = """
  SELECT CASE WHEN c_mktsegment <> 'FURNITURE' THEN 'd' || c_custkey END AS "entraId", '00' || c_custkey AS "sapId", c_mktsegment AS "firstName",
         '2020-01-01T00:00:00.000Z' AS "validFrom", o_orderkey::VARCHAR AS title, event_type AS street, COALESCE(skills, '') AS skills
  FROM (SELECT * FROM customer WHERE c_acctbal >= 0)
  LEFT JOIN (SELECT * FROM orders QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) ON o_custkey = c_custkey
  LEFT JOIN (SELECT * FROM events QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) ON user_id = c_custkey
  LEFT JOIN (SELECT k, string_agg(o_orderpriority || ':' || o_orderstatus, ',' ORDER BY o_orderpriority) AS skills FROM (
               SELECT o_custkey AS k, * FROM orders QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderpriority
               ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) GROUP BY k) ON k = c_custkey
"""


@query("ent_h12_hr_inspectors", HR_SQL)
def h12_hr_inspectors(t: Tables) -> DataFrame:
    """Short numbers of the directory are prefixed before they are matched; furniture staff left the directory."""
    skill = lambda s: F.concat_ws(":", s["name"], s["proficiency"])
    return _hr_inspectors(t).select(
        "entraId", "sapId", "firstName", "validFrom", "title", F.col("address.addressLine1").alias("street"),
        F.array_join(F.transform("specialisms", skill), ",").alias("skills"),
    )


@query(
    "ent_h13_inspector_timeline",
    """WITH seen AS (SELECT *, LAG(event_type) OVER (PARTITION BY user_id ORDER BY ts, h) AS before FROM (
           SELECT DISTINCT user_id, event_type, ts, sha256(user_id || '||' || event_type) AS h FROM events)),
       ended AS (SELECT *, LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, h) AS until FROM seen
                 WHERE before IS NULL OR before <> event_type)
       SELECT user_id AS "horizonId", event_type AS "firstName", ts AS "IngestionDate",
              CASE WHEN until = ts THEN until + INTERVAL 1 MICROSECOND ELSE until END AS "ValidTo",
              CASE WHEN until IS NULL THEN 'Y' ELSE 'N' END AS "IsActive" FROM ended""",
)
def h13_inspector_timeline(t: Tables) -> DataFrame:
    """A header that repeats in another case is left out; the load time becomes the start."""
    rows = t.events.select("user_id", "event_type", F.lit("x"), F.col("ts").cast("timestamp"))
    out = H.inspector_timeline(rows.toDF("horizonId", "firstName", "FirstName", "IngestionDate"), at(SNAPSHOT))
    return naive(out.select("horizonId", "firstName", "IngestionDate", "ValidTo", "IsActive"), "IngestionDate", "ValidTo")


def _service_users(t: Tables) -> DataFrame:
    """Customers in four roles, one source each."""
    c = t.customer.withColumn("id", F.col("c_custkey").cast("string"))
    messages = shaped(
        c.filter("c_mktsegment = 'BUILDING'"),
        [u for u in H.USER_COLUMNS if u not in ("serviceUserTypeInternal", "contactMethod")] + ["SourceSystemID"],
        {
            "id": F.col("id"),
            "serviceUserType": F.lit("Appellant"),
            "caseReference": F.lit("C1"),
            "firstname": F.col("c_name"),
            "sourceSuid": F.col("id"),
            "sourceSystem": F.lit("Back Office"),
            **message_book(at("2024-01-01")),
            "ValidTo": F.lit(None).cast("string"),
        },
    )
    role = F.when(F.col("c_acctbal") < 0, "Apellant").when(F.col("c_nationkey") < 5, "Interested").otherwise("Agent")
    involvement = shaped(
        c,
        [
            "ContactId",
            "Title",
            "FirstName",
            "LastName",
            "Address1",
            "Address2",
            "City",
            "County",
            "PostCode",
            "Country",
            "OrganisationName",
            "OrganisationTypeName",
            "TelephoneOffice",
            "TelephoneMobile",
            "Fax",
            "Email",
            "case_number",
            "typeOfInvolvement",
            "expected_from",
        ],
        {"ContactId": F.col("id"), "FirstName": F.col("c_name"), "case_number": F.lit("C1"), "typeOfInvolvement": role, "expected_from": at(SNAPSHOT)},
    )
    applicants = shaped(
        c.filter("c_mktsegment = 'MACHINERY'"),
        [
            "caseNodeId",
            "ApplicantFirstName",
            "ApplicantLastName",
            "AddressLine1",
            "AddressLine2",
            "AddressTown",
            "AddressCounty",
            "PostCode",
            "PromoterName",
            "ApplicantPhoneNumber",
            "ApplicantEmailAddress",
            "ApplicantWebAddress",
            "CaseReference",
            "expected_from",
        ],
        {"caseNodeId": F.col("id"), "ApplicantFirstName": F.col("c_name"), "CaseReference": F.lit("C2"), "expected_from": at(SNAPSHOT)},
    )
    person = [
        "ContactId",
        "FullName",
        "BuildingNumber",
        "Street",
        "Town",
        "County",
        "PostCode",
        "Country",
        "OrganisationName",
        "JobTitle",
        "PhoneNumber",
        "EmailAddress",
    ]
    agent = ["AgentContactId"] + [f"Agent_{x}" for x in person[1:]]
    representation = shaped(
        c.filter("c_mktsegment = 'HOUSEHOLD'"),
        [*person, *agent, "CaseReference", "preferredContactMethod", "expected_from"],
        {
            "ContactId": F.col("id"),
            "BuildingNumber": F.lit("1"),
            "Street": F.lit("High Street"),
            "AgentContactId": F.when(F.col("c_acctbal") < 0, F.concat(F.lit("A"), "id")),
            "CaseReference": F.lit("C3"),
            "preferredContactMethod": F.when(F.col("c_acctbal") < 0, "E-Mail").otherwise("Portal"),
            "expected_from": at(SNAPSHOT),
        },
    )
    return H.service_users(messages, involvement, applicants, representation)


SERVICE_USERS_SQL = """
  WITH rows AS (
    SELECT c_custkey::VARCHAR AS id, 'C1' AS "caseReference", 'Appellant' AS "serviceUserType", 'Appellant' AS "serviceUserTypeInternal",
           NULL AS "contactMethod", NULL AS addressline1, TIMESTAMP '2024-01-01' AS "IngestionDate" FROM customer WHERE c_mktsegment = 'BUILDING'
    UNION ALL SELECT c_custkey::VARCHAR, 'C1', CASE WHEN c_acctbal < 0 THEN 'Appellant' ELSE 'Agent' END,
           CASE WHEN c_acctbal < 0 THEN 'Appellant' ELSE 'Agent' END, NULL, NULL, TIMESTAMP '2024-02-01' FROM customer WHERE c_acctbal < 0 OR c_nationkey >= 5
    UNION ALL SELECT c_custkey::VARCHAR, 'C2', 'Applicant', 'Applicant', NULL, NULL, TIMESTAMP '2024-02-01' FROM customer WHERE c_mktsegment = 'MACHINERY'
    UNION ALL SELECT c_custkey::VARCHAR, 'C3', 'RepresentationContact', 'RepresentationContact_Represented',
           CASE WHEN c_acctbal < 0 THEN 'email' ELSE 'portal' END, '1 High Street', TIMESTAMP '2024-02-01' FROM customer
    WHERE c_mktsegment = 'HOUSEHOLD'
    UNION ALL SELECT 'A' || c_custkey, 'C3', 'RepresentationContact', 'RepresentationContact_Agent', 'email', NULL, TIMESTAMP '2024-02-01'
    FROM customer WHERE c_mktsegment = 'HOUSEHOLD' AND c_acctbal < 0)
  SELECT *, LEAD("IngestionDate") OVER w AS "ValidTo", CASE WHEN LEAD("IngestionDate") OVER w IS NULL THEN 'Y' ELSE 'N' END AS "IsActive"
  FROM rows WINDOW w AS (PARTITION BY id, "caseReference", "serviceUserType" ORDER BY "IngestionDate")
"""


@query("ent_h14_service_users", SERVICE_USERS_SQL)
def h14_service_users(t: Tables) -> DataFrame:
    """Households in debt are represented by an agent."""
    out = _service_users(t).select(
        "id", "caseReference", "serviceUserType", "serviceUserTypeInternal", "contactMethod", "addressline1", "IngestionDate", "ValidTo", "IsActive"
    )
    return naive(out, "IngestionDate", "ValidTo")


# --- harmonised: cases and reference tables ------------------------------------------------------


def _case_group(t: Tables, close_any: bool) -> DataFrame:
    """Finished and open orders as message states, pending ones as legacy states; low orders are the other group."""
    own = t.orders.filter("o_orderpriority <> '5-LOW'")
    messages = own.filter("o_orderstatus <> 'P'").select(
        F.lit(None).cast("long").alias("CaseID"),
        F.col("o_custkey").cast("string").alias("caseReference"),
        F.col("o_orderpriority").alias("caseStatus"),
        F.col("o_orderkey").cast("string").alias("RowID"),
        F.col("o_orderdate").cast("timestamp").alias("IngestionDate"),
        F.lit("ODT").alias("ODTSourceSystem"),
    )
    legacy = own.filter("o_orderstatus = 'P'").select(
        F.col("o_custkey").alias("caseReference"),
        F.col("o_orderpriority").alias("caseStatus"),
        F.lit(None).cast("timestamp").alias("ingested_datetime"),
        F.col("o_orderdate").cast("timestamp").alias("expected_from"),
    )
    other = t.orders.filter("o_orderpriority = '5-LOW'").select(
        F.col("o_custkey").cast("string").alias("caseReference"),
        F.col("o_orderdate").cast("timestamp").alias("IngestionDate"),
        F.lit(None).cast("timestamp").alias("ValidTo"),
        F.lit("Y").alias("IsActive"),
    )
    out = H.case_group(messages, legacy, other, "caseReference", "CaseID", close_any)
    return naive(
        out.select("caseReference", "caseStatus", "ODTSourceSystem", "IngestionDate", "ValidTo", "IsActive", "CaseID"),
        "IngestionDate",
        "ValidTo",
    )


def _case_group_sql(closes: str) -> str:
    return f"""
  WITH staged AS (SELECT DISTINCT o_custkey::VARCHAR AS k, o_orderpriority AS s, o_orderdate AS d,
                    CASE o_orderstatus WHEN 'P' THEN 'HORIZON' ELSE 'ODT' END AS src,
                    CASE o_orderstatus WHEN 'P' THEN '~' ELSE o_orderkey::VARCHAR END AS r,
                    sha256(o_custkey || '||' || o_orderpriority) AS h FROM orders WHERE o_orderpriority <> '5-LOW'),
  once AS (SELECT * FROM staged QUALIFY ROW_NUMBER() OVER (PARTITION BY k, d, src, s ORDER BY r) = 1),
  seen AS (SELECT *, LAG(s) OVER (PARTITION BY k ORDER BY d, CASE src WHEN 'ODT' THEN 0 ELSE 1 END, r, h) AS b FROM once),
  ended AS (SELECT *, LEAD(d) OVER w AS n, ROW_NUMBER() OVER w AS v FROM seen WHERE b IS NULL OR b <> s
            WINDOW w AS (PARTITION BY k ORDER BY d, CASE src WHEN 'ODT' THEN 0 ELSE 1 END, r, h)),
  met AS (SELECT *, CASE WHEN n = d THEN n + INTERVAL 1 MICROSECOND ELSE n END AS until,
            (SELECT MIN(o_orderdate) FROM orders o WHERE o_orderpriority = '5-LOW' AND o.o_custkey::VARCHAR = e.k AND o.o_orderdate > e.d) AS mark
          FROM ended e)
  SELECT k AS "caseReference", s AS "caseStatus", src AS "ODTSourceSystem", d AS "IngestionDate", v AS "CaseID",
         CASE WHEN {closes} THEN mark ELSE until END AS "ValidTo",
         CASE WHEN {closes} OR until IS NOT NULL THEN 'N' ELSE 'Y' END AS "IsActive" FROM met"""


@query("ent_h15_case_group", _case_group_sql("until IS NULL AND mark IS NOT NULL"))
def h15_case_group(t: Tables) -> DataFrame:
    return _case_group(t, close_any=False)


@query("ent_h16_case_group_any", _case_group_sql("mark < COALESCE(until, TIMESTAMP '9999-01-01')"))
def h16_case_group_any(t: Tables) -> DataFrame:
    """The other family brings any later end forward."""
    return _case_group(t, close_any=True)


@query(
    "ent_h17_case_events",
    ranked_sql(
        """SELECT event_id::VARCHAR AS "eventId", event_type AS "eventName", 'ODT' AS "ODTSourceSystem", ts AS "IngestionDate"
           FROM events WHERE event_type <> 'error'
           UNION ALL SELECT event_id::VARCHAR, event_type, 'Horizon', TIMESTAMP '2030-02-01' FROM events WHERE event_type IN ('error', 'click')""",
        '"eventId"',
        "SELECT event_id::VARCHAR FROM events WHERE event_type <> 'error'",
        "AppealsEventId",
    ),
)
def h17_case_events(t: Tables) -> DataFrame:
    rows = t.events.select(F.col("event_id").cast("string").alias("eventId"), F.col("event_type").alias("eventName"), "ts")
    messages = rows.filter("eventName <> 'error'").select(
        "eventId", "eventName", *[c.alias(n) for n, c in message_book(F.col("ts").cast("timestamp")).items()]
    )
    legacy = rows.filter("eventName IN ('error', 'click')").select("eventId", "eventName", at("2030-02-01").alias("expected_from"))
    older = legacy.withColumn("expected_from", at("2029-01-01"))
    ids = ["AppealsEventId", "eventId", "eventName", "Migrated", "IngestionDate"]
    out = H.case_events(messages, legacy.unionByName(older), ids)
    return naive(
        out.select("eventId", "eventName", "ODTSourceSystem", "IngestionDate", "AppealsEventId", "ValidTo", "IsActive", "Migrated"),
        "IngestionDate",
        "ValidTo",
    )


def _listed(t: Tables, rows: DataFrame, name: Column) -> DataFrame:
    return shaped(
        rows,
        list(H.LISTED_BUILDING),
        {"entity": F.col("p_partkey").cast("string"), "reference": F.col("p_brand"), "name": name, "dataset": F.lit("listed")},
    )


def _listed_history(t: Tables) -> tuple[DataFrame, DataFrame]:
    before = H.listed_buildings(_listed(t, t.part.filter("p_size <= 25"), F.lower("p_type")), None, at("2024-01-01"))
    name = F.when(F.col("p_type") == "ECONOMY", F.lit("renamed")).otherwise(F.lower("p_type"))
    current = before.withColumn("validTo", F.col("validTo").cast("timestamp"))
    return current, H.listed_buildings(_listed(t, t.part, name), current, at(SNAPSHOT))


@query(
    "ent_h18_listed_buildings",
    """SELECT p_partkey::VARCHAR AS entity, lower(p_type) AS name, TIMESTAMP '2024-01-01' AS "dateReceived",
              CASE WHEN p_type = 'ECONOMY' THEN TIMESTAMP '2024-02-01' END AS "validTo",
              CASE WHEN p_type = 'ECONOMY' THEN 'N' ELSE 'Y' END AS "isActive" FROM part WHERE p_size <= 25
       UNION ALL SELECT p_partkey::VARCHAR, CASE WHEN p_type = 'ECONOMY' THEN 'renamed' ELSE lower(p_type) END,
              TIMESTAMP '2024-02-01', NULL, 'Y' FROM part WHERE p_size > 25 OR p_type = 'ECONOMY'""",
)
def h18_listed_buildings(t: Tables) -> DataFrame:
    out = _listed_history(t)[1].select("entity", "name", "dateReceived", "validTo", "isActive")
    return naive(out, "dateReceived", "validTo")


@query(
    "ent_h18_listed_building_counts",
    """SELECT COUNT(*) FILTER (p_brand NOT IN (SELECT p_brand FROM part WHERE p_size <= 25)) AS insert_count,
              COUNT(*) FILTER (p_brand IN (SELECT p_brand FROM part WHERE p_size <= 25)) AS update_count
       FROM part WHERE p_size > 25 OR p_type = 'ECONOMY'""",
)
def h18_listed_building_counts(t: Tables) -> DataFrame:
    return H.listed_building_counts(*_listed_history(t))


def _matrix(t: Tables) -> DataFrame:
    rows = t.part.select(F.concat(F.lit(" "), F.upper("p_name"), F.lit(" ")).alias("attribute"), F.col("p_partkey").cast("string").alias("appealReference"))
    return H.attribute_matrix(rows, at(SNAPSHOT))


@query(
    "ent_h19_attribute_matrix",
    """SELECT lower(p_name) AS attribute, p_partkey::VARCHAR AS "appealReference", sha256('{"attribute":"' || lower(p_name) || '"}') AS "TEMP_PK",
              'AppealAttributeMatrix' AS "ODTSourceSystem", 'Y' AS "IsActive", TIMESTAMP '2024-02-01' AS "IngestionDate" FROM part""",
)
def h19_attribute_matrix(t: Tables) -> DataFrame:
    return naive(_matrix(t), "IngestionDate")


# --- curated -------------------------------------------------------------------------------------


@query(
    "ent_c1_appeal_documents",
    """SELECT DISTINCT CAST(doc_id AS VARCHAR) AS "documentId", source AS filename, 'W' AS "caseType", '' AS mime FROM documents""",
)
def c1_appeal_documents(t: Tables) -> DataFrame:
    return C.appeal_documents(_appeal_documents(t)).select("documentId", "filename", "caseType", "mime")


@query(
    "ent_c1_project_documents",
    f"""SELECT "documentId", filename, "caseRef", CASE "ODTSourceSystem" WHEN 'ODT' THEN 'unpublished' ELSE 'ready_to_publish' END
               AS "publishedStatus", CASE "ODTSourceSystem" WHEN 'ODT' THEN 'big case' END AS "caseType"
        FROM ({PROJECT_DOCUMENTS_SQL}) WHERE "IsActive" = 'Y'""",
)
def c1_project_documents(t: Tables) -> DataFrame:
    out = C.project_documents(_project_documents(t))
    return out.select("documentId", "filename", "caseRef", "publishedStatus", "caseType")


@query(
    "ent_c1_projects",
    f"""SELECT "caseId"::INTEGER AS "caseId", "caseReference", lower(o_orderstatus) AS stage,
               CASE WHEN invoice IS NULL THEN 'back-office-applications' ELSE 'horizon' END AS "sourceSystem"
        FROM ({PROJECTS_SQL}) JOIN orders ON o_orderkey::VARCHAR = "caseReference" WHERE "IsActive" = 'Y'""",
)
def c1_projects(t: Tables) -> DataFrame:
    rows = _project_versions(t)
    for c in ("publishStatus", "projectType", "easting", "northing", "rule8LetterPublishDate"):
        rows = rows.withColumn(c, F.lit(None).cast("string"))
    return C.projects(rows).select("caseId", "caseReference", "stage", "sourceSystem")


@query(
    "ent_c2_representations",
    """SELECT o_orderkey::INTEGER AS "representationId", CASE WHEN l THEN 'awaiting_review' ELSE 'valid' END AS status,
              CASE WHEN l THEN 'PERSON' END AS "representationFrom", CASE WHEN l THEN 'PERSON' END AS "registerFor", '' AS "originalRepresentation"
       FROM (SELECT *, o_orderkey IN (SELECT l_orderkey FROM lineitem) AS l FROM orders) WHERE l OR o_orderpriority = '1-URGENT'""",
)
def c2_representations(t: Tables) -> DataFrame:
    out = C.representations(_representations(t))
    return out.select("representationId", "status", "representationFrom", "registerFor", "originalRepresentation")


@query(
    "ent_c2_advice",
    """SELECT o_orderkey::INTEGER AS "adviceId", 'unchecked' AS status, 'phone' AS method, NULL AS agent, o_custkey::INTEGER AS "caseId"
       FROM orders WHERE o_orderstatus <> 'F'""",
)
def c2_advice(t: Tables) -> DataFrame:
    return C.advice(_advice(t)).select("adviceId", "status", "method", "agent", "caseId")


@query(
    "ent_c2_exam_timetable",
    """SELECT o_custkey::VARCHAR AS "caseReference", MAX(o_orderkey)::INTEGER AS "eventId" FROM orders
       WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) GROUP BY o_custkey""",
)
def c2_exam_timetable(t: Tables) -> DataFrame:
    projects = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").cast("string").alias("caseReference"))
    return C.exam_timetable(_timetable(t), projects).select("caseReference", "eventId")


@query("ent_c3_meetings", f"""SELECT "caseId", "meetingId", "meetingAgenda" FROM ({MEETINGS_SQL}) WHERE "IsActive" = 'Y'""")
def c3_meetings(t: Tables) -> DataFrame:
    return C.meetings(_meetings(t)).select("caseId", "meetingId", "meetingAgenda")


@query(
    "ent_c3_invoices",
    f"""SELECT DISTINCT "caseId", invoice AS "invoiceNumber" FROM ({PROJECTS_SQL}) WHERE invoice IS NOT NULL""",
)
def c3_invoices(t: Tables) -> DataFrame:
    return C.invoices(_invoices(t)).select("caseId", "invoiceNumber")


def _flagged_events(t: Tables) -> DataFrame:
    """Events as history rows; errors are past rows, signups came from the legacy system before 1900."""
    return t.events.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("user_id").cast("string").alias("caseReference"),
        F.col("event_type").alias("sittingTime"),
        F.when(F.col("event_type") == "signup", "Horizon").otherwise("ODT").alias("ODTSourceSystem"),
        F.when(F.col("event_type") == "view", at("1899-12-31")).otherwise(F.col("ts").cast("timestamp")).alias("IngestionDate"),
        F.lit(None).cast("timestamp").alias("ValidTo"),
        F.when(F.col("event_type") == "error", "N").otherwise("Y").alias("IsActive"),
    )


@query(
    "ent_c3_subscriptions",
    """SELECT DISTINCT user_id::VARCHAR AS "caseReference", event_type AS "subscriptionType" FROM events WHERE event_type <> 'error'""",
)
def c3_subscriptions(t: Tables) -> DataFrame:
    rows = _flagged_events(t).withColumnRenamed("sittingTime", "subscriptionType")
    return C.subscriptions(rows).select("caseReference", "subscriptionType").distinct()


@query(
    "ent_c4_event_estimates",
    """SELECT event_id::VARCHAR AS id, user_id::VARCHAR AS "caseReference", NULL AS "preparationTime", event_type AS "sittingTime",
              NULL AS "reportingTime" FROM events WHERE event_type <> 'error'""",
)
def c4_event_estimates(t: Tables) -> DataFrame:
    return C.event_estimates(_flagged_events(t))


@query(
    "ent_c4_event_estimates_reporting",
    """SELECT event_id::VARCHAR AS id, CAST(timezone('Europe/London', timezone('UTC', ts)) AS TIMESTAMP) AS "IngestionDate"
       FROM events WHERE event_type NOT IN ('signup', 'view')""",
)
def c4_event_estimates_reporting(t: Tables) -> DataFrame:
    out = C.reporting_copy(_flagged_events(t), ["id", "IngestionDate", "ValidTo"], "ODT")
    return naive(out.select("id", "IngestionDate"), "IngestionDate")


@query(
    "ent_c5_appeal_representations",
    """SELECT event_id::VARCHAR AS "representationId", user_id::VARCHAR AS "caseReference", event_type AS source FROM events
       WHERE event_type <> 'error'""",
)
def c5_appeal_representations(t: Tables) -> DataFrame:
    rows = _flagged_events(t).withColumnsRenamed({"id": "representationId", "sittingTime": "source"})
    return C.appeal_representations(rows).select("representationId", "caseReference", "source")


@query(
    "ent_c6_inspectors",
    f"""SELECT "sapId", title, CASE WHEN "firstName" = 'BUILDING' THEN 'update' ELSE 'create' END AS action
        FROM ({HR_SQL}) WHERE "firstName" IN ('BUILDING', 'MACHINERY')""",
)
def c6_inspectors(t: Tables) -> DataFrame:
    """Builders had another title, machinists were not curated yet, all others did not change."""
    rows = _hr_inspectors(t).withColumns({"entraId": F.col("sapId")})
    title = F.when(F.col("firstName") == "BUILDING", F.lit("old")).otherwise(F.col("title"))
    curated = rows.filter("firstName <> 'MACHINERY'").select(*C.INSPECTOR).withColumn("title", title)
    return C.inspector_changes(rows, curated, "action").select("sapId", "title", "action")


@query(
    "ent_c7_case_group",
    f"""SELECT "caseReference", "caseStatus", NULL AS "decisionDate" FROM ({_case_group_sql("until IS NULL AND mark IS NOT NULL")}) WHERE "IsActive" = 'Y'""",
)
def c7_case_group(t: Tables) -> DataFrame:
    return C.active_rows(_case_group(t, False), ["caseReference", "caseStatus", "decisionDate"])


@query(
    "ent_c8_case_group_reporting",
    f"""SELECT DISTINCT "caseReference", "caseStatus", "IngestionDate" FROM ({_case_group_sql("mark < COALESCE(until, TIMESTAMP '9999-01-01')")})
        WHERE "ODTSourceSystem" = 'ODT' """,
)
def c8_case_group_reporting(t: Tables) -> DataFrame:
    rows = _case_group(t, True)
    return C.reporting_copy(rows, ["caseReference", "caseStatus", "IngestionDate"], "ODT", local=False)


def _api_inputs(t: Tables) -> tuple[list[DataFrame], DataFrame, DataFrame, DataFrame, DataFrame]:
    """Orders as two case groups, nations as authorities, customers as users, events as events, suppliers as officers."""
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("caseId"),
        F.col("o_custkey").cast("string").alias("caseReference"),
        F.col("c_nationkey").cast("string").alias("lpaCode"),
        F.concat("o_orderstatus", F.lit(" . ")).alias("applicationReference"),
        F.when(F.col("o_orderstatus") == "F", "T").when(F.col("o_orderstatus") == "O", "0").otherwise("maybe").alias("isCorrectAppealType"),
        F.col("c_nationkey").cast("string").alias("inspectorId"),
        F.substring("o_orderpriority", 1, 1).alias("caseOfficerId"),
        F.lit("Y").alias("IsActive"),
        "o_orderpriority",
        F.col("o_orderdate").alias("IngestionDate"),
    )
    groups = [rows.filter("o_orderpriority < '3'"), rows.filter("o_orderpriority >= '3'")]
    authorities = t.nation.select(F.col("n_nationkey").cast("string").alias("lpaCode"), F.col("n_name").alias("lpaName"), F.when(F.col("n_regionkey") == 0, "N").otherwise("Y").alias("IsActive"))
    users = t.customer.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_custkey").cast("string").alias("caseReference"),
        F.col("c_name").alias("firstName"),
        F.lit("x").alias("lastName"),
        F.when(F.col("c_acctbal") < 0, "Agent").otherwise("Appellant").alias("serviceUserType"),
        F.lit("Y").alias("IsActive"),
    )
    events = t.events.select(
        F.col("user_id").cast("string").alias("caseReference"), F.col("event_id").alias("eventId"), F.col("event_type").alias("eventType"), F.lit("Y").alias("IsActive")
    )
    directory = t.supplier.select(
        F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("givenName"), F.lit("x").alias("surname"), F.lit("Y").alias("IsActive")
    )
    return groups, authorities, users, events, directory


@query(
    "ent_c9_case_api",
    """WITH rows AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey)
       SELECT o_custkey::VARCHAR AS "caseReference", o_orderstatus AS "applicationReference", o_orderkey AS "caseId",
              CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN 'false' END AS correct, CASE WHEN n_regionkey <> 0 THEN n_name END AS "lpaName",
              CASE WHEN c_acctbal >= 0 THEN c_name END AS "appellantFirstName", e AS "eventId", s.s_name AS "inspectorFirstName",
              o.s_name AS "caseOfficerFirstName"
       FROM (SELECT * FROM rows QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) = 1)
       LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN (SELECT user_id, MIN(event_id) AS e FROM events GROUP BY 1) ON user_id = o_custkey
       LEFT JOIN supplier s ON s.s_suppkey = c_nationkey LEFT JOIN supplier o ON o.s_suppkey = CAST(substr(o_orderpriority, 1, 1) AS INTEGER)""",
)
def c9_case_api(t: Tables) -> DataFrame:
    out = C.case_api(*_api_inputs(t), ["isCorrectAppealType"])
    return out.select(
        "caseReference", "applicationReference", "caseId", F.col("isCorrectAppealType").cast("string").alias("correct"), "lpaName",
        "appellantFirstName", "eventId", "inspectorFirstName", "caseOfficerFirstName",
    )


USERS_ACTIVE_SQL = f"""SELECT * FROM ({SERVICE_USERS_SQL}) WHERE "IsActive" = 'Y' """


@query(
    "ent_c10_service_users",
    f"""SELECT id, "serviceUserType", "caseReference" FROM ({USERS_ACTIVE_SQL}) WHERE "serviceUserType" = 'Appellant'""",
)
def c10_service_users(t: Tables) -> DataFrame:
    return C.service_users(_service_users(t), ["id", "serviceUserType", "caseReference"])


@query(
    "ent_c10_service_users_reporting",
    """SELECT DISTINCT event_id::VARCHAR AS id, user_id::VARCHAR AS "caseReference" FROM events WHERE event_type <> 'view'""",
)
def c10_service_users_reporting(t: Tables) -> DataFrame:
    """Both tables deliver the same users, so each counts once."""
    rows = _flagged_events(t).withColumn("ValidTo", F.col("ValidTo").cast("string"))
    cols = ["id", "caseReference", "IngestionDate", "ValidTo"]
    return C.service_users_reporting(rows, rows, cols).select("id", "caseReference")


@query(
    "ent_c11_directory_users",
    """SELECT c_custkey::VARCHAR AS id, c_mktsegment AS "givenName" FROM customer""",
)
def c11_directory_users(t: Tables) -> DataFrame:
    return C.active_rows(_directory(t), ["id", "givenName"])


@query(
    "ent_c12_folders",
    """SELECT DISTINCT doc_id::VARCHAR AS id, CASE lang WHEN 'en' THEN 'post_decision' ELSE lower(source) END AS "caseStage" FROM documents""",
)
def c12_folders(t: Tables) -> DataFrame:
    stage = F.when(F.col("lang") == "en", "Post decision").otherwise(F.upper("source"))
    rows = t.documents.select(F.col("doc_id").cast("string").alias("id"), stage.alias("caseStage"), F.lit("Y").alias("IsActive"))
    return C.folders(rows, ["id", "caseStage"])


@query(
    "ent_c13_listed_buildings",
    """SELECT p_partkey::VARCHAR AS entity, CASE WHEN p_type = 'ECONOMY' THEN 'renamed' ELSE lower(p_type) END AS name FROM part""",
)
def c13_listed_buildings(t: Tables) -> DataFrame:
    before, after = _listed_history(t)
    curated = before.select("entity", "name", "reference")
    return C.listed_buildings(after, curated).select("entity", "name")


@query(
    "ent_c13_attribute_matrix",
    """SELECT lower(p_name) AS attribute, p_partkey::VARCHAR AS "appealReference", NULL AS s78 FROM part""",
)
def c13_attribute_matrix(t: Tables) -> DataFrame:
    out = C.attribute_matrix(_matrix(t), ["attribute", "appealReference", "s78"])
    return out.select("attribute", "appealReference", "s78")


@query(
    "ent_c13_case_events",
    """SELECT event_id::VARCHAR AS "eventId", event_type AS "eventName" FROM events""",
)
def c13_case_events(t: Tables) -> DataFrame:
    rows = t.events.select(F.col("event_id").cast("string").alias("eventId"), F.col("event_type").alias("eventName"), F.lit("Y").alias("IsActive"))
    return C.active_rows(rows, ["eventId", "eventName"])


# --- views ---------------------------------------------------------------------------------------


@query(
    "ent_v1_case_view",
    """WITH rows AS (SELECT *, CASE WHEN o_orderpriority < '3' THEN 1 ELSE 2 END AS p FROM orders JOIN customer ON o_custkey = c_custkey),
       chosen AS (SELECT * FROM rows QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY p, o_orderdate DESC, o_orderkey DESC) = 1)
       SELECT o_custkey::VARCHAR AS "caseReference", o_orderkey AS "caseId", event, s.s_name AS "inspectorFirstName", o.s_name AS "caseOfficerFirstName"
       FROM chosen LEFT JOIN (SELECT user_id, '[' || string_agg('{"eventId":' || event_id || ',"eventType":"' || event_type || '"}', ',' ORDER BY event_id)
                              || ']' AS event FROM events GROUP BY user_id) ON user_id = o_custkey
       LEFT JOIN supplier s ON s.s_suppkey = c_nationkey LEFT JOIN supplier o ON o.s_suppkey = CAST(substr(o_orderpriority, 1, 1) AS INTEGER)""",
)
def v1_case_view(t: Tables) -> DataFrame:
    groups, _, _, events, directory = _api_inputs(t)
    people = directory.select(F.col("id").alias("entraId"), F.col("givenName").alias("firstName"), F.col("surname").alias("lastName"))
    dated = {
        i + 1: g.withColumn("IngestionDate", F.struct("IngestionDate", "caseId")).drop("o_orderpriority") for i, g in enumerate(groups)
    }
    out = C.case_view(dated, events, people, ["eventId", "eventType"])
    return out.select("caseReference", "caseId", "event", "inspectorFirstName", "caseOfficerFirstName")


@query(
    "ent_v1_case_view_parts",
    """WITH rows AS (SELECT *, CASE WHEN o_orderpriority < '3' THEN 1 ELSE 2 END AS p FROM orders JOIN customer ON o_custkey = c_custkey),
       chosen AS (SELECT * FROM rows QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY p, o_orderdate DESC, o_orderkey DESC) = 1),
       e AS (SELECT *, CASE WHEN event_id % 3 = 0 THEN (SELECT min(o_custkey) FROM orders) ELSE user_id END AS k FROM events),
       n AS (SELECT *, (ROW_NUMBER() OVER (PARTITION BY k ORDER BY event_id) - 1) // 50 + 1 AS part, ceil(COUNT(*) OVER (PARTITION BY k) / 50)::BIGINT AS parts FROM e),
       j AS (SELECT k, part, parts, '[' || string_agg('{"eventId":' || event_id || ',"eventType":"' || event_type || '"}', ',' ORDER BY event_id) || ']' AS event
             FROM n GROUP BY ALL)
       SELECT o_custkey::VARCHAR AS "caseReference", o_orderkey AS "caseId", coalesce(part, 1) AS part, coalesce(parts, 1) AS parts, event, s.s_name AS "inspectorFirstName"
       FROM chosen LEFT JOIN j ON k = o_custkey LEFT JOIN supplier s ON s.s_suppkey = c_nationkey""",
)
def v1_case_view_parts(t: Tables) -> DataFrame:
    """A third of all events belong to one case; no text holds more than fifty of them."""
    groups, _, _, events, directory = _api_inputs(t)
    hot = t.orders.agg(F.min("o_custkey").cast("string")).scalar()
    events = events.withColumn("caseReference", F.when(F.col("eventId") % 3 == 0, hot).otherwise(F.col("caseReference")))
    people = directory.select(F.col("id").alias("entraId"), F.col("givenName").alias("firstName"), F.col("surname").alias("lastName"))
    dated = {
        i + 1: g.withColumn("IngestionDate", F.struct("IngestionDate", "caseId")).drop("o_orderpriority") for i, g in enumerate(groups)
    }
    out = C.case_view(dated, events, people, ["eventId", "eventType"], part_size=50)
    return out.select("caseReference", "caseId", "part", "parts", "event", "inspectorFirstName")


@query(
    "ent_v2_sickness_pivot",
    """SELECT user_id, NULLIF(COUNT(*) FILTER (event_type = 'error'), 0) AS error, NULLIF(COUNT(*) FILTER (event_type = 'click'), 0) AS click
       FROM events GROUP BY user_id""",
)
def v2_sickness_pivot(t: Tables) -> DataFrame:
    return C.sickness_pivot(t.events, "user_id", F.col("event_type"), ["error", "click"])


@query(
    "ent_v3_user_report",
    """SELECT c_name AS "firstName", c_mktsegment AS "lastName" FROM customer ORDER BY c_mktsegment, c_name DESC LIMIT 10""",
)
def v3_user_report(t: Tables) -> DataFrame:
    """The report shows ten users."""
    rows = t.customer.select(F.col("c_name").alias("firstName"), F.col("c_mktsegment").alias("lastName"))
    return rows.orderBy("lastName", F.desc("firstName")).limit(10)
