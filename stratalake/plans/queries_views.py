"""Queries for the reporting views and staff measures, over source tables derived from the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.operators import spells
from stratalake.plans import views as V
from stratalake.plans.registry import Tables, query
from stratalake.session import materialise


def _filled(df: DataFrame, columns, **values) -> DataFrame:
    """The columns a view reads; those without a value hold their own name."""
    return df.select(*[values.get(c, F.lit(c)).alias(c) for c in dict.fromkeys(columns)])


@query(
    "ent_v3_document_metadata",
    """SELECT doc_id AS "documentId", lang AS "caseReference", lang AS "documentReference", source AS filename, source AS "originalFilename",
              'NULL' AS mime, n_chars AS size, 'ParentID' AS "horizonFolderId", 'NULL' AS "transcriptId" FROM documents WHERE n_chars % 2 = 0""",
)
def document_metadata(t: Tables) -> DataFrame:
    active = F.when(F.col("n_chars") % 2 == 0, "Y").otherwise("N")
    rows = _filled(
        t.documents, [*filter(None, V.DOCUMENT_METADATA.values()), "IsActive"], DataId=F.col("doc_id"), documentReference=F.col("lang"), Name=F.col("source"),
        DataSize=F.col("n_chars"), IsActive=active,
    )
    return V.document_metadata(rows).select("documentId", "caseReference", "documentReference", "filename", "originalFilename", "mime", "size", "horizonFolderId", "transcriptId")


def _involvements(t: Tables) -> DataFrame:
    """Customers, once for each of their orders."""
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return _filled(
        rows, [*V.SERVICE_USER.values(), *V.SERVICE_USER_SOURCE.values(), "Migrated", "IsActive"], FirstName=F.col("c_name"), LastName=F.col("c_mktsegment"),
        Postcode=F.col("c_nationkey").cast("string"), Role=F.col("o_orderstatus"), CaseReference=F.col("o_orderkey") % 10, Migrated=(F.col("o_orderkey") % 2).cast("int"),
        EmailAddress=F.col("o_orderkey").cast("string"), IsActive=F.when(F.col("o_orderstatus") == "P", "N").otherwise("Y"),
    )


@query(
    "ent_v3_service_users",
    """SELECT DISTINCT 'Salutation' AS salutation, c_name AS "firstName", c_mktsegment AS "lastName", c_nationkey::VARCHAR AS postcode,
              o_orderstatus AS "serviceUserType", o_orderkey % 10 AS "caseReference"
       FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P'""",
)
def service_users(t: Tables) -> DataFrame:
    return V.service_users(_involvements(t)).select("salutation", "firstName", "lastName", "postcode", "serviceUserType", "caseReference")


@query(
    "ent_v3_source_service_users",
    """SELECT c_name AS "firstName", o_orderkey::VARCHAR AS "emailAddress", 'ODTSourceSystem' AS "dataSource",
              CASE WHEN o_orderkey % 2 = 0 THEN 'NO' ELSE 'YES' END AS migrated
       FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P'""",
)
def source_service_users(t: Tables) -> DataFrame:
    return V.source_service_users(_involvements(t), rows=None).select("firstName", "emailAddress", "dataSource", "migrated")


@query("ent_v3_genders", "SELECT DISTINCT CASE WHEN event_type <> 'error' THEN event_type END AS \"Gender\" FROM events")
def genders(t: Tables) -> DataFrame:
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    return V.genders(t.events.select(kind.alias("sex")), "sex")


@query(
    "ent_v3_listed_buildings",
    """SELECT DISTINCT p_brand AS "ListedBuildingName", p_size AS "ListedBuildingNumber", 'ListedBuildingGrade' AS "ListedBuildingGrade" FROM part""",
)
def listed_buildings(t: Tables) -> DataFrame:
    rows = _filled(t.part, V.LISTED_BUILDING, ListedBuildingName=F.col("p_brand"), ListedBuildingNumber=F.col("p_size"))
    return V.listed_buildings(rows).select("ListedBuildingName", "ListedBuildingNumber", "ListedBuildingGrade")


@query(
    "ent_v3_information_entities",
    """SELECT CASE WHEN p_size <= 25 THEN p_partkey::VARCHAR ELSE 'old ' || p_size END AS entity_id, p_name AS entity_name, 'IMSEntityStatus' AS status
       FROM part WHERE p_partkey % 3 > 0""",
)
def information_entities(t: Tables) -> DataFrame:
    old = F.when(F.col("p_size") <= 25, V.NO_OLD_NUMBER).otherwise(F.concat(F.lit("old "), "p_size"))
    rows = _filled(
        t.part, [*V.INFORMATION_ENTITY.values(), "BDCIDLegacy", "IMSEntityID", "IsActive"], BDCIDLegacy=old, IMSEntityID=F.col("p_partkey").cast("string"),
        IMSEntityName=F.col("p_name"), IsActive=F.when(F.col("p_partkey") % 3 > 0, "Y").otherwise("N"),
    )
    return V.information_entities(rows).select("entity_id", "entity_name", "status")


# --- staff ---------------------------------------------------------------------------------------


@query(
    "ent_v2_staff_hierarchy",
    """WITH RECURSIVE s AS (SELECT c_custkey AS p, CASE WHEN c_custkey % 97 = 5 THEN c_custkey WHEN c_custkey > 5 THEN c_custkey // 3
                                 WHEN c_custkey = 3 THEN 999999999 END AS m FROM customer),
            w AS (SELECT p, m, 0::BIGINT AS level, p::VARCHAR AS top, p::VARCHAR AS chain FROM s WHERE m IS NULL OR m NOT IN (SELECT p FROM s)
                  UNION ALL SELECT s.p, s.m, w.level + 1, w.top, w.chain || '/' || s.p FROM s JOIN w ON s.m = w.p)
       SELECT s.p::VARCHAR AS person, s.m::VARCHAR AS manager, w.level, w.top, w.chain, w.p IS NULL AS cyclic FROM s LEFT JOIN w ON s.p = w.p""",
)
def staff_hierarchy(t: Tables) -> DataFrame:
    """Customers as staff: a tree of three reports each, some who report to themselves, one whose manager is unknown."""
    key = F.col("c_custkey")
    manager = F.when(key % 97 == 5, key).when(key > 5, F.floor(key / 3)).when(key == 3, F.lit(999999999))
    return spells.reporting_lines(t.customer.select(key.alias("person"), manager.alias("manager")), "person", "manager")


def _absences(t: Tables) -> DataFrame:
    """Orders as absences of up to forty days; a few have no end."""
    day = F.col("o_orderdate").cast("date")
    end = F.when(F.col("o_orderkey") % 501 > 0, F.date_add(day, (F.col("o_orderkey") % 40).cast("int")))
    return t.orders.select(F.col("o_custkey").alias("person"), day.alias("from"), end.alias("to"))


SPELLS_SQL = """
  SELECT person, min("from") AS "from", nullif(max("to"), DATE '9999-12-31') AS "to", count(*) AS spells FROM (
    SELECT *, sum(CASE WHEN reach IS NULL OR "from" - reach > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY person ORDER BY "from", "to" ROWS UNBOUNDED PRECEDING) AS g FROM (
      SELECT *, max("to") OVER (PARTITION BY person ORDER BY "from", "to" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM (
        SELECT o_custkey AS person, CAST(o_orderdate AS DATE) AS "from",
               CASE WHEN o_orderkey % 501 > 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INTEGER) ELSE DATE '9999-12-31' END AS "to" FROM orders)))
  GROUP BY person, g
"""


@query("ent_v2_absence_spells", SPELLS_SQL)
def absence_spells(t: Tables) -> DataFrame:
    return spells.merge_spells(_absences(t), ["person"], "from", "to")


@query(
    "ent_v2_absence_days",
    f"""WITH s AS ({SPELLS_SQL}), h AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE day(o_orderdate) = 25),
             c AS (SELECT d, sum(CASE WHEN isodow(d) < 6 AND d NOT IN (SELECT d FROM h) THEN 1 ELSE 0 END) OVER (ORDER BY d) AS n
                   FROM (SELECT CAST(unnest(generate_series((SELECT min("from") - 1 FROM s)::TIMESTAMP, (SELECT max("to") FROM s)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS d))
        SELECT person, "from", "to", (a.n - b.n)::BIGINT AS days FROM s LEFT JOIN c a ON a.d = "to" LEFT JOIN c b ON b.d = "from" - 1""",
)
def absence_days(t: Tables) -> DataFrame:
    """Working days of merged absences; the 25th is free where there is an order on it."""
    merged = materialise(absence_spells(t), "absences")
    days = merged.select(F.explode(F.array("from", "to")).alias("date"))
    free = t.orders.filter(F.dayofmonth("o_orderdate") == 25).select(F.col("o_orderdate").cast("date").alias("date"))
    out = spells.add_working_days(merged, "from", "to", spells.calendar(days, free), "days")
    return out.select("person", "from", "to", "days")


@query(
    "ent_v2_leavers",
    """WITH p AS (SELECT o_custkey AS person, min(CAST(o_orderdate AS DATE)) AS started, max(CAST(o_orderdate AS DATE)) AS last FROM orders GROUP BY 1),
            l AS (SELECT *, CASE WHEN last < DATE '1998-01-01' THEN last END AS gone FROM p),
            m AS (SELECT CAST(unnest(generate_series((SELECT date_trunc('month', min(started)) FROM l)::TIMESTAMP, TIMESTAMP '1998-12-01', INTERVAL 1 MONTH)) AS DATE) AS month)
       SELECT month, (SELECT count(*) FROM l WHERE date_trunc('month', started) = month) AS starters, (SELECT count(*) FROM l WHERE date_trunc('month', gone) = month) AS leavers,
              (SELECT count(*) FROM l WHERE started < month + INTERVAL 1 MONTH AND (gone IS NULL OR gone >= month + INTERVAL 1 MONTH)) AS headcount FROM m""",
)
def leavers(t: Tables) -> DataFrame:
    """Customers as staff from their first order; those without an order since 1998 left at their last."""
    day = F.col("o_orderdate").cast("date")
    people = t.orders.groupBy(F.col("o_custkey").alias("person")).agg(F.min(day).alias("started"), F.max(day).alias("last"))
    people = people.withColumn("gone", F.when(F.col("last") < "1998-01-01", F.col("last")))
    return spells.staff_movements(people, "started", "gone", "1998-12-01")
