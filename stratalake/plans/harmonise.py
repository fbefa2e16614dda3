"""Standardised tables to versioned histories, as compositions of the operators.

Each function takes the tables an entity is made of and returns the new state of its history. Source rows are
expected under the column names of the message schemas.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions import text
from stratalake.functions.contract import (
    ACTIVE,
    DIRECTORY_SOURCE,
    HISTORY,

    LEGACY_SOURCE,
    LEGACY_TIMELINE_SOURCE,
    MESSAGE_SOURCE,
    HistoryColumns,
)
from stratalake.functions.keys import as_columns, composite_key, incremental_key, named, row_id, row_id_ws
from stratalake.functions.temporal import iso_midnight, minute_text
from stratalake.functions.types import nullable
from stratalake.operators import conform, history, joins, latest, merge, nested
from stratalake.operators.ingest import new_messages
from stratalake.session import materialise

TIE = "_tie"


# --- shared shape: two sources, one rank history --------------------------------------------------


def legacy_bookkeeping(loaded: Column) -> dict[str, Column]:
    """Bookkeeping columns of a row that comes from the legacy system."""
    return {
        "Migrated": F.lit("0"),
        "ODTSourceSystem": F.lit(LEGACY_SOURCE),
        "SourceSystemID": F.lit(None).cast("string"),
        "IngestionDate": loaded.cast("timestamp"),
        "ValidTo": F.lit(None).cast("string"),
        "RowID": F.lit(""),
        "IsActive": F.lit(ACTIVE),
    }


def versions_of(
    rows: DataFrame,
    key: str,
    id_name: str,
    row_id_cols: Sequence[str] | None,
    known: DataFrame | None = None,
    hash_first: bool = False,
    row_id_of=row_id,
) -> DataFrame:
    """Rank history of one or two sources. ``known`` holds the keys the message source has.

    ``hash_first`` keeps row ids that were made before ids, ends and flags were set. Rows come in without copies;
    with an id on every row a later duplicate check could find nothing. They are written once, since the history
    looks at them several times, column by column.
    """
    rows = rows.withColumn("IngestionDate", named("IngestionDate").cast("timestamp"))
    if hash_first and row_id_cols is not None:
        rows = rows.withColumn("RowID", row_id_of(row_id_cols))
    staged = materialise(rows.withColumn(TIE, F.xxhash64(*as_columns(rows.columns))), "staged")
    out = history.rank_history(
        staged,
        [key],
        [TIE],
        id_name=id_name,
        existence=None if known is None else (known, {key: key}),
    ).drop(TIE)
    if not hash_first and row_id_cols is not None:
        out = out.withColumn("RowID", row_id_of(row_id_cols))
    return out


def _union(messages: DataFrame, legacy: DataFrame) -> DataFrame:
    """Message rows and legacy rows in the columns of the message rows."""
    types = {f.name: nullable(f.dataType) for f in messages.schema.fields}
    # Distinct over the columns there are: the others are null in every row, but each would widen the rows compared.
    once = legacy.select(*[named(c).try_cast(t).alias(c) for c, t in types.items() if c in legacy.columns]).distinct()
    aligned = once.select(*[named(c) if c in legacy.columns else F.lit(None).cast(t).alias(c) for c, t in types.items()])
    return messages.unionByName(aligned)


# --- messages ------------------------------------------------------------------------------------


def message_entity(
    standardised: DataFrame,
    existing: DataFrame | None,
    primary_key: str,
    id_name: str,
    source_system: DataFrame,
    cols: HistoryColumns = HistoryColumns(migrated="migrated"),
) -> DataFrame:
    """History of one message entity after the messages it has not seen."""
    fresh = standardised if existing is None else new_messages(standardised, existing)
    enqueued = "message_enqueued_time_utc"
    stamped = fresh.withColumns(
        {
            cols.source_id: source_system.select("SourceSystemID").scalar().cast("string"),
            cols.row_id: F.lit(""),
            cols.migrated: F.lit("1"),
            cols.source: F.lit(MESSAGE_SOURCE),
            cols.valid_to: F.lit(None).cast("string"),
            cols.active: F.lit(ACTIVE),
            id_name: incremental_key(primary_key, enqueued),
            cols.valid_from: named(enqueued).cast("string"),
            "_action": merge.message_action("message_type"),
        }
    )
    dropped = ["ingested_datetime", enqueued, "expected_from", "expected_to", "input_file", "message_type"]
    labelled = stamped.drop(*dropped).dropDuplicates()
    if existing is None:
        return labelled.filter("_action <> 'delete'").drop("_action")
    return merge.reconcile_messages(existing, labelled, primary_key, "_action", cols)


# --- documents -----------------------------------------------------------------------------------

# Columns of the row ids, in hash order.
EXTRACT_DOCUMENT_ROW_ID = [
    "AIEDocumentDataID",
    "documentId",
    "caseRef",
    "documentReference",
    "version",
    "examinationRefNo",
    "filename",
    "originalFilename",
    "size",
    "mime",
    "documentUri",
    "path",
    "virusCheckStatus",
    "fileMD5",
    "dateCreated",
    "lastModified",
    "caseType",
    "documentStatus",
    "redactedStatus",
    "publishedStatus",
    "datePublished",
    "documentType",
    "securityClassification",
    "sourceSystem",
    "origin",
    "owner",
    "author",
    "representative",
    "description",
    "stage",
    "filter1",
    "filter2",
    "Migrated",
    "ODTSourceSystem",
    "IngestionDate",
    "ValidTo",
]
# Columns of the project document row id, in hash order.
PROJECT_DOCUMENT_ROW_ID = [
    "NSIPDocumentID",
    "documentId",
    "caseId",
    "caseRef",
    "version",
    "examinationRefNo",
    "filename",
    "originalFilename",
    "size",
    "mime",
    "documentURI",
    "publishedDocumentURI",
    "path",
    "virusCheckStatus",
    "fileMD5",
    "dateCreated",
    "datePublished",
    "lastModified",
    "caseType",
    "redactedStatus",
    "documentType",
    "securityClassification",
    "sourceSystem",
    "origin",
    "owner",
    "author",
    "authorWelsh",
    "description",
    "descriptionWelsh",
    "documentCaseStage",
    "filter1",
    "filter1Welsh",
    "filter2",
    "horizonFolderId",
    "transcriptId",
    "publishedStatus",
    "Migrated",
    "ODTSourceSystem",
    "IngestionDate",
    "ValidTo",
]
# Columns of the appeal document row id, in hash order.
APPEAL_DOCUMENT_ROW_ID = [
    "AppealsDocumentMetadataID",
    "documentId",
    "caseId",
    "caseReference",
    "version",
    "filename",
    "originalFilename",
    "size",
    "mime",
    "documentURI",
    "publishedDocumentURI",
    "virusCheckStatus",
    "fileMD5",
    "dateCreated",
    "dateReceived",
    "datePublished",
    "lastModified",
    "caseType",
    "redactedStatus",
    "documentType",
    "sourceSystem",
    "origin",
    "owner",
    "author",
    "description",
    "caseStage",
    "horizonFolderId",
    "caseNumber",
    "caseworkTypeGroup",
    "caseworkTypeAbbreviation",
    "versionFilename",
    "incomingOutgoingExternal",
    "publishedStatus",
    "Migrated",
    "ODTSourceSystem",
    "IngestionDate",
    "ValidTo",
]
# A project document is the same if these agree.
PROJECT_DOCUMENT_DEDUPE = [
    "documentId",
    "filename",
    "version",
    "Migrated",
    "originalFilename",
    "ODTSourceSystem",
    "IngestionDate",
    "ValidTo",
    "IsActive",
]
# Legacy document columns and their names in the history.
PROJECT_DOCUMENT_LEGACY = {
    "dataId": "documentId",
    "casenodeid": "caseId",
    "caseReference": "caseRef",
    "documentReference": "documentReference",
    "version": "version",
    "name": "filename",
    "originalFilename": "originalFilename",
    "dataSize": "size",
    "virusCheckStatus": "virusCheckStatus",
    "createDate": "dateCreated",
    "modifyDate": "lastModified",
    "caseworkType": "caseType",
    "publishedStatus": "publishedStatus",
    "datePublished": "datePublished",
    "documentType": "documentType",
    "sourceSystem": "sourceSystem",
    "author": "author",
    "authorWelsh": "authorWelsh",
    "representative": "representative",
    "documentDescription": "description",
    "documentDescriptionWelsh": "descriptionWelsh",
    "documentCaseStage": "documentCaseStage",
    "filter1": "filter1",
    "filter1Welsh": "filter1Welsh",
    "filter2": "filter2",
    "parentid": "horizonFolderId",
}
# Columns, project document extract, in order.
PROJECT_DOCUMENT_EXTRACT = [
    "examinationRefNo",
    "mime",
    "documentURI",
    "path",
    "fileMD5",
    "securityClassification",
    "origin",
    "owner",
]
APPEAL_DOCUMENT_LEGACY = {
    "documentId": "documentId",
    "casenodeid": "caseId",
    "caseReference": "caseReference",
    "version": "version",
    "filename": "filename",
    "size": "size",
    "virusCheckStatus": "virusCheckStatus",
    "dateCreated": "dateCreated",
    "datePublished": "datePublished",
    "lastModified": "lastModified",
    "caseworkType": "caseType",
    "redactedStatus": "redactedStatus",
    "documentType": "documentType",
    "sourceSystem": "sourceSystem",
    "documentDescription": "description",
    "folderid": "horizonFolderId",
    "caseNumber": "caseNumber",
    "caseworkTypeGroup": "caseworkTypeGroup",
    "caseworkTypeAbbreviation": "caseworkTypeAbbreviation",
    "versionFilename": "versionFilename",
    "incomingOutgoingExternal": "incomingOutgoingExternal",
    "publishedStatus": "publishedStatus",
}
# Columns, appeal document extract, in order.
APPEAL_DOCUMENT_EXTRACT = ["mime", "documentURI", "fileMD5", "owner", "author"]


def extract_documents(extract: DataFrame) -> DataFrame:
    """Extracted documents: one source, newest load, row ids from the row as loaded."""
    newest = latest.latest_snapshot(extract, "expected_from")
    whole = lambda c: named(c).try_cast("int")
    loaded = newest.withColumns(
        {
            "TEMP_PK": composite_key([whole("documentId"), "filename", whole("version")]),
            "AIEDocumentDataID": F.lit(None).cast("long"),
            **legacy_bookkeeping(named("expected_from")),
        }
    )
    loaded = loaded.drop("SourceSystemID", "expected_from").distinct()
    out = versions_of(loaded, "TEMP_PK", "AIEDocumentDataID", EXTRACT_DOCUMENT_ROW_ID, hash_first=True)
    return out.drop("TEMP_PK")


def _legacy_documents(
    docs: DataFrame,
    extract: DataFrame,
    load_col: str,
    names: Mapping[str, str],
    taken: Sequence[str],
    on: Sequence[tuple[str, str, str]],
) -> DataFrame:
    newest = latest.latest_snapshot(docs, load_col)
    loaded = named("expected_from")
    shaped = newest.select(*[named(a).alias(b) for a, b in names.items()], loaded)
    joined = joins.enrich_cast(shaped, extract, on, {c: c for c in taken})
    return joined.withColumns(legacy_bookkeeping(loaded)).drop("expected_from")


def project_documents(messages: DataFrame, legacy: DataFrame, extract: DataFrame) -> DataFrame:
    """Project documents of both systems; legacy rows take what they lack from the extract."""
    key = "_document"
    ours = messages.withColumn(key, F.md5(F.concat(*[named(c).cast("string") for c in ("documentId", "filename", "version")])))
    on = [("documentId", "DocumentId", "string"), ("version", "version", "string"), ("size", "size", "string")]
    theirs = _legacy_documents(
        legacy, extract, "expected_from", PROJECT_DOCUMENT_LEGACY, PROJECT_DOCUMENT_EXTRACT, on
    )
    theirs = theirs.withColumn(key, composite_key(["documentId", "filename", named("version").try_cast("int")]))
    rows = _union(ours.distinct(), theirs)
    out = versions_of(rows, key, "NSIPDocumentID", PROJECT_DOCUMENT_ROW_ID, ours, hash_first=True)
    once = latest.distinct_on(out.drop(key, "SourceSystemID"), PROJECT_DOCUMENT_DEDUPE, ["NSIPDocumentID"])
    return once


def appeal_documents(messages: DataFrame, legacy: DataFrame, extract: DataFrame) -> DataFrame:
    """Appeal documents of both systems; the address is part of a document's identity."""
    parts = ["documentId", "filename", "version", "documentURI"]
    key = "_document"
    ours = messages.withColumn(key, composite_key(parts))
    on = [("documentId", "documentid", "string"), ("size", "size", "string"), ("version", "version", "string")]
    theirs = _legacy_documents(legacy, extract, "ingested_datetime", APPEAL_DOCUMENT_LEGACY, APPEAL_DOCUMENT_EXTRACT, on)
    theirs = theirs.withColumn("originalFilename", named("filename"))
    theirs = theirs.withColumn(
        key, composite_key(["documentId", "filename", named("version").try_cast("int"), "documentURI"])
    )
    known = messages.select(composite_key(parts[:3]).alias(key))
    out = versions_of(_union(ours.distinct(), theirs), key, "AppealsDocumentMetadataID", APPEAL_DOCUMENT_ROW_ID, known)
    return out.drop(key, "SourceSystemID")


# --- project families ----------------------------------------------------------------------------

# Columns of the representation row id, in hash order.
REPRESENTATION_ROW_ID = [
    "NSIPRepresentationID",
    "representationId",
    "referenceId",
    "examinationLibraryRef",
    "caseRef",
    "caseId",
    "status",
    "originalRepresentation",
    "redacted",
    "redactedRepresentation",
    "redactedBy",
    "redactedNotes",
    "representationFrom",
    "representedId",
    "representativeId",
    "registerFor",
    "representationType",
    "dateReceived",
    "attachmentIds",
    "caseuniqueid",
    "organisationname",
    "jobtitle",
    "fullname",
    "phonenumber",
    "emailaddress",
    "buildingnumber",
    "street",
    "town",
    "county",
    "country",
    "postcode",
    "attendprelimmeeting",
    "AgentFullName",
    "AgentOrganisationName",
    "agent_phonenumber",
    "agent_emailaddress",
    "AgentBuildingNumber",
    "AgentStreet",
    "AgentTown",
    "AgentCounty",
    "AgentCountry",
    "AgentPostcode",
    "representatcompacqhearing",
    "representatissuehearing",
    "representatopenfloorhearing",
    "submitlaterreps",
    "webreference",
    "owneroroccupier",
    "powertosell",
    "entitledtoclaim",
    "other",
    "descriptionifother",
    "preferredcontactmethod",
]
# Legacy representation columns and their names in the history.
REPRESENTATION_LEGACY = {
    "casereference": "caseRef",
    "RelevantRepStatus": "status",
    "representationoriginal": "originalRepresentation",
    "representationredacted": "redactedRepresentation",
    "notes": "redactedNotes",
    "RelRepOnBehalfOf": "representationFrom",
    "RelRepOrganisation": "representationType",
    "attachmentId": "attachmentIds",
    "agent_fullname": "AgentFullName",
    "agent_organisationname": "AgentOrganisationName",
    "agent_buildingnumber": "AgentBuildingNumber",
    "agent_street": "AgentStreet",
    "agent_town": "AgentTown",
    "Agent_County": "AgentCounty",
    "Agent_Country": "AgentCountry",
    "agent_postcode": "AgentPostcode",
}


def representations(messages: DataFrame, legacy: DataFrame, source_system: DataFrame) -> DataFrame:
    """Representations of both systems. Times of legacy rows come from the one active source-system row."""
    newest = latest.latest_snapshot(legacy, "ingested_datetime").filter("casereference IS NOT NULL AND casenodeid <> 0")
    rows = newest.withColumns(
        {
            "representationId": named("relevantrepid").try_cast("int"),
            "referenceId": F.concat(
                F.coalesce("casereference", F.lit("")), F.lit("-"), F.coalesce(named("relevantrepid").cast("string"), F.lit(""))
            ),
            "caseId": named("casenodeid").try_cast("int"),
            "redacted": named("representationredacted").isNotNull(),
            "representedId": named("contactId").cast("string"),
            "representativeId": named("agentcontactid").cast("string"),
            "registerFor": named("RelRepOnBehalfOf"),
        }
    ).withColumnsRenamed(REPRESENTATION_LEGACY)
    facts = source_system.select("SourceSystemID", "IngestionDate", "ValidTo", "IsActive")
    fixed = {"Migrated": F.lit("0"), "ODTSourceSystem": F.lit(LEGACY_SOURCE), "RowID": F.lit("")}
    # What is the same in every row is put on the folded rows: it cannot tell rows apart.
    own = [c for c in messages.columns if c in rows.columns and c not in ("ingested_datetime", *fixed, *facts.columns)]
    folded = nested.collect_into(rows.select(*as_columns(own)).distinct(), ["representationId"], "attachmentIds")
    theirs = joins.attach_constants(folded.withColumns(fixed), facts)
    rows = _union(messages.distinct(), theirs)
    return versions_of(rows, "representationId", "NSIPRepresentationID", REPRESENTATION_ROW_ID, messages)


# Columns of the advice row id, in hash order.
ADVICE_ROW_ID = [
    "NSIPAdviceID",
    "adviceId",
    "adviceReference",
    "caseId",
    "caseReference",
    "title",
    "titleWelsh",
    "from",
    "agent",
    "method",
    "enquiryDate",
    "enquiryDetails",
    "enquiryDetailsWelsh",
    "adviceGivenBy",
    "adviceDate",
    "adviceDetails",
    "adviceDetailsWelsh",
    "status",
    "redactionStatus",
    "attachmentIds",
    "Section51Advice",
    "EnquirerFirstName",
    "EnquirerLastName",
    "AdviceLastModified",
    "AttachmentCount",
    "AttachmentsLastModified",
    "LastPublishedDate",
    "WelshLanguage",
    "CaseWorkType",
    "Migrated",
    "ODTSourceSystem",
    "IngestionDate",
    "ValidTo",
]
# Legacy advice columns and their names in the history.
ADVICE_LEGACY = {
    "enquirerOrganisation": "agent",
    "enqirymethod": "method",
    "enquiry": "enquiryDetails",
    "adviceFrom": "adviceGivenBy",
    "advice": "adviceDetails",
    "adviceStatus": "status",
    "attachmentdataID": "attachmentIds",
}


def advice(messages: DataFrame, legacy: DataFrame) -> DataFrame:
    """Advice of both systems. Advice that left the newest legacy snapshot is closed."""
    newest = latest.latest_snapshot(legacy, "ingested_datetime")
    rows = newest.withColumns(
        {
            "adviceId": named("advicenodeid").try_cast("int"),
            "caseId": named("casenodeid").try_cast("int"),
            "from": F.concat("enquirerfirstname", F.lit(" "), "enquirerlastname"),
            **legacy_bookkeeping(named("expected_from")),
        }
    ).withColumnsRenamed(ADVICE_LEGACY)
    shaped = rows.select(*[named(c) for c in messages.columns if c in rows.columns]).distinct()
    lists = nested.collect_sorted(shaped, ["adviceId"], "attachmentIds", "attachmentIds")
    theirs = shaped.drop("attachmentIds").distinct().join(lists, "adviceId")
    out = versions_of(_union(messages.distinct(), theirs), "adviceId", "NSIPAdviceID", ADVICE_ROW_ID, messages)
    gone = history.deleted_keys(legacy, "advicenodeid", "ingested_datetime")
    gone = gone.select(named("advicenodeid").try_cast("int").alias("adviceId"))
    return history.close_deleted(out.drop("SourceSystemID", "AttachmentModifyDate"), gone, {"adviceId": "adviceId"})


# Columns of the timetable row id, in hash order, and the states that decide whether it is published.
TIMETABLE_ROW_ID = [
    "NSIPExaminationTimetableID",
    "caseReference",
    "published",
    "eventId",
    "type",
    "eventTitle",
    "eventTitleWelsh",
    "description",
    "descriptionWelsh",
    "eventDate",
    "eventDeadlineStartDate",
    "Migrated",
    "ODTSourceSystem",
    "SourceSystemID",
    "IngestionDate",
    "ValidTo",
]
PUBLISHED = ("Published",)
UNPUBLISHED = ("Not Published", "Ready to Publish")


def exam_timetable(messages: DataFrame, legacy: DataFrame, publish_states: DataFrame) -> DataFrame:
    """Timetable events of both systems, one row per event, versioned per case."""
    flat = nested.explode_flatten(
        messages.distinct(),
        "events",
        {
            "eventId": "eventId",
            "type": "type",
            "eventTitle": "eventTitle",
            "eventTitleWelsh": "eventTitleWelsh",
            "description": "description",
            "descriptionWelsh": "descriptionWelsh",
            "date": "eventDate",
            "eventDeadlineStartDate": "eventDeadlineStartDate",
        },
    )
    ours = flat.withColumns(
        {
            "eventId": named("eventId").try_cast("int"),
            **{c: text.blank_to_null(c) for c in ("eventTitleWelsh", "description", "descriptionWelsh")},
            **{c: minute_text(c) for c in ("eventDate", "eventDeadlineStartDate")},
        }
    )
    newest = latest.latest_snapshot(legacy, "ingested_datetime")
    states = latest.latest_snapshot(publish_states, "ingested_datetime").select("CaseReference", "ExamTimetablePublishStatus")
    stated = joins.enrich(
        newest,
        latest.distinct_on(states, ["CaseReference"], ["ExamTimetablePublishStatus"]),
        {"CaseReference": "CaseReference"},
        {"ExamTimetablePublishStatus": "_state"},
    )
    theirs = stated.select(
        named("CaseReference").alias("caseReference"),
        text.tri_state("_state", PUBLISHED, UNPUBLISHED).alias("published"),
        named("ID").try_cast("int").alias("eventId"),
        named("typeofexamination").alias("type"),
        named("Name").alias("eventTitle"),
        named("NameWelsh").alias("eventTitleWelsh"),
        named("Description").alias("description"),
        named("DescriptionWelsh").alias("descriptionWelsh"),
        minute_text("Date").alias("eventDate"),
        minute_text("DeadlineStartDateTime").alias("eventDeadlineStartDate"),
        *[c.alias(n) for n, c in legacy_bookkeeping(named("expected_from")).items()],
    )
    return versions_of(
        _union(ours, theirs),
        "caseReference",
        "NSIPExaminationTimetableID",
        TIMETABLE_ROW_ID,
        messages,
        row_id_of=lambda cols: row_id_ws(cols, "|"),
    )


# The invoices of a project, and its person lists with their names in the history.
INVOICE_FIELDS = [
    "invoiceStage",
    "invoiceNumber",
    "amountDue",
    "paymentDueDate",
    "invoicedDate",
    "paymentDate",
    "refundCreditNoteNumber",
    "refundAmount",
    "refundIssueDate",
]
INVOICES_TYPE = (
    "array<struct<invoiceStage:string,invoiceNumber:string,amountDue:double,paymentDueDate:string,invoicedDate:string,"
    "paymentDate:string,refundCreditNoteNumber:string,refundAmount:double,refundIssueDate:string>>"
)
PROJECT_LISTS = {
    "region": "regions",
    "nsipOfficerIds": "nsipOfficerIds",
    "nsipAdministrationOfficerIds": "nsipAdministrationOfficerIds",
    "inspectorIds": "inspectorIds",
    "operationsManagerIds": "operationsManagerIds",
    "legalOfficerIds": "legalOfficerIds",
    "operationsLeadIds": "operationsLeadIds",
    "caseManagerIds": "caseManagerIds",
    "leadInspectorIds": "leadInspectorIds",
    "environmentalServicesOfficerIds": "environmentalServicesOfficerIds",
}


def projects(messages: DataFrame, legacy: DataFrame, row_id_cols: Sequence[str] | None = None) -> DataFrame:
    """Project versions of both systems.

    Legacy rows count until their case first came as a message. Their person columns, delivered one per row, are
    folded into one list per case and load, and their nested columns, delivered as text, are parsed into the types
    of the messages. The row id covers all listed columns, or all business columns.
    """
    sent = messages.withColumnRenamed("caseId", "HorizonCaseNumber")
    before = lambda df: joins.without_from(df, sent, "HorizonCaseNumber", "IngestionDate", "IngestionDate")
    listed = {c: a for c, a in PROJECT_LISTS.items() if c in legacy.columns}
    lists = nested.collect_over(before(legacy), ["caseId", "IngestionDate"], listed)
    lists = lists.withColumnsRenamed({"caseId": "_case", "IngestionDate": "_load"})
    same = named("caseId").eqNullSafe(named("_case")) & named("IngestionDate").eqNullSafe(named("_load"))
    # Copies go before the rows meet the messages: a version comes as often as its lists have values.
    versions = legacy.select(*as_columns([c for c in legacy.columns if c not in listed])).distinct()
    folded = before(versions).drop("HorizonCaseNumber").distinct().join(lists, same).drop("_case", "_load")
    parsed = folded.withColumns(
        {
            c: text.quoted_json(named(c).cast("string"), nullable(messages.schema[c].dataType))
            for c in ("invoices", "meetings")
            if c in folded.columns
        }
    )
    rows = messages.unionByName(parsed, allowMissingColumns=True)
    own = [c for c in rows.columns if c not in HISTORY.names() and c != "NSIPProjectInfoInternalID"]
    return versions_of(rows, "caseId", "NSIPProjectInfoInternalID", list(row_id_cols or own), messages)


def meetings(project_versions: DataFrame, target: DataFrame | None) -> DataFrame:
    """Meetings of all project versions, versioned per case and meeting, on top of what is in the table."""
    kept = [
        "NSIPProjectInfoInternalID",
        "caseId",
        "caseReference",
        "meetings",
        "Migrated",
        "ODTSourceSystem",
        "SourceSystemID",
        "IngestionDate",
    ]
    rows = project_versions.filter("meetings IS NOT NULL").select(*kept)
    fields = [f.name for f in rows.schema["meetings"].dataType.elementType.fields]
    flat = nested.explode_flatten(rows, "meetings", fields).filter("meetingId IS NOT NULL")
    if target is not None:
        flat = conform.align_types(flat, target.schema)
    return history.incremental_history(
        flat,
        target,
        ["caseId", "meetingId"],
        [f for f in fields if f not in ("meetingId", "meetingDate")] + ["meetingDate"],
        "NSIPMeetingId",
        ["NSIPProjectInfoInternalID"],
    )


# Columns of the invoice row id, in hash order, and the columns a merge may change.
INVOICE_ROW_ID = (
    ["NSIPInvoiceID", "NSIPProjectInfoInternalID", "caseId", "caseReference"]
    + INVOICE_FIELDS
    + ["Migrated", "ODTSourceSystem", "SourceSystemID", "IngestionDate", "ValidTo", "IsActive"]
)
INVOICE_UPDATES = ("IsActive", "ValidTo", "Migrated", "RowID")


def invoice_changes(project_versions: DataFrame, existing: DataFrame, now: Column) -> DataFrame:
    """Labelled changes that bring the invoice table up to the project versions; merged by :func:`invoices`."""
    kept = [
        "NSIPProjectInfoInternalID",
        "caseId",
        "caseReference",
        "invoices",
        "ODTSourceSystem",
        "SourceSystemID",
        "IngestionDate",
    ]
    rows = project_versions.filter("invoices IS NOT NULL").select(*kept)
    flat = nested.explode_flatten(rows, "invoices", INVOICE_FIELDS)
    return history.append_rerank(
        existing,
        flat,
        ["caseId", "invoiceNumber"],
        ["NSIPProjectInfoInternalID"],
        "NSIPInvoiceID",
        ["caseReference", "IngestionDate", "NSIPProjectInfoInternalID", "invoiceNumber", "invoiceStage", "amountDue"],
        INVOICE_ROW_ID,
        now,
    )


def invoices(project_versions: DataFrame, existing: DataFrame, now: Column) -> DataFrame:
    changes = materialise(invoice_changes(project_versions, existing, now), "invoice-changes")
    return merge.merge_actions(existing, changes, ["NSIPInvoiceID"], "row_action", INVOICE_UPDATES)


# --- people --------------------------------------------------------------------------------------

# Columns of the directory row id, in hash order.
DIRECTORY_ROW_ID = ["id", "employeeId", "givenName", "surname", "userPrincipalName"]


def directory_users(standardised: DataFrame, current: DataFrame, source_system: DataFrame) -> DataFrame:
    """Directory users after the newest snapshot, ids renumbered."""
    newest = latest.latest_snapshot(standardised, "expected_from").filter("id IS NOT NULL")
    snapshot = newest.select(*DIRECTORY_ROW_ID, named("expected_from").cast("timestamp").alias("IngestionDate")).distinct()
    constants = {
        "Migrated": F.lit("0"),
        "ODTSourceSystem": F.lit(DIRECTORY_SOURCE),
        "SourceSystemID": source_system.select("SourceSystemID").scalar().cast("string"),
    }
    out = materialise(history.snapshot_history(snapshot, current, "id", DIRECTORY_ROW_ID, constants), "directory")
    return history.renumber(out, "EmployeeEntraId", ["id", "IngestionDate", "RowID"])


def hr_inspectors(
    live: DataFrame,
    specialisms: DataFrame,
    directory: DataFrame,
    address: DataFrame,
    hr: DataFrame,
    key: str,
    email: str,
) -> DataFrame:
    """Inspectors from the staff systems: one row per live inspector with nested address and specialisms.

    ``key`` and ``email`` name the staff number and the address in the live table.
    """
    current = specialisms.filter("Current = 1") if "Current" in specialisms.columns else specialisms
    skills = latest.latest_per_key(current, ["StaffNumber", "QualificationName"], ["ValidFrom", "Proficien"])
    arrays = nested.collect_structs(
        skills, ["StaffNumber"], {"QualificationName": "name", "Proficien": "proficiency", "ValidFrom": "validFrom"}, "specialisms"
    )
    ids = directory.filter(named("isActive") == ACTIVE).select(
        "id", text.prefix_short("employeeId").alias("employeeId")
    )
    ids = latest.distinct_on(ids, ["employeeId"], ["id"])
    homes = latest.latest_per_key(address, ["StaffNumber"], ["IngestionDate", "StreetandHouseNumber"])
    posts = latest.latest_per_key(hr, ["PersNo"], ["ingestionDate", "Position1"])
    base = live.filter("active_status <> 'NON-ACTIVE'")
    joined = joins.enrich_star(
        nested.attach_array(base, arrays, {key: "StaffNumber"}, "specialisms"),
        [
            (ids, {key: "employeeId"}, {"id": "entraId"}),
            (
                homes,
                {key: "StaffNumber"},
                {
                    "StreetandHouseNumber": "addressLine1",
                    "2ndAddressLine": "addressLine2",
                    "City": "townCity",
                    "District": "county",
                    "PostalCode": "postcode",
                },
            ),
            (
                posts,
                {key: "PersNo"},
                {
                    "FTE": "fte",
                    "PersonnelArea": "unit",
                    "PersonnelSubArea": "service",
                    "OrganizationalUnit": "group",
                    "NameofManagerOM": "inspectorManager",
                    "Position1": "title",
                    "SourceSystemID": "sourceSystem",
                },
            ),
        ],
    )
    return joined.select(
        "entraId",
        named(key).alias("sapId"),
        named(email).alias("email"),
        named("given_names").alias("firstName"),
        named("family_name").alias("lastName"),
        iso_midnight("date_in").alias("validFrom"),
        "grade",
        "isActive",
        "specialisms",
        F.struct("addressLine1", "addressLine2", "townCity", "county", "postcode").alias("address"),
        "fte",
        "unit",
        "service",
        "group",
        "inspectorManager",
        "title",
        "sourceSystem",
    )


def inspector_timeline(legacy: DataFrame, now: Column) -> DataFrame:
    """Inspectors of the legacy system as a history of their states."""
    clean = conform.first_of_repeated(legacy)
    since = named("expected_from") if "expected_from" in clean.columns else now
    rows = conform.with_defaults(clean, {"IngestionDate": since}).withColumns(
        {
            "IngestionDate": F.col("IngestionDate").cast("timestamp"),
            "Migrated": F.lit("0"),
            "ODTSourceSystem": F.lit(LEGACY_TIMELINE_SOURCE),
            "RowID": F.lit(""),
            "SourceSystemID": F.lit("Inspectors"),
        }
    )
    return history.state_history(rows, ["horizonId"])


# Spellings of the two parties of a case; people in other roles are left out.
PARTIES = ((("Appellant", "tAppellant", "Apellant"), "Appellant"), (("Agent",), "Agent"))
# Preferred contact methods; other methods are written in lower case.
CONTACT_METHODS = ((("Letter",), "post"), (("E-Mail",), "email"))
# Columns of a service user, in order.
USER_COLUMNS = [
    "ServiceUserID",
    "id",
    "salutation",
    "firstname",
    "lastname",
    "addressline1",
    "addressline2",
    "addressTown",
    "addressCounty",
    "postcode",
    "addressCountry",
    "organisation",
    "organisationType",
    "role",
    "telephoneNumber",
    "otherPhoneNumber",
    "faxNumber",
    "emailAddress",
    "webAddress",
    "serviceUserType",
    "serviceUserTypeInternal",
    "caseReference",
    "sourceSystem",
    "sourceSuid",
    "contactMethod",
    "Migrated",
    "ODTSourceSystem",
    "IngestionDate",
    "ValidTo",
    "RowID",
    "IsActive",
]


def _legacy_user(df: DataFrame, id_col: str, cols: Mapping[str, Column]) -> DataFrame:
    newest = latest.latest_snapshot(df, "expected_from").filter(named(id_col).isNotNull())
    common = {
        "id": named(id_col).cast("string"),
        "sourceSuid": named(id_col).cast("string"),
        "sourceSystem": F.lit(LEGACY_SOURCE),
        **legacy_bookkeeping(named("expected_from")),
    }
    every = {**common, **cols}
    return newest.select(
        *[(every[c] if c in every else F.lit(None).cast("string")).alias(c) for c in USER_COLUMNS if c != "ServiceUserID"]
    ).distinct()


def service_users(
    messages: DataFrame, involvement: DataFrame, applicants: DataFrame, representation: DataFrame
) -> DataFrame:
    """Service users of four sources, versioned per person, case and role."""
    kind = text.map_groups("typeOfInvolvement", PARTIES, F.lit(None).cast("string"))
    parties = _legacy_user(
        involvement.filter(kind.isNotNull()),
        "ContactId",
        {
            "salutation": named("Title"),
            "firstname": named("FirstName"),
            "lastname": named("LastName"),
            "addressline1": named("Address1"),
            "addressline2": named("Address2"),
            "addressTown": named("City"),
            "addressCounty": named("County"),
            "postcode": named("PostCode"),
            "addressCountry": named("Country"),
            "organisation": named("OrganisationName"),
            "organisationType": named("OrganisationTypeName"),
            "telephoneNumber": named("TelephoneOffice"),
            "otherPhoneNumber": named("TelephoneMobile"),
            "faxNumber": named("Fax"),
            "emailAddress": named("Email"),
            "caseReference": named("case_number"),
            "serviceUserType": kind,
            "serviceUserTypeInternal": kind,
        },
    )
    promoters = _legacy_user(
        applicants,
        "caseNodeId",
        {
            "firstname": named("ApplicantFirstName"),
            "lastname": named("ApplicantLastName"),
            "addressline1": named("AddressLine1"),
            "addressline2": named("AddressLine2"),
            "addressTown": named("AddressTown"),
            "addressCounty": named("AddressCounty"),
            "postcode": named("PostCode"),
            "organisation": named("PromoterName"),
            "telephoneNumber": named("ApplicantPhoneNumber"),
            "emailAddress": named("ApplicantEmailAddress"),
            "webAddress": named("ApplicantWebAddress"),
            "caseReference": named("CaseReference"),
            "serviceUserType": F.lit("Applicant"),
            "serviceUserTypeInternal": F.lit("Applicant"),
        },
    )

    def contact(prefix: str, id_col: str, internal: str) -> DataFrame:
        field = lambda n: named(prefix + n)
        return _legacy_user(
            representation,
            id_col,
            {
                "lastname": field("FullName"),
                "addressline1": text.joined([field("BuildingNumber"), field("Street")]),
                "addressTown": field("Town"),
                "addressCounty": field("County"),
                "postcode": F.coalesce(*[named(c) for c in representation.columns if c.lower() == f"{prefix}postcode".lower()]),
                "addressCountry": field("Country"),
                "organisation": field("OrganisationName"),
                "role": field("JobTitle"),
                "telephoneNumber": field("PhoneNumber"),
                "emailAddress": field("EmailAddress"),
                "caseReference": named("CaseReference"),
                "serviceUserType": F.lit("RepresentationContact"),
                "serviceUserTypeInternal": F.lit(internal),
                "contactMethod": text.map_groups("preferredContactMethod", CONTACT_METHODS),
            },
        )

    ours = messages.withColumns(
        {"serviceUserTypeInternal": named("serviceUserType"), "contactMethod": F.lit(None).cast("string"), "RowID": F.lit("")}
    ).select(*[named(c) for c in USER_COLUMNS if c != "ServiceUserID"])
    rows = ours.withColumn("IngestionDate", named("IngestionDate").cast("timestamp"))
    for part in (
        parties,
        promoters,
        contact("", "ContactId", "RepresentationContact_Represented"),
        contact("Agent_", "AgentContactId", "RepresentationContact_Agent"),
    ):
        rows = rows.unionByName(part)
    staged = materialise(rows.withColumn(TIE, F.xxhash64(*as_columns(rows.columns))), "staged")
    out = history.rank_history(staged, ["id", "caseReference", "serviceUserType"], [TIE], id_name="ServiceUserID")
    return out.select(*USER_COLUMNS)


# --- cases ---------------------------------------------------------------------------------------


def case_group(
    messages: DataFrame,
    legacy: DataFrame,
    other_group: DataFrame,
    key: str,
    id_name: str,
    close_any: bool = False,
) -> DataFrame:
    """History of one case group from two systems, closed where the case moves to the other group.

    At one instant the message state comes before the legacy state. Legacy rows are dated by their load, or by
    the start of their window where the load is not known.
    """
    since = F.coalesce(*[named(c) for c in ("ingested_datetime", "expected_from") if c in legacy.columns])
    theirs = legacy.withColumns(
        {
            "IngestionDate": since.cast("timestamp"),
            "ODTSourceSystem": F.lit(LEGACY_TIMELINE_SOURCE),
            "Migrated": F.lit("0"),
            "RowID": F.lit(""),
        }
    )
    aligned = conform.align_types(
        theirs.select(*[named(c) for c in messages.columns if c in theirs.columns]), messages.schema
    )
    staged = messages.unionByName(aligned, allowMissingColumns=True).distinct()
    staged = staged.withColumn("IngestionDate", named("IngestionDate").cast("timestamp"))
    priority = {MESSAGE_SOURCE: 2, LEGACY_TIMELINE_SOURCE: 1}
    states = [c for c in staged.columns if c not in HISTORY.names() and c != id_name]
    staged = materialise(staged.drop(id_name), "staged")
    out = history.state_history(staged, [key], states, priority, id_name)
    return history.close_by(out, other_group, [key], only_active=not close_any, count_on=staged)


def case_events(messages: DataFrame, legacy: DataFrame, row_id_cols: Sequence[str]) -> DataFrame:
    """Case events of both systems; legacy rows of the newest load only, already under the message columns."""
    newest = latest.latest_snapshot(legacy, "expected_from")
    theirs = newest.withColumns(
        {n: c for n, c in legacy_bookkeeping(named("expected_from")).items() if n not in newest.columns}
    )
    return versions_of(_union(messages.distinct(), theirs), "eventId", "AppealsEventId", row_id_cols, messages)


# --- reference tables ----------------------------------------------------------------------------

# Source and table names of a listed building, in row-id order.
LISTED_BUILDING = {
    "entity": "entity",
    "dataset": "dataset",
    "end-date": "endDate",
    "entry-date": "entryDate",
    "geometry": "geometry",
    "listed-building-grade": "listedBuildingGrade",
    "name": "name",
    "organisation-entity": "organisationEntity",
    "point": "point",
    "prefix": "prefix",
    "reference": "reference",
    "start-date": "startDate",
    "typology": "typology",
    "documentation-url": "documentationUrl",
}
LISTED_COLUMNS = HistoryColumns(valid_from="dateReceived", valid_to="validTo", active="isActive", row_id="rowID")


def listed_buildings(standardised: DataFrame, current: DataFrame | None, now: Column) -> DataFrame:
    """Listed buildings versioned per entity; a changed building ends its old row now."""
    ids = list(LISTED_BUILDING.values())
    snapshot = standardised.select(*[named(a).alias(b) for a, b in LISTED_BUILDING.items()]).distinct()
    snapshot = snapshot.withColumn("dateReceived", now)
    if current is None:
        return snapshot.withColumns(
            {"rowID": row_id(ids), "validTo": F.lit(None).cast("string"), "isActive": F.lit(ACTIVE)}
        )
    return history.snapshot_history(snapshot, current, "entity", ids, closed_at=now, cols=LISTED_COLUMNS)


def listed_building_counts(before: DataFrame | None, after: DataFrame) -> DataFrame:
    """One row: started rows whose reference is new (insert) or was known (update)."""
    if before is None:
        return after.agg(F.count(F.lit(1)).alias("insert_count"), F.lit(0).cast("long").alias("update_count"))
    known = before.filter(named("isActive") == ACTIVE).select("rowID", "reference")
    started = after.filter(named("isActive") == ACTIVE).join(known.select("rowID").distinct(), "rowID", "left_anti")
    marked = joins.flag_exists(started, known, {"reference": "reference"}, "_known", True, False)
    return marked.agg(
        F.count_if(~F.col("_known")).alias("insert_count"), F.count_if(F.col("_known")).alias("update_count")
    )


def attribute_matrix(standardised: DataFrame, now: Column) -> DataFrame:
    """Attribute matrix: trimmed, attribute in lower case, keyed by the hash of its JSON, defaults where absent."""
    clean = conform.trim_text(standardised, lower=["attribute"])
    keyed = conform.with_json_key(clean, ["attribute"], "TEMP_PK")
    out = conform.with_defaults(
        keyed, {"ODTSourceSystem": F.lit("AppealAttributeMatrix"), "IsActive": F.lit(ACTIVE), "IngestionDate": now}
    )
    return out.withColumn("IngestionDate", named("IngestionDate").cast("timestamp"))


