"""Histories to consumer tables and views, as compositions of the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions import text
from stratalake.functions.contract import ACTIVE, HISTORY, LEGACY_SOURCE, MESSAGE_SOURCE
from stratalake.functions.keys import as_columns, named
from stratalake.functions.temporal import not_before, utc_to_local
from stratalake.operators import conform, joins, latest, merge, nested


def active_rows(df: DataFrame, columns: Sequence[str], distinct: bool = True) -> DataFrame:
    """Active rows in a fixed column order; columns the history lacks are null."""
    out = conform.project_padded(df.filter(named("IsActive") == ACTIVE), columns)
    return out.distinct() if distinct else out


# --- documents and projects ----------------------------------------------------------------------

# Case types and their letters.
CASE_TYPES = {
    "Planning Listed Building and Conservation Area Appeal (Y)": "Y",
    "Lawful Development Certificate Appeal": "X",
    "Planning Obligation Appeal": "Q",
    "Commercial (CAS) Appeal": "Z",
    "Enforcement Listed Building and Conservation Area Appeal": "F",
    "Advertisement Appeal": "H",
    "Planning Appeal (A)": "W",
    "Enforcement Notice Appeal": "C",
    "Discontinuance Notice Appeal": "G",
    "Community Infrastructure Levy": "L",
    "Planning Appeal (W)": "W",
    "Call-In Application": "V",
    "Affordable Housing Obligation Appeal": "S",
    "Householder (HAS) Appeal": "D",
}
# Columns of the curated documents, in order.
APPEAL_DOCUMENT = [
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
]
# Columns, project document, in order.
PROJECT_DOCUMENT = [
    "documentId",
    "caseId",
    "caseRef",
    "documentReference",
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
    "lastModified",
    "caseType",
    "redactedStatus",
    "publishedStatus",
    "datePublished",
    "documentType",
    "securityClassification",
    "sourceSystem",
    "origin",
    "owner",
    "author",
    "authorWelsh",
    "representative",
    "description",
    "descriptionWelsh",
    "documentCaseStage",
    "filter1",
    "filter1Welsh",
    "filter2",
    "horizonFolderId",
    "transcriptId",
]


def appeal_documents(history: DataFrame) -> DataFrame:
    out = active_rows(history, APPEAL_DOCUMENT, distinct=False)
    blank = {c: F.coalesce(named(c), F.lit("")) for c in ("mime", "documentURI")}
    return out.withColumns({**blank, "caseType": text.map_codes("caseType", CASE_TYPES)}).distinct()


def project_documents(history: DataFrame) -> DataFrame:
    out = active_rows(history, PROJECT_DOCUMENT, distinct=False)
    stages = {"Developer's Application": "developers_application", "Post decision": "post_decision"}
    status = F.when(named("publishedStatus") == "Depublished", F.lit("unpublished")).otherwise(
        F.regexp_replace(F.lower("publishedStatus"), " ", "_")
    )
    return out.withColumns(
        {
            "documentURI": F.coalesce("documentURI", F.lit("")),
            "caseType": F.lower("caseType"),
            "publishedStatus": status,
            "documentCaseStage": text.map_codes("documentCaseStage", stages, F.lower("documentCaseStage")),
        }
    ).distinct()


def projects(history: DataFrame) -> DataFrame:
    fixed_type = {"WW01 - Waste Water treatment Plants": "WW01 - Waste Water Treatment Plants"}
    source = F.lower(
        F.when(named("ODTSourceSystem") == MESSAGE_SOURCE, F.lit("back-office-applications")).otherwise(named("ODTSourceSystem"))
    )
    out = history.filter(named("IsActive") == ACTIVE) if "IsActive" in history.columns else history
    return out.withColumns(
        {
            "caseId": named("caseId").try_cast("int"),
            "publishStatus": F.lower("publishStatus"),
            "projectType": text.map_codes("projectType", fixed_type),
            "stage": text.slug("stage"),
            "sourceSystem": source,
            "easting": named("easting").try_cast("int"),
            "northing": named("northing").try_cast("int"),
            "rule8LetterPublishDate": named("rule8LetterPublishDate").try_cast("date"),
        }
    ).drop("ODTSourceSystem")


# --- representation, advice, timetable -----------------------------------------------------------

# Representation states, and who a representation comes from.
REPRESENTATION_STATES = (
    (("New", "In Progress"), "awaiting_review"),
    (("Complete",), "valid"),
    (("Do Not Publish",), "invalid"),
)
REPRESENTED_BY = (
    (("An Organisation",), "ORGANISATION"),
    (("Members of the Public/Businesses", "Another Individual or Organisation", "Myself"), "PERSON"),
)
# Columns, representation, in order.
REPRESENTATION = [
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
]


def representations(history: DataFrame) -> DataFrame:
    out = history.filter((named("IsActive") == ACTIVE) & named("caseRef").isNotNull()).drop("referenceId")
    out = out.withColumnRenamed("webreference", "referenceId")
    types = {"Other Statutory Consultees": "Statutory Consultees"}
    return (
        out.withColumns(
            {
                "status": text.map_groups("status", REPRESENTATION_STATES),
                "originalRepresentation": F.coalesce("originalRepresentation", F.lit("")),
                "registerFor": text.map_groups("representationFrom", REPRESENTED_BY, named("registerFor")),
                "representationFrom": text.map_groups("representationFrom", REPRESENTED_BY, named("representationFrom")),
                "representationType": text.map_codes("representationType", types),
            }
        )
        .select(*REPRESENTATION)
        .distinct()
    )


# Advice states and columns.
ADVICE_STATES = ((("Not Checked", "unchecked", "Depublished"), "unchecked"), (("Do Not Publish",), "donotpublish"))
# Columns, advice, in order.
ADVICE = [
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
]


def advice(history: DataFrame) -> DataFrame:
    """``none`` means that there is no agent or method; a missing case is -1."""
    out = active_rows(history, ADVICE, distinct=False)
    case = named("caseId").cast("string")
    not_none = lambda c: F.when(F.lower(named(c)) != "none", named(c))
    return out.withColumns(
        {
            "caseId": F.when(case == "None", F.lit(-1)).otherwise(case.try_cast("int")),
            "agent": not_none("agent"),
            "method": F.lower(not_none("method")),
            "status": text.map_groups("status", ADVICE_STATES),
        }
    ).distinct()


# Columns, timetable, in order.
TIMETABLE = [
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
]


def exam_timetable(history: DataFrame, projects: DataFrame) -> DataFrame:
    """Newest legacy load of every case that is a known project; events that share its time all count."""
    legacy = history.filter(F.lower("ODTSourceSystem") == LEGACY_SOURCE.lower())
    newest = latest.latest_with_ties(legacy.filter("caseReference IS NOT NULL"), ["caseReference"], "IngestionDate")
    return joins.within(newest, projects, {"caseReference": "caseReference"}).select(*TIMETABLE).distinct()


# --- meetings, invoices, subscriptions -----------------------------------------------------------

MEETING_FIRST = ["caseId", "caseReference"]
MEETING_LAST = ["meetingId", "meetingDate", "meetingType"]
MEETING_LEFT_OUT = HISTORY.names() | {"NSIPMeetingId", "NSIPProjectInfoInternalID", "row_hash"}
# Columns, invoice, in order.
INVOICE = [
    "caseId",
    "caseReference",
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
# Columns, subscription, in order.
SUBSCRIPTION = [
    "subscriptionId",
    "caseReference",
    "emailAddress",
    "subscriptionType",
    "startDate",
    "endDate",
    "language",
]


def meetings(history: DataFrame) -> DataFrame:
    """The newest date of every active meeting, with the details of a meeting between its case and its id."""
    fixed = {*MEETING_FIRST, *MEETING_LAST, *MEETING_LEFT_OUT}
    columns = [*MEETING_FIRST, *[c for c in history.columns if c not in fixed], *MEETING_LAST]
    rows = active_rows(history, columns, distinct=False).filter("meetingId IS NOT NULL")
    return latest.latest_per_key(rows, ["meetingId"], ["meetingDate", "caseId", "meetingAgenda", "meetingType"])


def invoices(history: DataFrame) -> DataFrame:
    return active_rows(history, INVOICE)


def subscriptions(history: DataFrame) -> DataFrame:
    return active_rows(history, SUBSCRIPTION)


# --- appeals -------------------------------------------------------------------------------------

# Columns, event estimate, in order.
EVENT_ESTIMATE = ["id", "caseReference", "preparationTime", "sittingTime", "reportingTime"]
# Columns, appeal representation, in order.
APPEAL_REPRESENTATION = [
    "representationId",
    "caseId",
    "caseReference",
    "representationStatus",
    "originalRepresentation",
    "redacted",
    "redactedRepresentation",
    "redactedBy",
    "invalidOrIncompleteDetails",
    "otherInvalidOrIncompleteDetails",
    "source",
    "serviceUserId",
    "representationType",
    "dateReceived",
    "documentIds",
]


def event_estimates(history: DataFrame) -> DataFrame:
    return active_rows(history, EVENT_ESTIMATE, distinct=False)


def reporting_copy(
    history: DataFrame,
    columns: Sequence[str],
    source: str | None = None,
    times: Sequence[str] = ("IngestionDate", "ValidTo"),
    local: bool = True,
) -> DataFrame:
    """Copy for reporting: dates before 1900 are left out, times become local, copies count once."""
    out = history if source is None else history.filter(named("ODTSourceSystem") == source)
    for c in times:
        out = out.filter(not_before(named(c).try_cast("timestamp")))
    out = out.select(*as_columns(columns)).distinct()
    return out.withColumns({c: utc_to_local(c) for c in times if c in columns}) if local else out


def appeal_representations(history: DataFrame) -> DataFrame:
    return active_rows(history, APPEAL_REPRESENTATION, distinct=False)


# Columns, inspector, in order.
INSPECTOR = [
    "entraId",
    "sapId",
    "firstName",
    "lastName",
    "email",
    "grade",
    "fte",
    "unit",
    "service",
    "group",
    "inspectorManager",
    "title",
    "address",
    "specialisms",
    "validFrom",
]


def inspector_changes(history: DataFrame, curated: DataFrame, action: str = "row_state_metadata") -> DataFrame:
    """Inspectors to create or update; unchanged ones are left out, and so are those without a directory id."""
    rows = history.filter(named("IsActive" if "IsActive" in history.columns else "isActive") == ACTIVE)
    return merge.label_changes(rows.select(*as_columns(INSPECTOR)).distinct(), curated, "entraId", action)


def inspectors(history: DataFrame, curated: DataFrame | None) -> DataFrame:
    rows = history.filter(named("IsActive" if "IsActive" in history.columns else "isActive") == ACTIVE)
    return merge.hash_upsert(rows.select(*as_columns(INSPECTOR)).distinct(), curated, "entraId")


def service_users(history: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Appellants of any system and everybody of the appeals back office; equal rows are kept."""
    keep = (named("serviceUserType") == "Appellant") | (named("sourceSystem") == "back-office-appeals")
    return history.filter((named("IsActive") == ACTIVE) & keep).select(*as_columns(columns))


def service_users_reporting(messages: DataFrame, history: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Service users of both tables once each; blank ends of the history are null, those of the messages stay."""
    theirs = history.withColumn("ValidTo", text.blank_to_null("ValidTo"))
    both = messages.select(*as_columns(columns)).unionByName(theirs.select(*as_columns(columns)))
    times = [c for c in columns if c.lower() in ("ingestiondate", "validto")]
    kept = both
    for c in times:
        kept = kept.filter(not_before(named(c).try_cast("timestamp")))
    return kept.distinct()


# The one case stage whose name is not its lower-case spelling.
CASE_STAGES = {"Post decision": "post_decision"}


def folders(history: DataFrame, columns: Sequence[str]) -> DataFrame:
    out = active_rows(history, columns, distinct=False)
    return out.withColumn("caseStage", text.map_codes("caseStage", CASE_STAGES, F.lower("caseStage"))).distinct()


def attribute_matrix(history: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The flag decides where there is one, otherwise the newest load; declared columns first."""
    chosen = latest.active_or_latest(history, ["TEMP_PK"], ["IngestionDate"])
    return conform.declared_first(chosen, columns)


def listed_buildings(history: DataFrame, curated: DataFrame) -> DataFrame:
    active = history.filter(named("isActive") == ACTIVE)
    return merge.aligned_upsert(active, curated, "entity")


# --- case tables and views -----------------------------------------------------------------------


def case_api(
    groups: Sequence[DataFrame],
    authorities: DataFrame,
    users: DataFrame,
    events: DataFrame,
    directory: DataFrame,
    booleans: Sequence[str],
    reference: str = "applicationReference",
) -> DataFrame:
    """Cases of all groups with authority, appellant, event and the two officers; equal cases count once per reference."""
    active = lambda df: df.filter(named("IsActive" if "IsActive" in df.columns else "isActive") == ACTIVE)
    people = latest.distinct_on(active(directory), ["id"], ["givenName", "surname"])
    appellants = active(users).filter("serviceUserType = 'Appellant'")
    sides = [
        (latest.distinct_on(active(authorities), ["lpaCode"], ["lpaName"]), {"lpaCode": "lpaCode"}, {"lpaName": "lpaName"}),
        (
            latest.distinct_on(appellants, ["caseReference"], ["id"]),
            {"caseReference": "caseReference"},
            {"firstName": "appellantFirstName", "lastName": "appellantLastName"},
        ),
        (
            latest.distinct_on(active(events), ["caseReference"], ["eventId"]),
            {"caseReference": "caseReference"},
            {"eventId": "eventId", "eventType": "eventType"},
        ),
    ]
    roles = {
        "inspectorId": {"givenName": "inspectorFirstName", "surname": "inspectorLastName"},
        "caseOfficerId": {"givenName": "caseOfficerFirstName", "surname": "caseOfficerLastName"},
    }
    whole = None
    for group in groups:
        rich = joins.enrich_roles(joins.enrich_star(active(group), sides), people, "id", roles)
        whole = rich if whole is None else whole.unionByName(rich, allowMissingColumns=True)
    clean = whole.withColumns(
        {
            reference: text.or_default(text.strip_trailing(reference), "UNKNOWN"),
            **{b: text.to_boolean(named(b).cast("string")) for b in booleans},
        }
    )
    return latest.distinct_on(clean, ["caseReference", reference], ["caseId"])


def case_view(
    groups: Mapping[int, DataFrame], events: DataFrame, inspectors: DataFrame, event_fields: Sequence[str], part_size: int | None = None
) -> DataFrame:
    """One row per case: the group with the lowest number wins; events as JSON, both officers by name.

    With ``part_size`` a JSON text holds at most so many events, and a case has a row for each of its texts, ``part`` of
    ``parts``; a case without events has one row.
    """
    chosen = latest.by_source_priority(
        {p: df.filter(named("IsActive") == ACTIVE) for p, df in groups.items()}, ["caseReference"], ["IngestionDate"]
    )
    current, taken = events.filter(named("IsActive") == ACTIVE), {"event": "event"}
    if part_size is None:
        folded = nested.rows_json(current, ["caseReference"], event_fields, "event")
    else:
        folded = nested.rows_json_parts(current, ["caseReference"], event_fields, "event", part_size)
        taken |= {"part": "part", "parts": "parts"}
    people = latest.distinct_on(inspectors, ["entraId"], ["firstName", "lastName"])
    rich = joins.enrich(chosen, folded, {"caseReference": "caseReference"}, taken)
    if part_size is not None:
        rich = rich.withColumns({c: F.coalesce(c, F.lit(1)) for c in ("part", "parts")})
    roles = {
        "inspectorId": {"firstName": "inspectorFirstName", "lastName": "inspectorLastName"},
        "caseOfficerId": {"firstName": "caseOfficerFirstName", "lastName": "caseOfficerLastName"},
    }
    return joins.enrich_roles(rich, people, "entraId", roles)


def sickness_pivot(absences: DataFrame, person: str, label: Column, labels: Sequence[str]) -> DataFrame:
    """Absences per person and year label, labels across."""
    return nested.pivot_counts(absences.withColumn("_label", label), [person], "_label", labels)
