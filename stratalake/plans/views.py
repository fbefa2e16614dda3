"""Reporting views: columns under the names of the report, active rows, distinct where the report is.

The views have no order of their own, as a view has none; a report that shows so many rows asks for them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.contract import ACTIVE
from stratalake.functions.keys import named

# Names in the report and the columns they come from; none means the text NULL.
DOCUMENT_METADATA = {
    "documentId": "DataId",
    "caseId": "CaseNodeId",
    "caseReference": "documentReference",
    "documentReference": "documentReference",
    "version": "Version",
    "examinationRefNo": None,
    "filename": "Name",
    "originalFilename": "Name",
    "size": "DataSize",
    "mime": None,
    "documentUri": None,
    "publishedDocumentUri": None,
    "virusCheckStatus": None,
    "fileMd5": None,
    "dateCreated": "CreateDate",
    "lastModified": "ModifyDate",
    "caseType": "CaseworkType",
    "redactedStatus": None,
    "publishedStatus": "PublishedStatus",
    "datePublished": "DatePublished",
    "documentType": "DocumentType",
    "securityClassification": None,
    "sourceSystem": "SourceSystem",
    "origin": None,
    "owner": None,
    "author": "Author",
    "representative": "Representative",
    "description": "DocumentDescription",
    "documentCaseStage": "DocumentCaseStage",
    "filter1": "Filter1",
    "filter2": "Filter2",
    "horizonFolderId": "ParentID",
    "transcriptId": None,
}
# As above.
SERVICE_USER = {
    "salutation": "Salutation",
    "firstName": "FirstName",
    "lastName": "LastName",
    "addressLine1": "AddressLine1",
    "addressLine2": "AddressLine2",
    "addressTown": "AddressTown",
    "addressCounty": "AddressCounty",
    "postcode": "Postcode",
    "organisation": "Organisation",
    "organisationType": "OrganisationType",
    "telephoneNumber": "TelephoneNumber",
    "otherPhoneNumber": "OtherPhoneNumber",
    "faxNumber": "FaxNumber",
    "serviceUserType": "Role",
    "caseReference": "CaseReference",
}
# What the report of the other source has besides.
SERVICE_USER_SOURCE = {"emailAddress": "EmailAddress", "dataSource": "ODTSourceSystem"}
# Columns of the building report, in its order.
LISTED_BUILDING = (
    "ListedBuildingEntity",
    "ListedBuildingEntryDate",
    "ListedBuildingName",
    "ListedBuildingOrganisationEntity",
    "ListedBuildingPrefix",
    "ListedBuildingPoint",
    "ListedBuildingReference",
    "ListedBuildingStartDate",
    "ListedBuildingTypology",
    "ListedBuildingDocumentation",
    "ListedBuildingNumber",
    "ListedBuildingGrade",
)
# As the first.
INFORMATION_ENTITY = {
    "entity_name": "IMSEntityName",
    "entity_number_container": "IMSEntityNumberContainer",
    "business_area": "IMSEntityBusinessArea",
    "entity_information_owner": "IMSEntityInformationOwner",
    "entity_information_expert": "IMSEntityInformationExpert",
    "type": "IMSEntityType",
    "status": "IMSEntityStatus",
    "priority": "IMSEntityPriority",
    "resolution": "IMSEntityResolution",
    "work_log": "IMSEntityWorkLog",
    "business_criticality": "IMSEntityBusinessCriticality",
    "date_modified": "IMSEntityDateModified",
}
# Fixed value: an old number that says there is none.
NO_OLD_NUMBER = "No Info"


def _active(df: DataFrame) -> DataFrame:
    return df.filter(named("IsActive") == ACTIVE)


def _named(columns: Mapping[str, str | None]) -> list[Column]:
    return [(F.lit("NULL") if source is None else named(source)).alias(name) for name, source in columns.items()]


def document_metadata(documents: DataFrame) -> DataFrame:
    """Active documents in the shape of the document message."""
    return _active(documents).select(*_named(DOCUMENT_METADATA))


def service_users(involvements: DataFrame) -> DataFrame:
    """People of active involvements, equal ones once; the report sorts by first name, then last name downwards."""
    return _active(involvements).select(*_named(SERVICE_USER)).distinct()


def source_service_users(involvements: DataFrame, rows: int | None = 10, order: Sequence[Column] = ()) -> DataFrame:
    """People of active involvements with their source; the report shows ten rows, ``None`` gives all."""
    moved = F.when(named("Migrated") == 0, "NO").otherwise("YES").alias("migrated")
    out = _active(involvements).select(*_named({**SERVICE_USER, **SERVICE_USER_SOURCE}), moved)
    return out if rows is None else (out.orderBy(*order) if order else out).limit(rows)


def genders(employees: DataFrame, column: str = "Gender") -> DataFrame:
    """The values that occur, null among them."""
    return employees.select(named(column).alias("Gender")).distinct()


def listed_buildings(buildings: DataFrame) -> DataFrame:
    """Buildings, equal ones once."""
    return buildings.select(*[named(c) for c in LISTED_BUILDING]).distinct()


def information_entities(entities: DataFrame) -> DataFrame:
    """Active entities under their old number where there is one."""
    number = F.when(named("BDCIDLegacy") == NO_OLD_NUMBER, named("IMSEntityID")).otherwise(named("BDCIDLegacy"))
    return _active(entities).select(number.alias("entity_id"), *_named(INFORMATION_ENTITY))
