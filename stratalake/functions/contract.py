"""Column names and literals that callers of the harmonised layer depend on.

Fixed values: consumers read these names and codes, so they are stated once, here.
"""

from __future__ import annotations

from dataclasses import dataclass

ACTIVE = "Y"
INACTIVE = "N"

# Columns added to every standardised message table, in order.
STANDARDISED_COLUMNS = (
    ("ingested_datetime", "timestamp"),
    ("expected_from", "timestamp"),
    ("expected_to", "timestamp"),
    ("message_id", "string"),
    ("message_type", "string"),
    ("message_enqueued_time_utc", "string"),
    ("input_file", "string"),
)

# Columns added to every harmonised table, in order.
HARMONISED_COLUMNS = (
    ("migrated", "string"),
    ("ODTSourceSystem", "string"),
    ("SourceSystemID", "string"),
    ("IngestionDate", "string"),
    ("ValidTo", "string"),
    ("RowID", "string"),
    ("IsActive", "string"),
)


@dataclass(frozen=True)
class HistoryColumns:
    """Names of the bookkeeping columns of a versioned table."""

    valid_from: str = "IngestionDate"
    valid_to: str = "ValidTo"
    active: str = "IsActive"
    row_id: str = "RowID"
    migrated: str = "Migrated"
    source: str = "ODTSourceSystem"
    source_id: str = "SourceSystemID"

    def names(self) -> frozenset[str]:
        return frozenset(
            (
                self.valid_from,
                self.valid_to,
                self.active,
                self.row_id,
                self.migrated,
                self.source,
                self.source_id,
            )
        )


HISTORY = HistoryColumns()


# Labels that say which system a history row came from.
MESSAGE_SOURCE = "ODT"
LEGACY_SOURCE = "Horizon"
LEGACY_TIMELINE_SOURCE = "HORIZON"
DIRECTORY_SOURCE = "EntraID"
