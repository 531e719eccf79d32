"""Typed structural errors raised by ingest."""

from __future__ import annotations

# The coded structural errors of the import stage.
NON_FLAT_DATA = "E-TREP-10001"
NON_MAPPED_TABLE = "E-TREP-10002"
NON_MAPPED_COLUMN = "E-TREP-10003"
NO_DATA_CONTENT = "E-TREP-10004"
AMBIGUOUS_TABLE_DATA = "E-TREP-10005"

# Our own: a record that is no XML.
MALFORMED_RECORD = "R-RECORD-1"


class IngestError(ValueError):
    def __init__(self, code: str, message: str):
        super().__init__(f"{message} ({code})")
        self.code = code
