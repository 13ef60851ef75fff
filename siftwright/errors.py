"""Error codes, statuses and exceptions."""

from __future__ import annotations

from enum import StrEnum

# Codes that reject a whole file.
MISSING_REQUIRED_COLUMN = "MISSING_REQUIRED_COLUMN"
EXTRA_UNEXPECTED_COLUMN = "EXTRA_UNEXPECTED_COLUMN"
DUPLICATE_COLUMN_NAME = "DUPLICATE_COLUMN_NAME"
NO_HEADER_ROW = "NO_HEADER_ROW"
DETECT_ENCODING_MISMATCH = "DETECT_ENCODING_MISMATCH"
DETECT_DIALECT_MISMATCH = "DETECT_DIALECT_MISMATCH"
CORRUPTED_ARCHIVE = "CORRUPTED_ARCHIVE"
DECOMPRESSION_BOMB_EXCEEDED = "DECOMPRESSION_BOMB_EXCEEDED"

# Codes of a row.
WRONG_COLUMN_COUNT = "WRONG_COLUMN_COUNT"
NULL_VIOLATION = "NULL_VIOLATION"
TYPE_MISMATCH = "TYPE_MISMATCH"
INVALID_DATE_FORMAT = "INVALID_DATE_FORMAT"
INVALID_TIMESTAMP_FORMAT = "INVALID_TIMESTAMP_FORMAT"
DECIMAL_PRECISION_EXCEEDED = "DECIMAL_PRECISION_EXCEEDED"


class Status(StrEnum):
    """How an ingestion ended."""

    SUCCESS = "SUCCESS"
    SUCCESS_WITH_INVALID_ROWS = "SUCCESS_WITH_INVALID_ROWS"
    FILE_NOT_FOUND = "FILE_NOT_FOUND"
    INVALID_FILE = "INVALID_FILE"
    CONFIGURATION_ERROR = "CONFIGURATION_ERROR"
    DATABASE_ERROR = "DATABASE_ERROR"
    PROCESSING_ERROR = "PROCESSING_ERROR"


class CodedError(Exception):
    """An error with a code of the vocabulary above."""

    def __init__(self, message: str, code: str | None = None, **context: object):
        super().__init__(message)
        self.code = code
        self.context = context


class ContractError(CodedError):
    """A dataset contract that can't be used."""


class StructureError(CodedError):
    """A file whose structure doesn't fit its contract: the whole file is rejected."""


class InspectionError(CodedError):
    """A file that can't be read as declared: a broken archive, too much data, undecodable bytes."""


class ConstraintError(CodedError):
    """Rows that break a key, a reference or a width of the target tables."""


class FilenameError(CodedError):
    """A file name that doesn't fit its mask."""
