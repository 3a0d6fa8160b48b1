"""Classification of error texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Error patterns (on lower-cased text) and the status name of each.
ERROR_PATTERNS = (
    ("login failed", "PIPELINE_FAILURE_AUTH_FAILED"),
    ("invalid object name|does not exist|table not found", "PIPELINE_FAILURE_TABLE_NOT_FOUND"),
)
GENERAL_FAILURE = "MASTER_FAILURE"


def error_status(message: Column) -> Column:
    """Status name of an error message; text that fits no pattern is general."""
    text = F.lower(F.coalesce(message, F.lit("")))
    status = None
    for pattern, name in ERROR_PATTERNS:
        hit = text.rlike(pattern)
        status = F.when(hit, name) if status is None else status.when(hit, name)
    return status.otherwise(F.lit(GENERAL_FAILURE))
