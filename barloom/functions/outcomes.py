"""Outcome of one asset's ingest attempt."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Error texts that mean the vendor is throttling.
THROTTLE_MARKS = [
    "429",
    "too many requests",
    "rate limit",
    "connection reset",
    "connection aborted",
    "read timed out",
    "no data found",
]


def download_status(rows: Column, error: Column, skipped: Column) -> Column:
    """success: rows and no error; else skipped if up to date; else error (also "no rows")."""
    succeeded = (F.coalesce(rows, F.lit(0)) > 0) & error.isNull()
    return (
        F.when(succeeded, "success")
        .when(F.coalesce(skipped, F.lit(False)), "skipped")
        .otherwise("error")
    )


def is_throttle_error(message: Column) -> Column:
    """Whether the message holds one of the throttling texts, in any letter case."""
    text = F.lower(F.coalesce(message, F.lit("")))
    return text.rlike("|".join(THROTTLE_MARKS))
