"""Times as text, the way ledgers and batch names show them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

STAMP = "%Y%m%d_%H%M%S"


def batch_name(at: datetime, label: str) -> str:
    """Name of a batch landed at a time."""
    return f"batch_{at:{STAMP}}_{label}"


def batch_stamp(at: Column, label: Column) -> Column:
    """``batch_name`` for a column of times."""
    return F.concat(F.lit("batch_"), F.date_format(at, "yyyyMMdd_HHmmss"), F.lit("_"), label)


def iso_text(at: Column) -> Column:
    """ISO 8601 text without zone; the fraction only where there is one."""
    fraction = F.when(F.unix_micros(at) % 1_000_000 != 0, F.date_format(at, ".SSSSSS")).otherwise(F.lit(""))
    return F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), fraction)
