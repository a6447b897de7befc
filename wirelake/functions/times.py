"""Dates and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings tried in turn by `coerce_timestamp`.
TIMESTAMP_FORMATS = [
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd",
    "MM/dd/yyyy",
    "MMM d, yyyy",
    "d MMM yyyy",
]


def coerce_timestamp(text: Column, formats: list[str] | None = None) -> Column:
    """First spelling that fits; null where none does."""
    tries = [F.try_to_timestamp(text, F.lit(f)) for f in formats or TIMESTAMP_FORMATS]
    return F.coalesce(*tries).cast("timestamp_ntz")


def days_before(at: Column, days: int) -> Column:
    return at - F.make_dt_interval(F.lit(days))


def run_id_of(at: Column) -> Column:
    return F.date_format(at, "yyyyMMdd_HHmmss")


def day(at: Column) -> Column:
    return F.to_date(at)
