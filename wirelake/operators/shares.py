"""Counts with their share of a total."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Share in percent as DOUBLE; null where the whole is zero."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")) * 100, digits)


def ratio(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), digits)


def counts_with_share(df: DataFrame, by: str, total: Column | None = None, count: str = "n", digits: int = 1) -> DataFrame:
    """Rows per value of `by` and their share of `total` (of all counted rows by default), largest first."""
    counts = df.groupBy(by).agg(F.count("*").alias(count))
    if total is None:
        total = counts.select(F.sum(count)).scalar()
    return counts.withColumn("pct", percent(F.col(count), total, digits)).orderBy(F.desc(count), by)
