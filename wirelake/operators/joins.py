"""Anti joins, and joins on overlapping ranges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def without(df: DataFrame, known: DataFrame, key: str, known_key: str | None = None) -> DataFrame:
    """Rows whose key is not among the known keys; repeated rows stay repeated. A null key is never known."""
    keys = known.select(F.col(known_key or key).alias(key))
    return df.join(keys, key, "left_anti").select(*df.columns)


def overlapping(
    left: DataFrame, right: DataFrame, left_range: tuple[str, str], right_range: tuple[str, str], bucket_days: int = 31
) -> DataFrame:
    """Pairs of rows whose closed date ranges overlap.

    Each range is entered under every bucket of `bucket_days` days that it touches, and the join is on the
    bucket. A pair that shares several buckets is kept only in the first of them, so no distinct is needed.
    Column names of the two sides must differ.
    """
    def bucket(date: str) -> Column:
        return _bucket(date, bucket_days)

    def entered(df: DataFrame, bounds: tuple[str, str], first: str) -> DataFrame:
        ordered = df.where(F.col(bounds[0]) <= F.col(bounds[1]))
        return ordered.withColumn(first, bucket(bounds[0])).withColumn(
            "_bucket", F.explode(F.sequence(bucket(bounds[0]), bucket(bounds[1])))
        )

    a, b = entered(left, left_range, "_left_first"), entered(right, right_range, "_right_first")
    tests = [
        F.col(left_range[0]) <= F.col(right_range[1]),
        F.col(left_range[1]) >= F.col(right_range[0]),
        F.col("_bucket") == F.greatest("_left_first", "_right_first"),
    ]
    return a.join(b, "_bucket").where(reduce(lambda x, y: x & y, tests)).drop("_bucket", "_left_first", "_right_first")


def contained(
    outer: DataFrame, inner: DataFrame, outer_range: tuple[str, str], inner_range: tuple[str, str], bucket_days: int = 31
) -> DataFrame:
    """Pairs of rows whose inner closed date range lies inside the outer one. Column names of the two sides must differ.

    The outer range is entered under every bucket of days that it touches, the inner one under that of its first day, so a
    pair meets once.
    """
    buckets = F.sequence(_bucket(outer_range[0], bucket_days), _bucket(outer_range[1], bucket_days))
    a = outer.where(F.col(outer_range[0]) <= F.col(outer_range[1])).withColumn("_bucket", F.explode(buckets))
    b = inner.where(F.col(inner_range[0]) <= F.col(inner_range[1])).withColumn("_bucket", _bucket(inner_range[0], bucket_days))
    inside = (F.col(outer_range[0]) <= F.col(inner_range[0])) & (F.col(inner_range[1]) <= F.col(outer_range[1]))
    return a.join(b, "_bucket").where(inside).drop("_bucket")


def _bucket(date: str, days: int) -> Column:
    return F.floor(F.unix_date(F.col(date).cast("date")) / F.lit(days)).cast("int")
