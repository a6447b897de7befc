"""Edge formats: CSV and line lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wirelake.functions.words import trimmed

# Doubled quotes inside quoted fields, blanks and line breaks kept as they are. A field may hold line breaks, so one
# task reads a file whole: write tables of long texts in many files, as `write_csv` does, or keep them as Parquet.
CSV = {
    "header": "true", "quote": '"', "escape": '"', "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    return spark.read.schema(schema).options(**{**CSV, **options}).csv(path)


def write_csv(df: DataFrame, path: str, **options: str) -> None:
    df.write.options(**{**CSV, "emptyValue": "", **options}).csv(path)


def read_lines(spark: SparkSession, path: str, name: str = "url") -> DataFrame:
    """Distinct non-blank lines without their padding."""
    return spark.read.text(path).select(trimmed(F.col("value")).alias(name)).where(F.col(name) != "").distinct()


def add_lines(old: DataFrame, new: DataFrame, path: str, name: str = "url") -> None:
    """Writes the distinct union of two lists in sorted order."""
    both = old.select(name).union(new.select(name)).where(F.col(name).isNotNull()).distinct()
    both.select(F.col(name).alias("value")).orderBy("value").write.text(path)
