"""Table schemas, and fitting a frame to one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType] | tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


STRING, LONG, DOUBLE, TS = T.StringType(), T.LongType(), T.DoubleType(), T.TimestampNTZType()
LABELS = T.ArrayType(STRING)

REFERENCE = _schema(("id", LONG), ("corporation", STRING), ("sector", STRING), ("newsroom_url", STRING))

ARTICLES = _schema(
    ("url", STRING, False), ("title", STRING), ("description", STRING), ("rank", LONG), ("query", STRING),
    ("article_text", STRING), ("summary", STRING), ("keywords", STRING), ("publish_date", TS),
    ("scraper_used", STRING), ("collection_timestamp", TS, False), ("run_id", STRING),
)

ENRICHMENTS = _schema(
    ("url", STRING, False), ("sentiment", STRING), ("sentiment_score", DOUBLE), ("issue_labels", LABELS),
    ("entity_labels", LABELS), ("custom_metadata", STRING), ("enrichment_timestamp", TS, False),
    ("enrichment_version", STRING), ("run_id", STRING),
)

# One row per state change of a run; the current state is the last row.
RUN_EVENTS = _schema(
    ("run_id", STRING, False), ("seq", T.IntegerType(), False), ("status", STRING, False),
    ("start_date", T.DateType()), ("end_date", T.DateType()),
    ("queries_count", LONG), ("urls_collected", LONG), ("articles_scraped", LONG),
    ("event_timestamp", TS, False), ("error_message", STRING),
)

# Executed queries are rows, not an array in the run, so that a run can hold any number of them.
RUN_QUERIES = _schema(("run_id", STRING, False), ("query", STRING, False), ("event_timestamp", TS, False))

RUN_COMPANIES = _schema(("run_id", STRING, False), ("company", STRING, False), ("event_timestamp", TS, False))

ERRORS = _schema(("url", STRING), ("error_type", STRING), ("error_message", STRING), ("timestamp", TS))

# The same list, and the links that were left out, as tables.
SCRAPE_ERRORS = _schema(("url", STRING), ("error_type", STRING), ("error_message", STRING), ("timestamp", TS, False), ("run_id", STRING))
FILTERED_LINKS = _schema(("url", STRING), ("rule", STRING), ("reason", STRING), ("timestamp", TS, False), ("run_id", STRING))

# Other spellings under which a column may arrive.
ALIASES = {
    "Company": "corporation",
    "pressroom_url": "newsroom_url",
    "link": "url",
}


def rename_aliases(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rename a column to its schema name where only the alias is present."""
    for alias, name in ALIASES.items():
        if name in schema.names and name not in df.columns and alias in df.columns:
            df = df.withColumnRenamed(alias, name)
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Known columns only, in schema order and type; absent ones are null.

    A required column that is absent is an error, as a null there would be written silently.
    """
    df = rename_aliases(df, schema)
    missing = [f.name for f in schema if not f.nullable and f.name not in df.columns]
    if missing:
        raise ValueError(f"required columns are missing: {', '.join(missing)}")
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
    ])
