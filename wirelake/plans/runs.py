"""Run log as events: a run starts, then completes or fails; the current state is its last event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wirelake import schemas
from wirelake.operators.keyed import latest_value

def start_events(runs: DataFrame, at: Column) -> DataFrame:
    """Start event of each row of `run_id, start_date, end_date`. The run's companies are rows of a table of their own."""
    events = runs.select(
        "run_id", F.lit(0).alias("seq"), F.lit("started").alias("status"), "start_date", "end_date", at.alias("event_timestamp")
    )
    return schemas.conform(events, schemas.RUN_EVENTS)


def end_events(runs: DataFrame, at: Column) -> DataFrame:
    """Terminal event of each row of `run_id` and counts: failed if and only if there is an error text."""
    status = F.when(F.col("error_message").isNull(), "completed").otherwise("failed")
    events = runs.withColumn("seq", F.lit(1)).withColumn("status", status).withColumn("event_timestamp", at)
    return schemas.conform(events, schemas.RUN_EVENTS)


def _place() -> Column:
    """Order of a run's events: by time, and at equal times the end after the start."""
    return F.struct("event_timestamp", "seq", "status")


def run_states(events: DataFrame, *columns: str) -> DataFrame:
    """Last state of each run."""
    return latest_value(events, "run_id", _place(), *[F.col(c) for c in columns])


def run_rows(events: DataFrame) -> DataFrame:
    """The run table as one row per run: dates from the last start, counts and outcome from the last end if there is one.

    A run that is repeated after a failure has the outcome of its last end, with that event's counts and message.
    """
    begun, ended = F.col("seq") == 0, F.col("seq") == 1
    start = F.max_by(F.struct("start_date", "end_date", "event_timestamp"), F.when(begun, _place()))
    end = F.max_by(
        F.struct("queries_count", "urls_collected", "articles_scraped", "status", "event_timestamp", "error_message"), F.when(ended, _place())
    )
    rows = events.groupBy("run_id").agg(start.alias("s"), end.alias("e"))
    return rows.select(
        "run_id", "s.start_date", "s.end_date", "e.queries_count", "e.urls_collected", "e.articles_scraped",
        F.coalesce("e.status", F.lit("started")).alias("status"), F.col("s.event_timestamp").alias("start_timestamp"),
        F.col("e.event_timestamp").alias("end_timestamp"), "e.error_message",
    )
