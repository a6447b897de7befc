"""News tables on Parquet: append, read, rewrite."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace
from datetime import date
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wirelake import schemas
from wirelake.functions.times import coerce_timestamp
from wirelake.functions.words import label_as_list, label_list
from wirelake.operators.filters import may_be_among
from wirelake.operators.keyed import first_per_key, repeated_keys
from wirelake.session import shuffles_removed
from wirelake.sources.rewrites import current_places, read_current, take_out

@dataclass(frozen=True)
class Table:
    schema: T.StructType
    time: str  # column that the partition is derived from
    sort: str  # column that rows are sorted by within a file
    period: str  # "day", or "month" for tables of a few rows a day


TABLES = {
    "collected_articles": Table(schemas.ARTICLES, "collection_timestamp", "url", "day"),
    "article_enrichments": Table(schemas.ENRICHMENTS, "enrichment_timestamp", "url", "day"),
    "run_queries": Table(schemas.RUN_QUERIES, "event_timestamp", "query", "month"),
    "run_companies": Table(schemas.RUN_COMPANIES, "event_timestamp", "company", "month"),
    "scrape_errors": Table(schemas.SCRAPE_ERRORS, "timestamp", "url", "day"),
    "filtered_links": Table(schemas.FILTERED_LINKS, "timestamp", "url", "day"),
    "run_events": Table(schemas.RUN_EVENTS, "event_timestamp", "run_id", "month"),
}


def write_partitioned(df: DataFrame, path: str, time: str, sort: str, period: str = "day", mode: str = "append") -> int:
    """Partitions of a day or month, sorted by key, so that row groups can be skipped.

    Rebalancing lets AQE cut a large partition into several files and write small ones together. Files are compressed by
    zstd, which takes a third less for texts than Spark's default. Returns the number of rows, counted while they are written.
    """
    first_day = F.to_date(F.date_trunc(period, time))
    parts = df.withColumn(period, first_day).hint("rebalance", F.col(period))
    written = Observation()
    counted = parts.sortWithinPartitions(period, sort).observe(written, F.count("*").alias("rows"))
    with shuffles_removed(df.sparkSession):
        counted.write.mode(mode).partitionBy(period).parquet(path, compression="zstd")
    return written.get["rows"]


class NewsStore:
    """The append-only tables under one root folder.

    `periods` gives tables another partition than TABLES does: a table of many days with few rows each, as a backfill leaves
    it, costs a file a day, so its time goes by its days and not by its rows; such a table is better kept by "month". A
    store is always opened with the periods that it was begun with.
    """

    def __init__(self, spark: SparkSession, root: str, periods: dict[str, str] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.tables = {name: replace(table, period=(periods or {}).get(name, table.period)) for name, table in TABLES.items()}

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def create_tables(self) -> None:
        """Writes each table that does not exist yet, without rows."""
        for name, table in self.tables.items():
            if not self._exists(name):
                self._append(self.spark.createDataFrame([], table.schema), name)

    def _exists(self, name: str) -> bool:
        try:
            self.spark.read.schema(self.tables[name].schema).parquet(self.path(name)).schema
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return False
            raise
        return True

    def rows_of_run(self, name: str, run_id: str, where: str = "true") -> int:
        """Rows that a run wrote to a table; 0 for a table that is not there yet. Partitions before its first start are not read."""
        if not self._exists(name):
            return 0
        begun = self.read("run_events").where(F.col("run_id") == run_id).agg(F.min("event_timestamp").alias("t")).first()["t"]
        rows = self.read(name) if begun is None else self.read(name, begun.date())
        return rows.where(F.col("run_id") == run_id).where(where).count()

    def _append(self, df: DataFrame, name: str) -> int:
        table = self.tables[name]
        return write_partitioned(schemas.conform(df, table.schema), self.path(name), table.time, table.sort, table.period)

    def read(self, name: str, first: date | str | None = None, last: date | str | None = None) -> DataFrame:
        """A table, or its days from `first` to `last`.

        The bounds are put on the partition column too, so other partitions are not read.
        """
        table = self.tables[name]
        df = read_current(self.spark, self.path(name), self._stored(name))
        part, at = F.col(table.period), F.to_date(table.time)
        if first is not None:
            day = F.lit(str(first)).cast("date")
            df = df.where((part >= F.trunc(day, "month") if table.period == "month" else part >= day) & (at >= day))
        if last is not None:
            day = F.lit(str(last)).cast("date")
            df = df.where((part <= day) & (at <= day))
        return df

    def _stored(self, name: str) -> T.StructType:
        table = self.tables[name]
        return T.StructType([*table.schema.fields, T.StructField(table.period, T.DateType())])

    def remove_duplicates(self, name: str, key: str, *order: str) -> int:
        """Leaves the first row of each key in the order of these columns; returns the number of rows taken out.

        Days (or months, by the table's period) that have lost a quarter of their rows are written anew, of the others the
        places of the rows are listed, and readers see the old rows or the new ones. Keys of the whole table are moved; the
        order columns, which may be long, only of rows that a Bloom filter of the repeated keys lets through. Equal rows
        count as repeated."""
        table = self.tables[name]
        period, schema = table.period, self._stored(name)
        at = [period, "_file", "_row"]

        def write(rows: DataFrame, path: str) -> int:
            return write_partitioned(rows.drop(period), path, table.time, table.sort, period)

        with shuffles_removed(self.spark):
            placed = current_places(self.spark, self.path(name), schema)
            stored = f"{self.path(name)}.repeated/{uuid.uuid4().hex}"
            repeated_keys(placed.select(key), key).select(key).write.parquet(stored)
            repeated = self.spark.read.schema(placed.select(key).schema).parquet(stored)
            if not (n := repeated.count()):
                return 0
            among = F.col(key).isNull() | may_be_among(key, repeated, key, n)
            doubtful = placed.select(*dict.fromkeys([key, *order, *at])).where(among)
            firsts = first_per_key(doubtful, key, *[F.col(c) for c in (*order, *at)]).select(*[F.col(c).alias(f"first {c}") for c in at])
            gone = doubtful.select(*at).join(firsts, reduce(and_, [F.col(c).eqNullSafe(F.col(f"first {c}")) for c in at]), "left_anti")
            return take_out(self.spark, self.path(name), schema, gone, write)

    def append_articles(self, df: DataFrame, run_id: Column, at: Column) -> int:
        return self._append(stamp_articles(df, run_id, at), "collected_articles")

    def append_enrichments(self, df: DataFrame, run_id: Column, at: Column, version: str = "v1.0") -> int:
        return self._append(stamp_enrichments(df, run_id, at, version), "article_enrichments")

    def append_queries(self, queries: DataFrame, run_id: Column, at: Column) -> int:
        """Logs the queries that a run executed, each once."""
        once = queries.select("query").distinct()
        return self._append(once.withColumn("run_id", run_id).withColumn("event_timestamp", at), "run_queries")

    def append_companies(self, companies: DataFrame, run_id: Column, at: Column) -> int:
        """Logs the companies of a run, each once and all of them."""
        once = companies.select("company").where("company IS NOT NULL").distinct()
        return self._append(once.withColumn("run_id", run_id).withColumn("event_timestamp", at), "run_companies")

    def append_errors(self, errors: DataFrame, run_id: Column) -> int:
        return self._append(errors.withColumn("run_id", run_id), "scrape_errors")

    def append_filtered(self, links: DataFrame, run_id: Column, at: Column) -> int:
        return self._append(links.withColumn("run_id", run_id).withColumn("timestamp", at), "filtered_links")

    def append_events(self, events: DataFrame) -> int:
        return self._append(events, "run_events")


def stamp_articles(df: DataFrame, run_id: Column, at: Column) -> DataFrame:
    """Rows ready for `collected_articles`; a publish date in text form is parsed, or null where it cannot be."""
    df = schemas.rename_aliases(df, schemas.ARTICLES)
    if "url" not in df.columns:
        raise ValueError("article rows need a url or a link column")
    if dict(df.dtypes).get("publish_date") == "string":
        df = df.withColumn("publish_date", coerce_timestamp(F.col("publish_date")))
    return schemas.conform(df.withColumn("run_id", run_id).withColumn("collection_timestamp", at), schemas.ARTICLES)


def stamp_enrichments(df: DataFrame, run_id: Column, at: Column, version: str = "v1.0") -> DataFrame:
    """Rows ready for `article_enrichments`; labels become lists, a missing list is empty."""
    for name in ("issue_labels", "entity_labels"):
        kind = dict(df.dtypes).get(name)
        if kind is None:
            df = df.withColumn(name, F.array().cast("array<string>"))
        elif kind.startswith("array"):
            df = df.withColumn(name, label_list(F.col(name)))
        else:
            df = df.withColumn(name, label_as_list(F.col(name).cast("string")))
    df = df.withColumn("run_id", run_id).withColumn("enrichment_timestamp", at).withColumn("enrichment_version", F.lit(version))
    return schemas.conform(df, schemas.ENRICHMENTS)


def rewrite_without_duplicates(df: DataFrame, path: str, key: str, time: str, *order: Column, period: str = "day") -> int:
    """Writes the first row of each key to a new path; the caller swaps the paths afterwards."""
    return write_partitioned(first_per_key(df, key, *order), path, time, key, period, mode="errorifexists")


def storage_size(df: DataFrame) -> DataFrame:
    """Files, bytes and rows behind a Parquet frame."""
    files = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.max("_metadata.file_size").alias("bytes"), F.count("*").alias("rows")
    )
    return files.agg(F.count("*").alias("n_files"), F.sum("bytes").alias("n_bytes"), F.sum("rows").alias("n_rows"))
