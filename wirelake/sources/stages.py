"""Stage tables: results of a run kept under its id, with a registry of what was kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REGISTRY = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("saved_at", T.TimestampNTZType()),
])


class StageStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def registry(self) -> DataFrame:
        return self.spark.read.schema(REGISTRY).parquet(f"{self.root}/registry")

    def save(self, df: DataFrame, run_id: str, stage: str, at: str, description: str = "") -> None:
        """Writes the stage, then its registry row, so a stage that is listed is whole."""
        path = f"{self.root}/data/{run_id}/{stage}"
        df.write.mode("overwrite").parquet(path)
        row = self.spark.range(1).select(
            F.lit(run_id).alias("run_id"), F.lit(stage).alias("stage"), F.lit(path).alias("path"),
            F.lit(description).alias("description"), F.lit(at).cast("timestamp_ntz").alias("saved_at"),
        )
        row.write.mode("append").parquet(f"{self.root}/registry")

    def keeper(self, run_id: str, at: str) -> Callable[[DataFrame, str], DataFrame]:
        """A function that saves a frame as a stage of the run and reads it back.

        A stage that the run has already is read and not made again, so a run that is repeated goes on where it ended.
        """
        def keep(df: DataFrame, stage: str) -> DataFrame:
            kept = self.load(run_id, stage)
            if kept is None:
                self.save(df, run_id, stage, at)
                kept = self.load(run_id, stage)
            return kept

        return keep

    def load(self, run_id: str, stage: str) -> DataFrame | None:
        """The stage as last saved, or None if the run has no such stage."""
        try:
            entries = self.registry()
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":  # nothing was kept yet
                return None
            raise
        entry = entries.where((F.col("run_id") == run_id) & (F.col("stage") == stage)).select("path").first()
        return None if entry is None else self.spark.read.parquet(entry.path)


def latest_run_stages(registry: DataFrame) -> DataFrame:
    """Stages of the newest run, by run id; no rows if nothing was kept."""
    return registry.where(F.col("run_id") == registry.select(F.max("run_id")).scalar())


def run_stages(registry: DataFrame, run_id: Column) -> DataFrame:
    return registry.where(F.col("run_id") == run_id)
