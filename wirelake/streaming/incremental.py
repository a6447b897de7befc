"""Scheduled runs that handle only what is new, as streams that stop when the input is read.

Each job takes a checkpoint location; a run after the first one continues where the last one ended.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_new_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Stream over the Parquet files under a path."""
    return spark.readStream.schema(schema).parquet(path)


def ingest(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Appends the rows of files that no earlier run has read."""
    query = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
    query.awaitTermination()


def new_keys(stream: DataFrame, key: str, spread: Column | None = None, places: int = 16) -> DataFrame:
    """The first row of each key over all runs, whole. The state keeps every key for good, on disk with RocksDB.

    A stream has no map-side combine and no adaptive split. Where one key may be on very many rows, give `spread`, a
    column that differs between them: rows of a key then go to `places` tasks first, which pass on one each.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    if spread is None:
        return stream.dropDuplicates([key])
    place = F.pmod(F.xxhash64(spread), F.lit(places))
    return stream.withColumn("_place", place).dropDuplicates([key, "_place"]).drop("_place").dropDuplicates([key])


def new_keys_within(stream: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """The first row of each key within ``delay`` (like "30 days") of its time, with a state that is bounded by it.

    A key is forgotten once the watermark (the newest time seen, less the delay) has passed its row's time plus the delay; a
    row of the key that comes after that counts as new. Rows whose own time is behind the watermark are dropped. A null time
    is dropped by no watermark, but the key is then never forgotten, so rows without a time are left out.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    timed = stream.where(F.col(time).isNotNull()).withColumn("_event_time", F.col(time).cast("timestamp"))
    return timed.withWatermark("_event_time", delay).dropDuplicatesWithinWatermark([key]).drop("_event_time")


def append_new(
    stream: DataFrame, key: str, once: Callable[[DataFrame], DataFrame], table: str, checkpoint: str
) -> None:
    """Appends rows whose key the table does not have yet.

    `once` reduces a batch to one row per key. A batch writes to a partition of its own, named by the stream (the id in
    its checkpoint) and the batch, and replaces it if it runs again. The keys of all other partitions are known, so a
    repeated batch gives the same rows, and a stream with a new checkpoint neither replaces nor repeats any.
    Only the key column of the table is read.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream_id = spark.read.json(f"{checkpoint}/metadata").first()["id"]
        own = f"{table}/stream={stream_id}/batch={batch_id}"
        here = (F.col("stream") == stream_id) & (F.col("batch") == batch_id)
        known = spark.read.schema(stored).parquet(table).where(~here).select(key)
        once(batch).join(known, key, "left_anti").select(*batch.columns).write.mode("overwrite").parquet(own)

    stored = T.StructType([*stream.schema.fields, T.StructField("stream", T.StringType()), T.StructField("batch", T.LongType())])
    # an empty table to begin with
    stream.sparkSession.createDataFrame([], stored).write.mode("append").partitionBy("stream", "batch").parquet(table)
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
