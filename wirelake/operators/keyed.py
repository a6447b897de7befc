"""First, last and numbered rows per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def first_per_key(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """The first row of each key in a total order.

    The filter on `row_number` becomes a WindowGroupLimit, which keeps one row per key in every map
    task before the shuffle, so a key with a third of all rows still sends one row per task.
    """
    position = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_position", position).where(F.col("_position") == 1).drop("_position")


def latest_value(df: DataFrame, key: str, at: Column, *values: Column) -> DataFrame:
    """Values of the row with the greatest `at` per key.

    Aggregated before the shuffle: one row per key and map task moves. Spark sorts for it, since the values are not of
    fixed width; a window with a group limit sorts as much.
    """
    picked = F.max_by(F.struct(*values), at).alias("_picked")
    return df.groupBy(key).agg(picked).select(key, "_picked.*")


def numbered(df: DataFrame, key: str, order: str, name: str, chunk: int = 1 << 20) -> DataFrame:
    """Position (from 1) of each row within its key, in the order of the unique integer `order`.

    A plain window would sort all rows of a key in one task. Here `order` is cut into chunks of `chunk`
    consecutive values: rows are numbered inside (key, chunk), which holds at most `chunk` rows, and
    moved up by the number of rows in the key's earlier chunks.
    """
    cut = df.withColumn("_chunk", F.expr(f"{order} div {chunk}"))
    sizes = cut.groupBy(key, "_chunk").agg(F.count("*").alias("_size"))
    before = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col(key).alias("_key"), F.col("_chunk").alias("_start_chunk"),
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"),
    )
    inside = F.row_number().over(Window.partitionBy(key, "_chunk").orderBy(order))
    joined = cut.withColumn("_inside", inside).join(
        starts, F.col(key).eqNullSafe(F.col("_key")) & F.col("_chunk").eqNullSafe(F.col("_start_chunk"))
    )
    return joined.withColumn(name, F.col("_start") + F.col("_inside")).drop(
        "_chunk", "_inside", "_key", "_start_chunk", "_start", "_size"
    )


def repeated_keys(df: DataFrame, key: str, name: str = "n") -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(key).agg(F.count("*").alias(name)).where(F.col(name) > 1)
