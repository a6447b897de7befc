"""Session settings the jobs are tuned for, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where the split costs another exchange later in the plan.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Keys seen by a stream stay on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "wirelake", **overrides: str) -> SparkSession:
    """Session with the settings above. The number of shuffle partitions is the cluster's choice
    (``spark.sql.adaptive.coalescePartitions.initialPartitionNum``); AQE merges small ones."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Actions inside remove their shuffle files when they end; else these stay until the driver happens to collect garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """New path under the shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is used only with a local master, where driver and tasks share one disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/wirelake-{name}-{uuid.uuid4().hex}"
