"""The company list: scan, and choice between cached copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wirelake.functions.links import usable_url

CACHE_HOURS = 24  # Fixed value: age at which a copy is no longer used.


def scan_reference(table: DataFrame, flag: str) -> DataFrame:
    """Companies of the flagged list that have a newsroom."""
    return table.where(F.col(flag) & F.col("newsroom_url").isNotNull()).select("corporation", "sector", "newsroom_url")


def with_usable_url(reference: DataFrame) -> DataFrame:
    """Rows with a usable newsroom address, without its padding."""
    return reference.withColumn("newsroom_url", usable_url(F.col("newsroom_url"))).where("newsroom_url IS NOT NULL")


def choose_snapshot(
    snapshots: DataFrame, as_of: Column, hours: int = CACHE_HOURS, fresh: DataFrame | None = None, force: bool = False
) -> DataFrame:
    """Rows of the copy to use: the newest one younger than `hours`, else the fresh list, else the newest of any age.

    `snapshots` has `snap_id` and `loaded_at`; `force` passes over the young copies.
    """
    versions = snapshots.where(F.col("loaded_at") <= as_of).groupBy("snap_id").agg(F.max("loaded_at").alias("loaded_at"))
    newest = F.max_by("snap_id", F.struct("loaded_at", "snap_id"))
    young = versions.where(F.col("loaded_at") > as_of - F.make_dt_interval(F.lit(0), F.lit(hours)))
    stale_id, young_id = versions.select(newest).scalar(), young.select(newest).scalar()
    if force:
        young_id = F.lit(None).cast(versions.schema["snap_id"].dataType)
    if fresh is None:
        return snapshots.where(F.col("snap_id") == F.coalesce(young_id, stale_id))
    any_fresh = fresh.select(F.count("*")).scalar() > 0
    chosen = F.coalesce(young_id, F.when(~any_fresh, stale_id))
    cached = snapshots.where(F.col("snap_id") == chosen)
    now = fresh.where(young_id.isNull())
    return cached.unionByName(now, allowMissingColumns=True)
