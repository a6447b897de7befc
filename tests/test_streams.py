from datetime import datetime

from pyspark.sql import functions as F

from wirelake.operators.keyed import first_per_key
from wirelake.session import scratch_path
from wirelake.streaming import incremental

SCHEMA = "url string, n int, at timestamp_ntz"


def add(spark, path, *rows):
    spark.createDataFrame([(u, n, datetime(2026, 1, n)) for u, n in rows], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return incremental.read_new_files(spark, path, spark.createDataFrame([], SCHEMA).schema)


def once(batch):
    return first_per_key(batch, "url", F.asc("n"))


def test_runs_continue_where_the_last_one_ended(spark):
    base = scratch_path(spark, "s")
    source, out, keys, table = (f"{base}/{n}" for n in ("in", "out", "keys", "table"))

    def run():
        incremental.ingest(stream(spark, source), out, f"{base}/c1")
        incremental.ingest(incremental.new_keys(stream(spark, source), "url"), keys, f"{base}/c2")
        incremental.ingest(incremental.new_keys(stream(spark, source), "url", F.col("n"), 3), f"{keys}2", f"{base}/c4")
        incremental.append_new(stream(spark, source), "url", once, table, f"{base}/c3")

    add(spark, source, ("a", 2), ("a", 1), ("b", 3))
    run()
    run()
    add(spark, source, ("b", 4), ("c", 5), ("c", 6))
    run()
    run()
    assert spark.read.parquet(out).count() == 6
    assert sorted(r.url for r in spark.read.parquet(keys).collect()) == ["a", "b", "c"]
    assert sorted(r.url for r in spark.read.parquet(f"{keys}2").collect()) == ["a", "b", "c"]
    rows = spark.read.parquet(table)
    assert sorted((r.url, r.n, r.batch) for r in rows.collect()) == [("a", 1, 0), ("b", 3, 0), ("c", 5, 1)]
    whole = {r.url: r.n for r in spark.read.parquet(keys).collect()}
    assert whole["a"] in (1, 2) and whole["b"] in (3, 4) and whole["c"] in (5, 6)


def test_new_checkpoint_keeps_the_table(spark):
    base = scratch_path(spark, "s")
    source, table = f"{base}/in", f"{base}/table"
    add(spark, source, ("a", 2), ("b", 3))
    incremental.append_new(stream(spark, source), "url", once, table, f"{base}/c1")
    add(spark, source, ("z", 9), ("a", 1))
    # the checkpoint is lost: all files are read again, by batches that are numbered from 0
    incremental.append_new(stream(spark, source), "url", once, table, f"{base}/c2")
    assert sorted((r.url, r.n) for r in spark.read.parquet(table).collect()) == [("a", 2), ("b", 3), ("z", 9)]


def test_keys_within_a_delay(spark):
    """A key counts once within the delay, again after it, and its state goes; late rows are dropped."""
    base = scratch_path(spark, "s")
    source, out = f"{base}/in", f"{base}/out"

    def run(*rows):
        add(spark, source, *rows)
        found = incremental.new_keys_within(stream(spark, source), "url", "at", "3 days")
        query = found.writeStream.format("parquet").option("checkpointLocation", f"{base}/c").trigger(availableNow=True).start(out)
        query.awaitTermination()
        return sorted((r.url, r.n) for r in spark.read.parquet(out).collect()), [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]

    rows, _ = run(("a", 1), ("b", 2), ("c", 2))
    assert rows == [("a", 1), ("b", 2), ("c", 2)]
    rows, _ = run(("a", 3))  # within the delay
    assert rows == [("a", 1), ("b", 2), ("c", 2)]
    _, state = run(("d", 20))  # the watermark passes all others
    assert state[-1] == 1
    rows, _ = run(("a", 21), ("late", 5))
    assert rows == [("a", 1), ("a", 21), ("b", 2), ("c", 2), ("d", 20)]
