"""Key operators against brute force, with one key that holds a third of the rows."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from wirelake.operators import filters, joins, keyed

RNG = random.Random(7)
ROWS = [(i, "hot" if RNG.random() < 0.35 else f"k{RNG.randrange(40)}" if RNG.random() < 0.95 else None, RNG.randrange(5)) for i in range(600)]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "id long, key string, v int").repartition(6)


def as_set(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("chunk", [1, 7, 1 << 20])
def test_numbered(rows, chunk):
    got = {r.id: r.n for r in keyed.numbered(rows, "key", "id", "n", chunk).collect()}
    seen, wanted = {}, {}
    for i, key, _ in ROWS:
        seen[key] = seen.get(key, 0) + 1
        wanted[i] = seen[key]
    assert got == wanted


def test_first_and_latest(rows):
    first = {r.key: r.id for r in keyed.first_per_key(rows, "key", F.asc("v"), F.desc("id")).collect()}
    latest = {r.key: r.id for r in keyed.latest_value(rows, "key", F.struct("v", "id"), F.col("id")).collect()}
    for key in {k for _, k, _ in ROWS}:
        mine = [(v, i) for i, k, v in ROWS if k == key]
        assert first[key] == min(mine, key=lambda t: (t[0], -t[1]))[1]
        assert latest[key] == max(mine)[1]


def test_partial_limit_before_the_shuffle(rows):
    plan = keyed.first_per_key(rows, "key", F.asc("id"))._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_without(spark, rows):
    known = spark.createDataFrame([("hot",), ("k3",), (None,)], "k string")
    got = sorted(r.id for r in joins.without(rows, known, "key", "k").collect())
    assert got == [i for i, k, _ in ROWS if k not in ("hot", "k3")]


@pytest.mark.parametrize("bucket", [1, 10, 31])
def test_overlapping(spark, bucket):
    day = date(2023, 12, 1)
    def ranges(n, longest):
        out = []
        for i in range(n):
            start = day + timedelta(days=RNG.randrange(90))
            out.append((i, start, start + timedelta(days=RNG.randrange(-1, longest))))
        return out
    a, b = ranges(30, 70), ranges(80, 12)
    left = spark.createDataFrame(a, "a long, a1 date, a2 date")
    right = spark.createDataFrame(b, "b long, b1 date, b2 date")
    got = sorted((r.a, r.b) for r in joins.overlapping(left, right, ("a1", "a2"), ("b1", "b2"), bucket).collect())
    assert got == sorted((x[0], y[0]) for x in a for y in b if x[1] <= y[2] and x[2] >= y[1] and x[1] <= x[2] and y[1] <= y[2])


@pytest.mark.parametrize("bucket", [1, 10, 31])
def test_contained(spark, bucket):
    day = date(2023, 12, 1)
    def ranges(n, longest):
        starts = [day + timedelta(days=RNG.randrange(90)) for _ in range(n)]
        return [(i, s, s + timedelta(days=RNG.randrange(-1, longest))) for i, s in enumerate(starts)]
    a, b = ranges(30, 70), ranges(80, 12)
    outer, inner = spark.createDataFrame(a, "a long, a1 date, a2 date"), spark.createDataFrame(b, "b long, b1 date, b2 date")
    got = sorted((r.a, r.b) for r in joins.contained(outer, inner, ("a1", "a2"), ("b1", "b2"), bucket).collect())
    assert got == sorted((x[0], y[0]) for x in a for y in b if x[1] <= y[1] <= y[2] <= x[2])


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_bloom_filter(spark, n):
    """No key is lost, and few others pass."""
    keys = spark.range(n).select(F.concat(F.lit("k"), F.col("id") * 7).alias("k")).union(spark.createDataFrame([(None,)], "k string"))
    rows = spark.range(100_000).select(F.concat(F.lit("k"), "id").alias("url")).union(spark.createDataFrame([(None,)], "url string"))
    passed = rows.where(filters.may_be_among("url", keys, "k", n + 1))
    assert passed.join(keys.withColumnRenamed("k", "url"), "url", "left_semi").count() == min(n, 100_000 // 7 + 1)
    assert passed.count() <= n + 1000 and passed.where("url IS NULL").count() == 0


def test_bloom_filter_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(filters, "MOST_BITS", 1 << 12)
    keys = spark.range(20_000).select(F.col("id").alias("k"))
    assert filters.bloom_filter(keys, "k", filters.filter_bits(20_000)).select(F.size("filter")).first()[0] == 64
    assert spark.range(20_000).where(filters.may_be_among("id", keys, "k", 20_000)).count() == 20_000


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["left", "left_anti", "left_semi"])
def test_adaptive_plan_splits_a_hot_key(spark, how):
    """The joins that go without salt: AQE divides the hot key among tasks, at sizes lowered to the test's."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
        left = spark.range(0, 60_000, 1, 8).select("id", key.alias("link"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        right = left.where("link <> 'hot' AND id % 2 = 0").select("link").union(spark.range(1).select(F.lit("hot" if how != "left_anti" else "no")))
        joined = left.join(right, "link", how)
        assert "skew=true" in final_plan(joined)
        hot = joined.where("link = 'hot'").count()
        assert hot == 20_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
