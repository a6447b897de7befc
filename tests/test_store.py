import random
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from catalog.queries import QUERIES
from wirelake import schemas
from wirelake.session import scratch_path
from wirelake.plans import reports
from wirelake.sources import files, reference, stages, store


def at(text):
    return F.lit(text).cast("timestamp_ntz")


def articles(spark, *rows):
    return spark.createDataFrame(rows, "link string, title string, publish_date string, extra int")


def test_append_and_read_by_day(spark):
    news = store.NewsStore(spark, scratch_path(spark, "t"))
    news.create_tables()
    news.create_tables()
    assert news.read("collected_articles").count() == 0
    one = articles(spark, ("u1", "t", "2026-01-02", 1), ("u2", None, "no date", 2))
    assert news.append_articles(one, F.lit("r1"), at("2026-01-05 10:00:00")) == 2
    assert news.append_articles(one, F.lit("r2"), at("2026-01-06 23:59:59")) == 2
    assert news.append_articles(one.limit(0), F.lit("r3"), at("2026-01-07 00:00:00")) == 0
    assert news.read("collected_articles", "2026-01-06", "2026-01-06").select("run_id").distinct().collect() == [("r2",)]
    rows = {r.url: r for r in news.read("collected_articles", last="2026-01-05").collect()}
    assert rows["u1"].publish_date == datetime(2026, 1, 2) and rows["u2"].publish_date is None
    assert news.read("collected_articles").columns == [*schemas.ARTICLES.names, "day"]
    plan = news.read("collected_articles", "2026-01-06")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_large_day_is_cut_into_files(spark):
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 20_000, 1, 8).select(
            F.sha2(F.col("id").cast("string"), 256).alias("url"), F.when(F.col("id") % 100 == 0, at("2026-01-02 00:00:00"))
            .otherwise(at("2026-01-01 00:00:00")).alias("time"))
        path = scratch_path(spark, "cut")
        assert store.write_partitioned(rows, path, "time", "url") == 20_000
        files_of = spark.read.parquet(path).groupBy("day").agg(F.count_distinct("_metadata.file_path").alias("n"))
        counts = {str(r.day): r.n for r in files_of.collect()}
        assert counts["2026-01-01"] > 4 and counts["2026-01-02"] == 1
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_rows_without_url_are_refused(spark):
    news = store.NewsStore(spark, scratch_path(spark, "t"))
    with pytest.raises(ValueError):
        news.append_articles(spark.range(1), F.lit("r"), at("2026-01-05 10:00:00"))


def test_enrichment_labels(spark):
    rows = spark.createDataFrame([("u", ["a", "b"], "x"), ("v", None, "")], "url string, issue_labels array<string>, entity_labels string")
    out = store.stamp_enrichments(rows, F.lit("r"), at("2026-01-05 10:00:00"), "v2.0")
    assert out.schema.names == schemas.ENRICHMENTS.names
    assert [(r.issue_labels, r.entity_labels, r.enrichment_version) for r in out.orderBy("url").collect()] == [
        (["a", "b"], ["x"], "v2.0"), ([], [], "v2.0")]


def test_conform(spark):
    with pytest.raises(ValueError):
        schemas.conform(spark.range(1), schemas.ARTICLES)
    df = schemas.conform(spark.createDataFrame([("A", "p")], "Company string, pressroom_url string"), schemas.REFERENCE)
    assert df.collect() == [(None, "A", None, "p")]


def test_csv_quotes_and_blanks(spark):
    path = scratch_path(spark, "csv")
    rows = [(1, 'Merck "& Co", Inc', None, " padded "), (2, "", "x,y", '("a" OR "b")')]
    df = spark.createDataFrame(rows, schemas.REFERENCE)
    files.write_csv(df, path)
    assert sorted(files.read_csv(spark, path, schemas.REFERENCE).collect())[0] == rows[0]


def test_csv_line_breaks(spark):
    path = scratch_path(spark, "csv")
    rows = [(1, 'a\n"b",\r\nc', "\n", "\\"), (2, "x", None, "y\n")]
    files.write_csv(spark.createDataFrame(rows, schemas.REFERENCE), path)
    assert sorted(files.read_csv(spark, path, schemas.REFERENCE).collect()) == rows


def test_reports_read_the_partitions_in_question(spark):
    news = store.NewsStore(spark, scratch_path(spark, "t"))
    for day in range(1, 9):
        news.append_articles(articles(spark, (f"u{day}", "the title", None, 1)), F.lit("r"), at(f"2026-01-0{day} 10:00:00"))
    news.append_enrichments(spark.createDataFrame([("u8", "neutral")], "url string, sentiment string"), F.lit("r"), at("2026-01-08 11:00:00"))
    table, now = news.read("collected_articles"), at("2026-01-08 12:00:00")
    labels = news.read("article_enrichments").withColumn("tie", F.lit(0))
    asked = {
        "urls_in_range": (reports.urls_in_range(table, F.lit("2026-01-03"), F.lit("2026-01-04")), 2),
        "urls_since": (reports.urls_since(table, now, 2), 2),
        "title_search": (reports.title_search(table, "%the%", at("2026-01-07 00:00:00")), 2),
        "collected_on_day": (reports.collected_on_day(table, F.lit("2026-01-05").cast("date")), 1),
        "daily_collection": (reports.daily_collection(table, now, 3), 3),
        "coverage": (reports.coverage(table, labels, now, 3), 1),
        "articles_with_latest": (reports.articles_with_latest(table, labels, now, "tie", 3), 3),
        "recent_articles": (reports.recent_articles(table, now, 3), 3),
    }
    for name, (report, rows) in asked.items():
        assert report.count() == rows, name
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(day" in plan, name
    assert asked["collected_on_day"][0].first().articles == 1 and asked["coverage"][0].first().total_articles == 3


def test_line_list(spark):
    old = spark.createDataFrame([("b",), ("a",)], "url string")
    new = spark.createDataFrame([("a",), ("c",), (None,)], "url string")
    path = scratch_path(spark, "lines")
    files.add_lines(old, new, path)
    assert sorted(r.url for r in files.read_lines(spark, path).collect()) == ["a", "b", "c"]


def test_stages(spark):
    kept = stages.StageStore(spark, scratch_path(spark, "stages"))
    frame = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "a int, b string")
    kept.save(frame, "20260101_000000", "rows", "2026-01-01 00:00:00")
    kept.save(frame.limit(1), "20260102_000000", "rows", "2026-01-02 00:00:00", "one row")
    assert sorted(kept.load("20260101_000000", "rows").collect()) == sorted(frame.collect())
    assert kept.load("20260101_000000", "other") is None
    assert stages.latest_run_stages(kept.registry()).select("run_id", "stage", "description").collect() == [("20260102_000000", "rows", "one row")]
    assert stages.run_stages(kept.registry(), F.lit("20260101_000000")).count() == 1
    keep = kept.keeper("20260102_000000", "2026-01-02 00:00:00")
    assert keep(frame, "rows").count() == 1  # the run has this stage already
    assert keep(frame, "more").count() == 3


@pytest.mark.parametrize("now, force, fresh, wanted", [
    ("2026-01-02 11:00:00", False, None, {"new"}),  # age 23 h
    ("2026-01-02 12:00:00", False, None, {"new"}),  # age 24 h: stale, but nothing else is there
    ("2026-01-02 12:00:00", False, ["live"], {"live"}),
    ("2026-01-02 11:59:59", False, ["live"], {"new"}),
    ("2026-01-02 11:00:00", True, ["live"], {"live"}),
    ("2026-01-02 11:00:00", True, [], {"new"}),
    ("2026-01-05 12:00:00", False, [], {"new"}),
])
def test_snapshot_choice(spark, now, force, fresh, wanted):
    rows = [("old", 1, datetime(2026, 1, 1, 10)), ("new", 2, datetime(2026, 1, 1, 12))]
    snaps = spark.createDataFrame(rows, "corporation string, snap_id int, loaded_at timestamp_ntz")
    live = None if fresh is None else spark.createDataFrame([(f,) for f in fresh], "corporation string")
    got = reference.choose_snapshot(snaps, at(now), fresh=live, force=force)
    assert {r.corporation for r in got.collect()} == wanted


def test_storage_size_is_that_of_the_files(spark, tmp_path):
    """Bytes, files and rows against the file system; a filter reads the same files."""
    path = tmp_path / "table"
    spark.range(0, 5000, 1, 3).select("id", F.sha2(F.col("id").cast("string"), 256).alias("pad")).write.parquet(str(path))
    files = [f.stat().st_size for f in path.glob("*.parquet")]
    df = spark.read.parquet(str(path))
    assert tuple(store.storage_size(df).select("n_files", "n_bytes", "n_rows").first()) == (3, sum(files), 5000)


def article_rows(spark, rows):
    return spark.createDataFrame([(u, t, datetime(2026, 1, d, h)) for u, t, d, h in rows], "url string, title string, collection_timestamp timestamp_ntz")


def stored_files(path):
    return sorted(str(f.relative_to(path)) for f in path.rglob("*.parquet"))


def test_duplicates_leave_their_days_only(spark, tmp_path):
    """Readers before, during and after a rewrite; files of other days; rows appended later; a second rewrite."""
    news = store.NewsStore(spark, f"file://{tmp_path}")
    table = tmp_path / "collected_articles"

    def append(rows):
        df = article_rows(spark, rows)
        news.append_articles(df, F.lit("r"), F.col("collection_timestamp"))

    def rows():
        return sorted((r.url, r.title, r.collection_timestamp.day) for r in news.read("collected_articles").collect())

    append([("a", "first", 1, 1), ("a", "later", 1, 2), ("b", "b", 1, 3), ("c", "c", 2, 1), ("a", "again", 3, 1), ("d", "d", 3, 2), ("e", "only copies", 4, 1)])
    append([("e", "only copies", 4, 1)])
    before, old = rows(), news.read("collected_articles")
    files = stored_files(table)
    assert news.remove_duplicates("collected_articles", "url", "collection_timestamp", "title") == 3
    assert rows() == [("a", "first", 1), ("b", "b", 1), ("c", "c", 2), ("d", "d", 3), ("e", "only copies", 4)]
    assert stored_files(table) == files  # nothing is changed or deleted
    assert sorted((r.url, r.title, r.collection_timestamp.day) for r in old.collect()) == before  # a reader from before sees the old rows
    written = {p.split("/")[1] for p in stored_files(tmp_path / "collected_articles.rewrites")}
    assert written == {"day=2026-01-01", "day=2026-01-03", "day=2026-01-04"}
    assert news.remove_duplicates("collected_articles", "url", "collection_timestamp", "title") == 0

    append([("a", "third", 1, 9), ("f", "f", 1, 9), ("c", "earlier", 1, 0)])
    assert len(rows()) == 8
    # a rewrite that ends before its commit is never seen
    broken = tmp_path / "collected_articles.rewrites" / "rewrite=2" / "day=2026-01-01"
    article_rows(spark, [("x", "never seen", 1, 1)]).write.parquet(f"file://{broken}")
    assert news.remove_duplicates("collected_articles", "url", "collection_timestamp", "title") == 2
    assert rows() == [("a", "first", 1), ("b", "b", 1), ("c", "earlier", 1), ("d", "d", 3), ("e", "only copies", 4), ("f", "f", 1)]
    assert [r.url for r in news.read("collected_articles", "2026-01-03", "2026-01-03").collect()] == ["d"]


def test_days_are_pruned_after_a_rewrite(spark, tmp_path):
    news = store.NewsStore(spark, f"file://{tmp_path}")
    df = article_rows(spark, [("a", "x", d, h) for d in range(1, 6) for h in (1, 2)])
    news.append_articles(df, F.lit("r"), F.col("collection_timestamp"))
    news.remove_duplicates("collected_articles", "url", "collection_timestamp")
    plan = news.read("collected_articles", "2026-01-02", "2026-01-02")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line and "collection_timestamp" in line]
    assert len(scans) == 2 and all("day" in line.split("PartitionFilters: [")[1].split("]")[0] for line in scans)


def test_few_duplicates_are_listed_and_many_rewritten(spark, tmp_path):
    """Rows taken out of long files in several rounds, against a plain list; equal rows, null keys, titles and times."""
    news = store.NewsStore(spark, f"file://{tmp_path}")
    order = ["collection_timestamp", "title"]
    pick = random.Random(5)
    plain = []

    def append(rows):
        kind = "url string, title string, collection_timestamp timestamp_ntz"
        news.append_articles(spark.createDataFrame(rows, kind), F.lit("r"), F.col("collection_timestamp"))
        plain.extend(rows)

    def first_rows():
        least = {}
        for url, title, time in plain:
            rank = (time is not None, time or datetime.min, title is not None, title or "")
            mine = rank, (url, title, time)
            least[url] = min(least.get(url, mine), mine, key=lambda x: x[0])
        return [row for _, row in least.values()]

    def told(rows):
        return sorted(map(repr, rows))

    def rewritten():
        return {p.split("/")[1] for p in stored_files(tmp_path / "collected_articles.rewrites")}

    append([(f"u{n}", f"t{n}", datetime(2026, 1, 1 + n % 2, 1)) for n in range(600)])
    append([(f"u{n * 7}", pick.choice(["a", None]), datetime(2026, 1, 1 + n % 2, pick.randrange(3))) for n in range(40)])
    append([(None, "x", datetime(2026, 1, 1, 5)), (None, None, datetime(2026, 1, 2, 5)), ("n", "y", None), ("n", "y", None), ("u3", "z", None)])
    files = stored_files(tmp_path / "collected_articles")
    for fresh in ([], [(f"u{n}", "again", datetime(2026, 1, 1 + n % 2, 0)) for n in range(80, 100)]):
        if fresh:
            append(fresh)
        wanted = first_rows()
        assert news.remove_duplicates("collected_articles", "url", *order) == len(plain) - len(wanted) > 0
        plain[:] = wanted
        assert told((r.url, r.title, r.collection_timestamp) for r in news.read("collected_articles").collect()) == told(wanted)
        assert news.remove_duplicates("collected_articles", "url", *order) == 0
        assert not rewritten() and set(files) <= set(stored_files(tmp_path / "collected_articles"))
    # the first day loses a quarter, counted with the places listed before
    append([(f"u{n * 2}", None, datetime(2026, 1, 1, 0)) for n in range(100)])
    wanted = first_rows()
    assert news.remove_duplicates("collected_articles", "url", *order) == len(plain) - len(wanted)
    assert told((r.url, r.title, r.collection_timestamp) for r in news.read("collected_articles").collect()) == told(wanted)
    assert rewritten() == {"day=2026-01-01"}


def test_writing_and_removing_leave_no_shuffle_files(spark, tmp_path):
    """They would take the disk of every text that was moved until the driver collects garbage."""
    def shuffles():
        folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
        return {str(f) for folder in folders for f in Path(folder.getPath()).rglob("shuffle_*.data")}

    rows = spark.range(5000).select(F.concat(F.lit("u"), F.col("id") % 4900).alias("url"), F.repeat(F.col("id").cast("string"), 50).alias("title"))
    before = shuffles()
    news = store.NewsStore(spark, f"file://{tmp_path}")
    news.append_articles(rows, F.lit("r"), at("2026-01-01 00:00:00"))
    assert news.remove_duplicates("collected_articles", "url", "collection_timestamp", "title") == 100
    assert not shuffles() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_sketches_of_days(spark):
    """Merged sketches stay within their error bound, whatever the days share."""
    rows = spark.range(60_000).select(
        F.concat(F.lit("u"), F.col("id") % 20_000).alias("url"), F.expr("TIMESTAMP_NTZ '2026-01-01' + make_dt_interval(CAST(id % 45 AS INT))").alias("collection_timestamp"))
    daily = reports.daily_sketches(rows)
    assert daily.count() == 45
    got = {r.span.month: (r.articles, r.distinct_urls) for r in reports.distinct_urls(daily, F.trunc("day", "month")).collect()}
    exact = {r.m: r.n for r in rows.groupBy(F.month("collection_timestamp").alias("m")).agg(F.count_distinct("url").alias("n")).collect()}
    assert sum(n for n, _ in got.values()) == 60_000
    assert all(abs(found - exact[m]) <= 0.03 * exact[m] for m, (_, found) in got.items())


def test_periods_of_a_store(spark, tmp_path):
    """Days of few rows share a month: files, duplicates, questions and a table that is there before its rows."""
    news = store.NewsStore(spark, f"file://{tmp_path}", {"collected_articles": "month"})
    news.create_tables()
    rows = spark.range(240).select(
        F.concat(F.lit("u"), F.col("id") % 200).alias("url"), F.col("id").cast("string").alias("title"),
        F.expr("TIMESTAMP_NTZ '2026-01-01 12:00:00' + make_dt_interval(CAST(id % 60 AS INT))").alias("collection_timestamp"))
    news.append_articles(rows, F.lit("r"), F.col("collection_timestamp"))
    assert {p.split("/")[0] for p in stored_files(tmp_path / "collected_articles")} == {"month=2026-01-01", "month=2026-02-01", "month=2026-03-01"}
    assert news.remove_duplicates("collected_articles", "url", "collection_timestamp", "title") == 40
    kept = news.read("collected_articles")
    assert kept.columns == [*schemas.ARTICLES.names, "month"] and kept.count() == kept.select("url").distinct().count() == 200
    assert news.read("collected_articles", "2026-02-03", "2026-02-04").select(F.to_date("collection_timestamp")).distinct().count() == 2
    day = reports.collected_on_day(news.read("collected_articles"), F.lit("2026-02-03").cast("date"))
    assert "PartitionFilters: [isnotnull(month" in day._jdf.queryExecution().executedPlan().toString()
    assert day.first().articles == news.read("collected_articles").where("to_date(collection_timestamp) = DATE '2026-02-03'").count() > 0


@pytest.mark.parametrize("name", ["dedup_in_place", "dedup_rewrite", "stored_urls_lookback"])
def test_stored_articles_take_a_file_a_month_not_a_day(spark, tmp_path, name):
    """4,000 documents are 112 days, in four months and a half."""
    words = F.concat(F.lit("some text "), F.col("id"))
    spark.range(4000).select(F.col("id").alias("doc_id"), words.alias("text"), F.length(words).cast("long").alias("n_chars")).write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES[name](spark, str(tmp_path))
    folders = {Path(f).parent.name for f in found.inputFiles() if "/collected_articles.commits/" not in f}
    assert folders <= {f"month=2024-0{m}-01" for m in range(1, 6)} and folders
    assert name == "stored_urls_lookback" or found.count() == 3600
