"""A whole collection on made-up rows: known links, listings, a hot link, missing pages, and a failing run."""

import pytest
from pyspark.sql import functions as F

from wirelake.plans import collection, reports, runs
from wirelake.session import scratch_path
from wirelake.sources.stages import StageStore
from wirelake.sources.store import NewsStore

TEXT = "A good result was reported. " * 6
DATED = f"<time datetime='2026-01-05'><article>{TEXT}3</article>"
STATED = f"<meta content='{'All about it. ' * 10}' name='description'><meta name=keywords content='x, y'><meta name='article:published_time' content='2026-01-06'>"


def at(text="2026-02-01 00:00:00"):
    return F.lit(text).cast("timestamp_ntz")


@pytest.fixture(scope="module")
def inputs(spark):
    links = [f"https://a.com/n/{i}" for i in range(20)] + ["https://a.com/n/0"] * 30 + ["https://a.com/news", "https://b.com/x?page=2", None]
    results = spark.createDataFrame(
        [(i, u, f"title {i}", "good" if i % 2 else "bad bad") for i, u in enumerate(links)], "id long, link string, title string, description string")
    processed = spark.createDataFrame([("https://a.com/n/1",), ("https://a.com/n/2",)], "link string")
    pages = spark.createDataFrame(
        [(i, f"https://a.com/n/{i}", {3: DATED, 4: STATED}.get(i, f"<article>{TEXT}{i}</article>") if i < 15 else "<p>short</p>") for i in range(18)]
        + [(100, "https://a.com/n/0", f"<article>{TEXT}later copy</article>"), (101, "https://c.com/other", f"<article>{TEXT}</article>")],
        "page_id long, url string, html string")
    lexicon = spark.createDataFrame([("good", 2.0), ("bad", -2.0)], "word string, val double")
    return results, processed, pages, lexicon


def five(spark):
    return spark.createDataFrame([(f"q{i % 5}",) for i in range(8)], "query string")


def collected(spark, inputs, **options):
    kept = StageStore(spark, scratch_path(spark, "stages")).keeper("r", "2026-02-01 00:00:00")
    return collection.collect(*inputs, "id", at(), F.asc("page_id"), keep=kept, **options)


def record(spark, run, news, day="2026-02-01"):
    companies = spark.range(150).select(F.concat(F.lit("c"), F.col("id") % 120).alias("company"))
    return collection.record(run, news, "r1", F.lit("2026-01-01").cast("date"), F.lit("2026-01-31").cast("date"), at(f"{day} 00:00:00"), five(spark), companies)


def test_rows_of_a_collection(spark, inputs):
    run = collected(spark, inputs)
    rows = run.links.collect()
    assert len(rows) == 51  # 53 found, 2 known
    assert sorted(r.rule for r in rows if r.rule) == ["index", "missing", "pagination"]
    hot = [r for r in rows if r.link == "https://a.com/n/0"]
    assert len(hot) == 31 and all(r.article_text.endswith(" 0") or r.article_text.endswith("0") for r in hot)
    assert run.articles.where("scraper_used IS NOT NULL").select("url").distinct().count() == 13
    # pages without text, and urls without a page
    assert sorted(r.url for r in run.errors.collect()) == [f"https://a.com/n/{i}" for i in (15, 16, 17, 18, 19)]
    assert {r.sentiment for r in rows if r.rule is None} == {"positive", "negative"}
    report = {r.host: r for r in collection.collection_report(run).collect()}
    assert (report["a.com"].found, report["a.com"].filtered, report["a.com"].attempted, report["a.com"].scraped) == (49, 1, 48, 43)


def test_recorded_and_enriched_again(spark, inputs):
    news = NewsStore(spark, scratch_path(spark, "store"))
    counts = record(spark, collected(spark, inputs, described=True), news)
    assert counts == {"companies": 120, "articles": 48, "scraped": 43, "enrichments": 48, "errors": 5, "filtered": 3, "queries": 5}
    assert news.read("run_companies").count() == 120
    assert news.read("filtered_links").groupBy("rule").count().count() == 3
    dated = news.read("collected_articles").where("publish_date IS NOT NULL").select("url", "publish_date", "summary", "keywords").collect()
    assert {(r.url, str(r.publish_date)) for r in dated} == {("https://a.com/n/3", "2026-01-05 00:00:00"), ("https://a.com/n/4", "2026-01-06 00:00:00")}
    assert {(r.summary, r.keywords) for r in dated if r.url.endswith("4")} == {("All about it. " * 9 + "All about it.", "x, y")}
    assert reports.company_coverage(news.read("collected_articles").withColumn("query", F.lit("q")), "q").first().total_articles == 43
    articles, labels = news.read("collected_articles"), news.read("article_enrichments")
    row = articles.where("url LIKE '%/n/5'").first()
    assert row.keywords.startswith("a, good") and row.summary.startswith("A good result")
    assert articles.where("url LIKE '%/n/16' AND summary IS NULL AND article_text IS NULL").count() == 1
    state = runs.run_rows(news.read("run_events")).first()
    assert (state.status, state.queries_count, state.urls_collected, state.articles_scraped) == ("completed", 5, 48, 43)
    assert reports.urls_needing_enrichment(articles, labels).count() == 0
    lexicon = inputs[3]
    again = collection.refresh_enrichments(articles, labels, lexicon, "v2.0", F.lit("r2"), at(), F.asc("rank"))
    assert news.append_enrichments(again, F.lit("r2"), at("2026-02-02 00:00:00"), "v2.0") == 13
    assert reports.urls_needing_enrichment(articles, news.read("article_enrichments"), "v2.0").count() == 0
    tie = F.lit(0)
    latest = reports.latest_enrichments(news.read("article_enrichments").withColumn("tie", tie), "tie")
    assert latest.where("enrichment_version = 'v2.0'").count() == 13


def test_failing_run_is_logged(spark, inputs):
    news = NewsStore(spark, scratch_path(spark, "store"))
    run = collected(spark, inputs)
    broken = collection.Collection(run.links.withColumn("title", F.raise_error(F.lit("disk full")).cast("string")), run.errors)
    with pytest.raises(Exception):
        record(spark, broken, news)
    state = runs.run_rows(news.read("run_events")).first()
    assert state.status == "failed" and "disk full" in state.error_message


def test_links_are_left_alone_without_a_link_column(spark, inputs):
    other = spark.createDataFrame([(1,)], "a int")
    assert collection.new_links(other, inputs[1]).collect() == [(1,)]


def test_recorded_again(spark, inputs):
    """A run that failed between two tables is completed by recording it again, and nothing is there twice."""
    news = NewsStore(spark, scratch_path(spark, "store"))
    run = collected(spark, inputs, described=True)
    broken = collection.Collection(run.links, run.errors.withColumn("url", F.raise_error(F.lit("disk full")).cast("string")))
    with pytest.raises(Exception):
        record(spark, broken, news)
    assert runs.run_rows(news.read("run_events")).first().status == "failed"
    first = record(spark, run, news, "2026-02-02")
    assert first == record(spark, run, news, "2026-02-03")
    assert (news.read("collected_articles").count(), news.read("article_enrichments").count(), news.read("scrape_errors").count()) == (48, 48, 5)
    state = runs.run_rows(news.read("run_events")).first()
    assert state.status == "completed" and state.error_message is None and state.articles_scraped == 43
