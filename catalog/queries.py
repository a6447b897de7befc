"""One query per job, over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.views import BY_MONTH, NEGATORS, RULES, StoredViews, Views
from wirelake import schemas
from wirelake.functions import links, times, words
from wirelake.functions.html import has_content, semantic, visible
from wirelake.operators.keyed import first_per_key
from wirelake.plans import collection, extraction, planning, reports, runs, text
from wirelake.session import scratch_path
from wirelake.sources import files, reference, search, stages, store
from wirelake.streaming import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

HISTORY = ("1995-01-01", "1996-03-13")  # range of the planning queries, met by stored runs
BACKFILL = "1995-01-01"


def query(job: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    @wraps(job)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return job(Views(spark, folder))

    QUERIES[job.__name__] = run
    return job


def date(text: str):
    return F.lit(text).cast("date")


def stamp(text: str):
    return F.lit(text).cast("timestamp_ntz")


def flat(column: str):
    """A list as text, so that any client compares it the same way."""
    return F.array_join(column, "|").alias(column)


# --- sources and sinks --------------------------------------------------------------------------


@query
def reference_scan(v: Views) -> DataFrame:
    return reference.scan_reference(v.reference_data(), "f100")


@query
def csv_roundtrip(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "csv")
    files.write_csv(v.reference_data().select("id", "corporation", "sector", "newsroom_url"), path)
    return files.read_csv(v.spark, path, schemas.REFERENCE)


@query
def csv_texts(v: Views) -> DataFrame:
    """Whole texts, with their line breaks and quotes."""
    path = scratch_path(v.spark, "csv")
    quoted = F.concat(F.lit('"'), F.col("text"), F.lit('",\n\\'))
    files.write_csv(v.table("documents").select("doc_id", quoted.alias("text")), path)
    return files.read_csv(v.spark, path, T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]))


@query
def reference_snapshot(v: Views) -> DataFrame:
    return reference.choose_snapshot(v.reference_snapshots(), stamp("2024-01-01 21:00:00"))


@query
def reference_snapshot_stale(v: Views) -> DataFrame:
    return reference.choose_snapshot(v.reference_snapshots(), stamp("2024-02-01 00:00:00"))


@query
def serp_parse(v: Views) -> DataFrame:
    rows = search.result_rows(search.read_payloads(v.serp_payloads()))
    return rows.select("page_no", "query", "title", "description", "link", "rank")


ATTEMPTS, PAGES = 3, 2  # attempts per page and pages per query of the search jobs


def _resolved(v: Views) -> DataFrame:
    return search.resolve_fetches(v.serp_attempts(), "host", "page_no", max_attempts=ATTEMPTS)


@query
def fetch_resolution(v: Views) -> DataFrame:
    return _resolved(v).drop("payload")


def _fetched_pages(v: Views) -> DataFrame:
    read = search.read_payloads(_resolved(v).where("resolved_attempt IS NOT NULL"))
    return read.select(F.col("host").alias("query"), "page_no", F.size("organic").cast("long").alias("n_results"), "next_page_link")


@query
def serp_page_chain(v: Views) -> DataFrame:
    return search.chained_pages(_fetched_pages(v), max_pages=PAGES)


@query
def serp_page_chain_all(v: Views) -> DataFrame:
    return search.chained_pages(_fetched_pages(v), max_pages=None)


@query
def failed_queries(v: Views) -> DataFrame:
    return search.failed_queries(v.serp_attempts().select(F.col("host").alias("query")), _fetched_pages(v))


@query
def union_pages(v: Views) -> DataFrame:
    rows = v.serp_results().select("page_id", "page_no", "query", "title", "link", "rank")
    first = rows.where("page_no = 0").drop("page_no")
    return search.union_pages(first, rows.where("page_no > 0"))


def _processed_file(v: Views) -> str:
    path = scratch_path(v.spark, "lines")
    padded = F.concat(F.lit("  "), F.col("link"), F.lit(" "))
    lines = v.processed_urls().select(padded.alias("value"))
    lines.union(lines).union(lines.select(F.lit("   "))).write.text(path)
    return path


@query
def processed_scan(v: Views) -> DataFrame:
    return files.read_lines(v.spark, _processed_file(v))


@query
def processed_count(v: Views) -> DataFrame:
    return files.read_lines(v.spark, _processed_file(v)).agg(F.count("*").alias("processed"))


@query
def processed_union(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "union")
    new = v.serp_links().where("page_id % 2 = 0").select("link")
    files.add_lines(v.processed_urls(), new, path, "link")
    return files.read_lines(v.spark, path, "link")


@query
def stage_roundtrip(v: Views) -> DataFrame:
    kept = stages.StageStore(v.spark, scratch_path(v.spark, "stages"))
    kept.save(v.run_events(), "20240101_000000", "events", "2024-01-01 00:00:00", "run events")
    return kept.load("20240101_000000", "events")


@query
def latest_run_stages(v: Views) -> DataFrame:
    registry = v.run_events().select("run_id", F.col("status").alias("stage"))
    return stages.latest_run_stages(registry)


@query
def store_layout(v: Views) -> DataFrame:
    news = store.NewsStore(v.spark, scratch_path(v.spark, "store"), BY_MONTH)
    news.create_tables()
    news.append_articles(v.collected_articles(), F.col("run_id"), F.col("collection_timestamp"))
    return news.read("collected_articles").groupBy(F.to_date("collection_timestamp").alias("day")).agg(
        F.count("*").alias("n"), F.count_distinct("url").alias("urls")
    )


@query
def write_articles(v: Views) -> DataFrame:
    news = store.NewsStore(v.spark, scratch_path(v.spark, "store"))
    dated = F.when(F.col("doc_id") % 3 == 0, F.date_format("publish_date", "MM/dd/yyyy")).otherwise(
        F.date_format("publish_date", "yyyy-MM-dd HH:mm:ss"))
    rows = v.collected_articles().withColumnRenamed("url", "link").withColumn("publish_date", dated)
    news.append_articles(rows, F.lit("20240301_000000"), stamp("2024-03-01 00:00:00"))
    return news.read("collected_articles").drop("day")


@query
def write_enrichments(v: Views) -> DataFrame:
    news = store.NewsStore(v.spark, scratch_path(v.spark, "store"))
    rows = v.article_enrichments().withColumn("issue_labels", F.when(F.col("event_id") % 5 != 0, F.col("issue_labels")))
    rows = rows.withColumn("entity_labels", F.col("entity_labels")[0])
    news.append_enrichments(rows, F.lit("20240301_000000"), F.col("enrichment_timestamp"), "v3.0")
    return news.read("article_enrichments").select(
        "url", "sentiment", F.round("sentiment_score", 6).alias("sentiment_score"), flat("issue_labels"), flat("entity_labels"),
        "enrichment_timestamp", "enrichment_version", "run_id",
    )


@query
def run_state(v: Views) -> DataFrame:
    return runs.run_states(v.run_events(), "status", "urls_collected")


@query
def run_log(v: Views) -> DataFrame:
    """Start and end events written to the store and read back as one row per run."""
    news = store.NewsStore(v.spark, scratch_path(v.spark, "store"))
    table = v.collection_runs()
    started = table.select("run_id", "start_date", "end_date", "start_timestamp")
    news.append_events(runs.start_events(started, F.col("start_timestamp")))
    ended = table.where("status <> 'started'").select(
        "run_id", "queries_count", "urls_collected", "articles_scraped", "end_timestamp",
        F.when(F.col("status") == "failed", F.lit("out of quota")).alias("error_message"),
    )
    news.append_events(runs.end_events(ended, F.col("end_timestamp")))
    # some of the failed runs complete at a second try
    again = ended.where("error_message IS NOT NULL AND run_id % 5 = 0").drop("error_message").withColumn("urls_collected", F.lit(7))
    news.append_events(runs.end_events(again.withColumn("error_message", F.lit(None)), F.col("end_timestamp") + F.expr("INTERVAL '1' DAY")))
    return runs.run_rows(news.read("run_events"))


@query
def run_ids(v: Views) -> DataFrame:
    return v.collection_runs().select("run_id", times.run_id_of(F.col("end_timestamp")).alias("new_id"))


@query
def dedup_rewrite(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "rewrite")
    store.rewrite_without_duplicates(
        v.collected_articles(), path, "url", "collection_timestamp", F.asc("collection_timestamp"), F.asc("doc_id"),
        period=BY_MONTH["collected_articles"])
    return v.spark.read.parquet(path).select("url", "doc_id", "title", "run_id", "collection_timestamp")


@query
def dedup_in_place(v: Views) -> DataFrame:
    """Articles stored in two runs, of which the second repeats urls of the first; duplicates leave the months that hold them."""
    news = store.NewsStore(v.spark, scratch_path(v.spark, "store"), BY_MONTH)
    table = v.collected_articles()
    for part in ("doc_id % 3 <> 0", "doc_id % 3 = 0"):
        news.append_articles(table.where(part), F.col("run_id"), F.col("collection_timestamp"))
        news.remove_duplicates("collected_articles", "url", "collection_timestamp", "title")
    return news.read("collected_articles").select("url", "title", "run_id", "collection_timestamp")


# --- projections and filters --------------------------------------------------------------------


@query
def conform_schema(v: Views) -> DataFrame:
    spelled = v.reference_data().withColumnsRenamed({"corporation": "Company", "newsroom_url": "pressroom_url", "id": "key"})
    return schemas.conform(spelled, schemas.REFERENCE)


@query
def query_generation(v: Views) -> DataFrame:
    companies = reference.with_usable_url(v.reference_data())
    ranges = companies.withColumn("start_date", date(HISTORY[0])).withColumn("end_date", date(HISTORY[1]))
    return planning.generate_queries(ranges).select("id", "newsroom_url", "query")


@query
def query_generation_distinct(v: Views) -> DataFrame:
    companies = reference.with_usable_url(v.reference_data())
    ranges = companies.withColumn("start_date", date(HISTORY[0])).withColumn("end_date", date(HISTORY[1]))
    return planning.generate_queries(ranges, distinct=True, encode=True).select("newsroom_url", "query")


@query
def term_domain_queries(v: Views) -> DataFrame:
    terms = v.table("customer").select(F.concat(F.col("c_mktsegment"), F.lit(' & "Co"')).alias("term")).distinct()
    return planning.term_queries(terms, ["wire.example.com", "daily.example.org"], date("2024-01-01"), date("2024-01-31"))


@query
def url_rules(v: Views) -> DataFrame:
    return v.serp_links().select("page_id", "link", F.coalesce(links.rejection_rule(F.col("link")), F.lit("accepted")).alias("rule"))


@query
def url_split(v: Views) -> DataFrame:
    return collection.split_links(v.serp_links()).where("rule IS NOT NULL").select("link", "reason", "rule")


@query
def content_filter(v: Views) -> DataFrame:
    return v.table("documents").where(has_content(F.col("text"))).select("doc_id", "lang")


@query
def urls_in_range(v: Views) -> DataFrame:
    return reports.urls_in_range(v.collected_articles(), F.lit("2024-01-05"), F.lit("2024-01-15"))


@query
def urls_lookback(v: Views) -> DataFrame:
    articles = v.collected_articles()
    return reports.urls_since(articles, v.latest(articles, "collection_timestamp"), 12)


@query
def urls_all(v: Views) -> DataFrame:
    return reports.all_urls(v.collected_articles())


RUN_COLUMNS = ["run_id", "start_date", "end_date", "queries_count", "urls_collected", "articles_scraped", "status", "start_timestamp"]


@query
def failed_runs(v: Views) -> DataFrame:
    return reports.failed_runs(v.collection_runs()).select(RUN_COLUMNS)


@query
def backfill_runs(v: Views) -> DataFrame:
    return reports.backfill_runs(v.collection_runs(), date("1996-01-02")).select(RUN_COLUMNS)


@query
def title_search(v: Views) -> DataFrame:
    return reports.title_search(v.collected_articles(), "%the%", stamp("2024-01-05 00:00:00"))


@query
def by_issue(v: Views) -> DataFrame:
    hits = reports.with_label(v.article_enrichments(), "issue_labels", "big")
    return hits.select("event_id", "url", flat("issue_labels"), "sentiment")


@query
def by_entity(v: Views) -> DataFrame:
    hits = reports.with_label(v.article_enrichments(), "entity_labels", "user3")
    return hits.select("event_id", "url", flat("entity_labels"), "sentiment")


@query
def metadata_field(v: Views) -> DataFrame:
    return reports.metadata_field(v.article_enrichments(), "k")


@query
def collected_on_day(v: Views) -> DataFrame:
    articles = v.collected_articles()
    return reports.collected_on_day(articles, F.to_date(v.latest(articles, "collection_timestamp")))


@query
def coerce_dates(v: Views) -> DataFrame:
    at, n = F.col("publish_date"), F.col("doc_id") % 8
    spelled = (
        F.when(n == 0, "soon").when(n == 1, F.date_format(at, "yyyy-MM-dd")).when(n == 2, F.date_format(at, "MM/dd/yyyy"))
        .when(n == 3, F.date_format(at, "MMM d, yyyy")).when(n == 5, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(n == 6, F.date_format(at, "d MMM yyyy")).otherwise(F.date_format(at, "yyyy-MM-dd HH:mm:ss"))
    )
    return v.collected_articles().select("doc_id", times.coerce_timestamp(spelled).alias("publish_date"))


@query
def normalize_labels(v: Views) -> DataFrame:
    lists = F.when(F.col("event_id") % 4 != 0, F.col("issue_labels"))
    single = F.when(F.col("event_id") % 6 != 0, F.col("enrichment_version"))
    rows = v.article_enrichments().select(
        "event_id", words.label_list(lists).alias("issues"), words.label_as_list(single).alias("versions"))
    return rows.select("event_id", F.size("issues").alias("n_issues"), flat("issues"), F.size("versions").alias("n_versions"), flat("versions"))


# --- joins and set operations -------------------------------------------------------------------


def _scraped(v: Views) -> DataFrame:
    return v.scrape_log().where("scraper_used IS NOT NULL")


@query
def join_content(v: Views) -> DataFrame:
    joined = collection.join_content(v.serp_links(), _scraped(v), "link", F.asc("page_id"))
    return joined.select("page_id", "link", "title", "scraper_used", "processing_time_s")


@query
def new_links(v: Views) -> DataFrame:
    return collection.new_links(v.serp_links(), v.processed_urls()).select("page_id", "link")


@query
def executed_queries(v: Views) -> DataFrame:
    return planning.executed_queries(v.run_dates(), v.run_queries(), date("1996-01-01"), date("1996-01-31"))


def _months(v: Views) -> DataFrame:
    first = F.to_date(F.date_trunc("month", "o_orderdate")).alias("range_start")
    months = v.table("orders").select(first).distinct()
    return months.withColumn("range_end", F.last_day("range_start"))


@query
def executed_by_range(v: Views) -> DataFrame:
    return planning.executed_by_range(_months(v), v.collection_runs(), v.run_queries())


def _known_newsrooms(v: Views) -> DataFrame:
    return v.collected_articles().select(links.query_site(F.col("query")).alias("newsroom_url")).distinct()


@query
def backfill_urls(v: Views) -> DataFrame:
    return planning.backfill_urls(v.reference_data(), _known_newsrooms(v))


@query
def queries_to_execute(v: Views) -> DataFrame:
    start, end = date(HISTORY[0]), date(HISTORY[1])
    companies = reference.with_usable_url(v.reference_data())
    generated = planning.generate_queries(companies.withColumn("start_date", start).withColumn("end_date", end))
    done = planning.executed_queries(v.run_dates(), v.run_queries(), start, end)
    return planning.queries_to_execute(generated, done).select("id", "query")


@query
def need_enrichment(v: Views) -> DataFrame:
    return reports.urls_needing_enrichment(v.collected_articles(), v.article_enrichments())


@query
def need_enrichment_version(v: Views) -> DataFrame:
    return reports.urls_needing_enrichment(v.collected_articles(), v.article_enrichments(), "v2.0")


@query
def articles_latest(v: Views) -> DataFrame:
    articles = v.collected_articles()
    latest = reports.articles_with_latest(
        articles, v.article_enrichments(), v.latest(articles, "collection_timestamp"), "event_id")
    return latest.select(
        "url", "title", "publish_date", "collection_timestamp", "sentiment", F.round("sentiment_score", 6).alias("sentiment_score"),
        flat("issue_labels"), flat("entity_labels"))


@query
def enrichment_rows(v: Views) -> DataFrame:
    rows = collection.join_content(v.serp_links(), _scraped(v), "link", F.asc("page_id"))
    scored = text.sentiment(rows, "page_id", "title", v.lexicon(), NEGATORS).drop("score")
    return collection.enrichment_rows(rows.withColumnRenamed("link", "url").join(scored, "page_id"))


# --- aggregations -------------------------------------------------------------------------------


@query
def daily_collection(v: Views) -> DataFrame:
    articles = v.collected_articles()
    return reports.daily_collection(articles, v.latest(articles, "collection_timestamp"))


@query
def coverage(v: Views) -> DataFrame:
    articles = v.collected_articles()
    return reports.coverage(articles, v.article_enrichments(), v.latest(articles, "collection_timestamp"), 20)


@query
def url_sketches(v: Views) -> DataFrame:
    """Distinct urls of each month from stored daily sketches, beside the exact number, and whether they agree to 3 %."""
    path = scratch_path(v.spark, "sketches")
    reports.daily_sketches(v.collected_articles()).write.parquet(path)
    month = F.trunc("day", "month")
    found = reports.distinct_urls(v.spark.read.parquet(path), month)
    exact = v.collected_articles().groupBy(F.trunc(F.to_date("collection_timestamp"), "month").alias("span")).agg(F.count_distinct("url").alias("urls"))
    close = F.abs(F.col("distinct_urls") - F.col("urls")) <= 0.03 * F.col("urls")
    return found.join(exact, "span").select(F.col("span").alias("month"), "articles", "urls", close.alias("close"))


@query
def daily_runs(v: Views) -> DataFrame:
    table = v.collection_runs()
    return reports.daily_runs(table, v.latest(table, "start_timestamp"), 60)


@query
def scraper_share(v: Views) -> DataFrame:
    return reports.scraper_share(v.collected_articles())


@query
def duplicate_urls(v: Views) -> DataFrame:
    return reports.duplicate_urls(v.collected_articles())


@query
def company_coverage(v: Views) -> DataFrame:
    return reports.company_coverage(v.collected_articles(), "%corp7.example%")


@query
def coverage_by_site(v: Views) -> DataFrame:
    return reports.coverage_by_site(v.collected_articles())


@query
def range_runs(v: Views) -> DataFrame:
    return reports.range_runs(v.collection_runs())


@query
def sentiment_dist(v: Views) -> DataFrame:
    return reports.sentiment_distribution(v.article_enrichments())


@query
def scraper_report(v: Views) -> DataFrame:
    return reports.scraper_report(v.scrape_log())


@query
def error_report(v: Views) -> DataFrame:
    return reports.error_report(v.scrape_log())


@query
def scrape_summary(v: Views) -> DataFrame:
    filtered = v.serp_links().where(~links.is_article(F.col("link"))).select(F.count("*")).scalar()
    return reports.scrape_summary(v.scrape_log(), filtered)


@query
def errors_by_host(v: Views) -> DataFrame:
    return reports.errors_by_host(v.scrape_log())


@query
def company_cost(v: Views) -> DataFrame:
    return reports.company_cost(v.run_queries(), v.collected_articles())


@query
def table_rows(v: Views) -> DataFrame:
    return reports.table_rows({
        "collected_articles": v.collected_articles(), "article_enrichments": v.article_enrichments(),
        "collection_runs": v.collection_runs(),
    })


@query
def table_bytes(v: Views) -> DataFrame:
    """Rows behind the files of a table, and whether the files are as large as their rows make them at least."""
    size = store.storage_size(v.table("events"))
    return size.select("n_rows", (F.col("n_bytes") > F.col("n_rows")).alias("has_bytes"), (F.col("n_files") > 0).alias("has_files"))


@query
def run_stats(v: Views) -> DataFrame:
    plan = _plan(v)
    new = planning.backfill_urls(v.reference_data(), _known_newsrooms(v), BACKFILL)
    counts = planning.plan_counts(v.reference_data(), plan, new)
    collected = collection.collection_counts(_collection(v)).select(F.struct("*")).scalar()
    return counts.withColumn("_collected", collected).select("*", "_collected.*").drop("_collected")


# --- windows, sorts, limits ---------------------------------------------------------------------


@query
def latest_enrichment(v: Views) -> DataFrame:
    newest = reports.latest_enrichments(v.article_enrichments(), "event_id")
    return newest.select(
        "url", "sentiment", F.round("sentiment_score", 6).alias("sentiment_score"), flat("issue_labels"),
        flat("entity_labels"), "enrichment_timestamp", "enrichment_version")


@query
def earliest_article(v: Views) -> DataFrame:
    first = reports.earliest_articles(v.collected_articles(), F.asc("doc_id"))
    return first.select("url", "doc_id", "title", "collection_timestamp")


@query
def drop_duplicates(v: Views) -> DataFrame:
    """Rows before and after, and the number removed."""
    articles = v.collected_articles().select("url", "doc_id")
    kept = first_per_key(articles, "url", F.asc("doc_id"))
    total = articles.select(F.count("*")).scalar()
    return kept.agg(F.count("*").alias("kept"), F.sum("doc_id").alias("sum_doc_id")).withColumn("removed", total - F.col("kept"))


@query
def recent_articles(v: Views) -> DataFrame:
    articles = v.collected_articles()
    return reports.recent_articles(articles, v.latest(articles, "collection_timestamp"))


@query
def recent_runs(v: Views) -> DataFrame:
    return reports.recent_runs(v.collection_runs())


@query
def recent_runs_days(v: Views) -> DataFrame:
    table = v.collection_runs()
    return reports.recent_runs(table, rows=None, as_of=v.latest(table, "start_timestamp"), days=60)


@query
def urls_per_query(v: Views) -> DataFrame:
    return reports.urls_per_query(v.collection_runs())


@query
def query_efficiency(v: Views) -> DataFrame:
    return reports.query_efficiency(v.collection_runs())


@query
def dedup_effect(v: Views) -> DataFrame:
    return reports.dedup_effect(v.collection_runs())


@query
def company_queries(v: Views) -> DataFrame:
    return reports.company_queries(v.run_dates(), v.run_queries(), "%site:https://www.corp7.example.com%")


# --- planning -----------------------------------------------------------------------------------


@query
def date_windows(v: Views) -> DataFrame:
    table = v.collection_runs()
    return planning.date_windows(table, v.latest(table, "start_timestamp"), 30)


def _effective(v: Views, **options) -> DataFrame:
    new = planning.backfill_urls(v.reference_data(), _known_newsrooms(v), "1994-01-01")
    ranges = planning.effective_ranges(v.reference_data(), new, date(HISTORY[0]), date(HISTORY[1]), **options)
    return ranges.select("id", "newsroom_url", "start_date", "end_date")


@query
def effective_ranges(v: Views) -> DataFrame:
    return _effective(v)


@query
def effective_ranges_all(v: Views) -> DataFrame:
    return _effective(v, scope="all")


def _plan(v: Views) -> DataFrame:
    return planning.collection_plan(
        v.reference_data(), _known_newsrooms(v), v.run_dates(), v.run_queries(),
        date("1995-01-01"), date(HISTORY[1]), BACKFILL)


@query
def collection_plan(v: Views) -> DataFrame:
    return _plan(v).select("id", "newsroom_url", "start_date", "end_date", "query", "skip")


def _collection(v: Views, described: bool = False) -> collection.Collection:
    kept = stages.StageStore(v.spark, scratch_path(v.spark, "stages"))
    return collection.collect(
        v.serp_links(), v.processed_urls(), v.pages_mixed(), v.lexicon(), "page_id", stamp("2024-03-01 00:00:00"),
        F.asc("page_id"), negators=NEGATORS, keep=kept.keeper("20240301_000000", "2024-03-01 00:00:00"), described=described)


@query
def collection_report(v: Views) -> DataFrame:
    return collection.collection_report(_collection(v))


def _recorded(v: Views) -> store.NewsStore:
    news = store.NewsStore(v.spark, scratch_path(v.spark, "store"))
    collection.record(
        _collection(v, described=True), news, "20240301_000000", date("2024-02-20"), date("2024-03-01"), stamp("2024-03-01 00:00:00"),
        v.serp_links().select(F.concat(F.lit("site:"), F.col("host")).alias("query")), v.reference_data().select(F.col("corporation").alias("company")))
    return news


@query
def recorded_articles(v: Views) -> DataFrame:
    """Article rows of a whole collection, as written to the store."""
    rows = _recorded(v).read("collected_articles")
    return rows.select("url", "title", "scraper_used", "summary", "keywords", "article_text", "publish_date", "run_id")


@query
def recorded_errors(v: Views) -> DataFrame:
    """Wanted urls without text, those without a stored page among them."""
    return _recorded(v).read("scrape_errors").drop("day")


@query
def recorded_filtered(v: Views) -> DataFrame:
    return _recorded(v).read("filtered_links").drop("day")


@query
def recorded_companies(v: Views) -> DataFrame:
    return _recorded(v).read("run_companies").drop("month")


@query
def recorded_queries(v: Views) -> DataFrame:
    """Queries of the recorded collection, found again as executed."""
    news = _recorded(v)
    return planning.executed_queries(runs.run_rows(news.read("run_events")), news.read("run_queries"), date("2024-02-25"), date("2024-04-01"))


@query
def recorded_run(v: Views) -> DataFrame:
    """The run row of a whole collection, with its enrichments counted."""
    news = _recorded(v)
    labels = news.read("article_enrichments").select(F.count("*")).scalar()
    return runs.run_rows(news.read("run_events")).select(
        "run_id", "status", "start_date", "end_date", "queries_count", "urls_collected", "articles_scraped", labels.alias("enrichments"))


# --- text ---------------------------------------------------------------------------------------


@query
def extract_semantic(v: Views) -> DataFrame:
    return v.pages().select("page_id", semantic(visible(F.col("html"))).alias("article_text"))


@query
def extract_chain(v: Views) -> DataFrame:
    return extraction.extract(v.pages_mixed()).select("page_id", "article_text", "scraper_used")


@query
def extract_nested(v: Views) -> DataFrame:
    return extraction.extract(v.pages_nested()).select("page_id", "article_text", "scraper_used")


@query
def structured_metadata(v: Views) -> DataFrame:
    return extraction.page_metadata(v.pages_stated()).select("page_id", "title", "description", "tags", "publish_date")


@query
def extract_errors(v: Views) -> DataFrame:
    return extraction.errors(extraction.extract(v.pages_mixed()), stamp("2024-03-01 00:00:00"))


@query
def page_metadata(v: Views) -> DataFrame:
    return extraction.page_metadata(v.pages_mixed()).select("page_id", "title", "description", "tags", "publish_date")


@query
def custom_extractor(v: Views) -> DataFrame:
    def footer(page: str) -> str | None:
        _, found, rest = page.partition("<footer>")
        return rest.partition("</footer>")[0] if found else None

    done = extraction.extract_then_python(v.pages_mixed(), {"footer": footer})
    return done.select("page_id", "scraper_used", "article_text")


@query
def keywords_topk(v: Views) -> DataFrame:
    return text.keywords(v.table("documents"), "doc_id", "text", k=5, min_length=3)


@query
def summary_topk(v: Views) -> DataFrame:
    return text.summaries(v.table("documents"), "doc_id", "text")


@query
def summary_central(v: Views) -> DataFrame:
    return text.central_summaries(v.table("documents"), "doc_id", "text")


@query
def sentiment(v: Views) -> DataFrame:
    return text.sentiment(v.table("documents"), "doc_id", "text", v.lexicon(), NEGATORS)


@query
def sentiment_rules(v: Views) -> DataFrame:
    return text.sentiment_by_rules(v.told_texts(), "doc_id", "text", v.word_values(), RULES)


@query
def refresh_enrichment(v: Views) -> DataFrame:
    rows = collection.refresh_enrichments(
        v.collected_articles(), v.article_enrichments(), v.lexicon(), "v2.0", F.lit("20240301_000000"),
        stamp("2024-03-01 00:00:00"), F.asc("doc_id"), negators=NEGATORS)
    news = store.NewsStore(v.spark, scratch_path(v.spark, "store"))
    news.append_enrichments(rows, F.col("run_id"), F.col("enrichment_timestamp"), "v2.0")
    return news.read("article_enrichments").select("url", "sentiment", "sentiment_score", "enrichment_version", "run_id")


# --- streams ------------------------------------------------------------------------------------


def _enrichment_stream(v: Views) -> DataFrame:
    events = incremental.read_new_files(v.spark, v.stream_path("events"), v.table("events").schema)
    return v.as_enrichments(events).select("event_id", "url", "sentiment", "enrichment_timestamp", "enrichment_version")


@query
def stream_ingest(v: Views) -> DataFrame:
    base = scratch_path(v.spark, "stream")
    for _ in range(2):  # the second run finds nothing new
        incremental.ingest(_enrichment_stream(v), f"{base}/out", f"{base}/checkpoint")
    return v.spark.read.parquet(f"{base}/out")


@query
def stream_dedup(v: Views) -> DataFrame:
    base = scratch_path(v.spark, "stream")
    for _ in range(2):
        incremental.ingest(incremental.new_keys(_enrichment_stream(v), "url", F.col("event_id")), f"{base}/out", f"{base}/checkpoint")
    return v.spark.read.parquet(f"{base}/out").select("url")  # which of a url's rows comes first is up to the stream


@query
def stream_dedup_bounded(v: Views) -> DataFrame:
    """Keys once within a delay that all events lie in, so each key once."""
    base = scratch_path(v.spark, "stream")
    for _ in range(2):
        found = incremental.new_keys_within(_enrichment_stream(v), "url", "enrichment_timestamp", "3650 days")
        incremental.ingest(found, f"{base}/out", f"{base}/checkpoint")
    return v.spark.read.parquet(f"{base}/out").select("url")


@query
def stream_append(v: Views) -> DataFrame:
    base = scratch_path(v.spark, "stream")

    def once(batch: DataFrame) -> DataFrame:
        return first_per_key(batch, "url", F.asc("enrichment_timestamp"), F.asc("event_id"))

    for _ in range(2):
        incremental.append_new(_enrichment_stream(v), "url", once, f"{base}/table", f"{base}/checkpoint")
    return v.spark.read.parquet(f"{base}/table").select("event_id", "url", "sentiment", "enrichment_timestamp")


# --- reports over the store ---------------------------------------------------------------------


def _over_store(job: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: job.__wrapped__(StoredViews(spark, folder))


STORED = ["urls_in_range", "urls_lookback", "title_search", "collected_on_day", "daily_collection", "coverage", "articles_latest", "recent_articles"]
QUERIES.update({f"stored_{name}": _over_store(QUERIES[name]) for name in STORED})
