"""Questions to the news tables. `as_of` stands for the present and is always given by the caller."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wirelake.functions.links import host, query_site
from wirelake.functions.times import days_before
from wirelake.operators.joins import without
from wirelake.operators.keyed import first_per_key, latest_value, repeated_keys
from wirelake.operators.shares import counts_with_share, percent, ratio

# --- articles -----------------------------------------------------------------------------------


def between(df: DataFrame, time: str, first: Column | None = None, after: Column | None = None) -> DataFrame:
    """Rows from the time `first` up to, but not including, `after`.

    Frames of the store have a partition column, `day` or `month`; the bounds are put on it too, so that only the
    partitions in question are read.
    """
    period = next((p for p in ("day", "month") if p in df.columns), None)
    if first is not None:
        df = df.where(F.col(time) >= first)
        df = df if period is None else df.where(F.col(period) >= F.to_date(F.date_trunc(period, first)))
    if after is not None:
        df = df.where(F.col(time) < after)
        df = df if period is None else df.where(F.col(period) <= F.to_date(F.date_trunc(period, after)))
    return df


def since(df: DataFrame, time: str, as_of: Column, days: int) -> DataFrame:
    return between(df, time, days_before(as_of, days))


def _midnight(day: Column, later: int = 0) -> Column:
    return F.date_add(day.cast("date"), later).cast("timestamp_ntz")


def urls_in_range(articles: DataFrame, start: Column, end: Column) -> DataFrame:
    """Distinct urls collected from day `start` to day `end`, both included."""
    return between(articles, "collection_timestamp", _midnight(start), _midnight(end, 1)).select("url").distinct()


def urls_since(articles: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    return since(articles, "collection_timestamp", as_of, days).select("url").distinct()


def all_urls(articles: DataFrame) -> DataFrame:
    return articles.select("url").distinct()


def title_search(articles: DataFrame, pattern: str, start: Column) -> DataFrame:
    hits = between(articles, "collection_timestamp", start).where(F.col("title").like(pattern))
    return hits.select("url", "title", "collection_timestamp")


def collected_on_day(articles: DataFrame, day: Column) -> DataFrame:
    return between(articles, "collection_timestamp", _midnight(day), _midnight(day, 1)).agg(F.count("*").alias("articles"))


def recent_articles(articles: DataFrame, as_of: Column, days: int = 7, rows: int = 100) -> DataFrame:
    newest = since(articles, "collection_timestamp", as_of, days).orderBy(F.desc("collection_timestamp"), "url")
    return newest.limit(rows).select("url", "title", "publish_date", "scraper_used", "collection_timestamp")


def daily_collection(articles: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    recent = since(articles, "collection_timestamp", as_of, days)
    return recent.groupBy(F.to_date("collection_timestamp").alias("date")).agg(
        F.count("*").alias("articles_collected"),
        F.count_distinct("scraper_used").alias("scrapers_used"),
        F.count("article_text").alias("successful_scrapes"),
    ).orderBy(F.desc("date"))


def scraper_share(articles: DataFrame) -> DataFrame:
    """Articles per extractor, in percent of all articles."""
    total = articles.select(F.count("*")).scalar()
    found = articles.where("scraper_used IS NOT NULL")
    return counts_with_share(found, "scraper_used", total, "articles_count", 2).withColumnRenamed("pct", "percentage")


def duplicate_urls(articles: DataFrame) -> DataFrame:
    return repeated_keys(articles, "url", "duplicate_count")


def _coverage():
    return [
        F.to_date(F.min("publish_date")).alias("earliest_article"),
        F.to_date(F.max("publish_date")).alias("latest_article"),
        F.count("*").alias("total_articles"),
    ]


def company_coverage(articles: DataFrame, pattern: str) -> DataFrame:
    """Dates and number of the articles with text whose query matches."""
    return articles.where(F.col("query").like(pattern) & F.col("article_text").isNotNull()).agg(*_coverage())


def coverage_by_site(articles: DataFrame) -> DataFrame:
    """The same for every site that was searched."""
    sites = articles.where("article_text IS NOT NULL").groupBy(query_site(F.col("query")).alias("site"))
    return sites.agg(*_coverage())


def earliest_articles(articles: DataFrame, *tie: Column) -> DataFrame:
    return first_per_key(articles, "url", F.asc("collection_timestamp"), *tie)


# --- distinct urls by sketches ------------------------------------------------------------------


def daily_sketches(articles: DataFrame, log2_size: int = 14) -> DataFrame:
    """One row for each day: its articles, and a sketch of its distinct urls (HyperLogLog, 2^log2_size registers).

    Sketches of days can be merged, so a table of these rows answers for any span of days without reading a url again. The
    relative standard error is about 0.8 / sqrt(2^log2_size): half a percent at 14."""
    day = F.to_date("collection_timestamp").alias("day")
    return articles.groupBy(day).agg(F.count("*").alias("articles"), F.hll_sketch_agg("url", log2_size).alias("urls"))


def distinct_urls(sketches: DataFrame, span: Column) -> DataFrame:
    """Articles and estimated distinct urls of each span of days, like a month, from the sketches of its days."""
    merged = sketches.groupBy(span.alias("span")).agg(F.sum("articles").alias("articles"), F.hll_union_agg("urls").alias("_urls"))
    return merged.select("span", "articles", F.hll_sketch_estimate("_urls").alias("distinct_urls"))


# --- enrichments --------------------------------------------------------------------------------


def with_label(enrichments: DataFrame, labels: str, label: str) -> DataFrame:
    return enrichments.where(F.array_contains(labels, label))


def metadata_field(enrichments: DataFrame, field: str) -> DataFrame:
    kept = enrichments.where("custom_metadata IS NOT NULL")
    return kept.select("url", F.get_json_object("custom_metadata", f"$.{field}").alias(field))


LATEST = ["sentiment", "sentiment_score", "issue_labels", "entity_labels", "enrichment_timestamp", "enrichment_version"]


def latest_enrichments(enrichments: DataFrame, tie: str, columns: list[str] | None = None) -> DataFrame:
    """The newest version of each url; `tie` decides between equal times."""
    at = F.struct("enrichment_timestamp", tie)
    return latest_value(enrichments, "url", at, *[F.col(c) for c in columns or LATEST])


def sentiment_distribution(enrichments: DataFrame) -> DataFrame:
    return enrichments.groupBy("sentiment").agg(F.count("*").alias("n"))


def coverage(articles: DataFrame, enrichments: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Share of the recent articles that have an enrichment. Both sides are distinct before the join."""
    recent = since(articles, "collection_timestamp", as_of, days).select("url").distinct()
    enriched = enrichments.select("url").distinct().withColumn("_enriched", F.lit(True))
    joined = recent.join(enriched, "url", "left")
    return joined.agg(F.count("url").alias("total_articles"), F.count("_enriched").alias("enriched_articles")).withColumn(
        "coverage_pct", percent(F.col("enriched_articles"), F.col("total_articles"))
    )


def urls_needing_enrichment(articles: DataFrame, enrichments: DataFrame, version: str | None = None) -> DataFrame:
    """Distinct urls with text and without an enrichment, or without one of the given version."""
    if version is not None:
        enrichments = enrichments.where(F.col("enrichment_version") == version)
    wanted = articles.where("article_text IS NOT NULL").select("url").distinct()
    return without(wanted, enrichments.select("url").distinct(), "url")


def articles_with_latest(articles: DataFrame, enrichments: DataFrame, as_of: Column, tie: str, days: int = 30) -> DataFrame:
    """Recent articles with their newest enrichment, newest article first."""
    newest = latest_enrichments(enrichments, tie, ["sentiment", "sentiment_score", "issue_labels", "entity_labels"])
    recent = since(articles, "collection_timestamp", as_of, days)
    recent = recent.select("url", "title", "article_text", "publish_date", "collection_timestamp")
    # The url is part of the order so that the rows of one run, which share their time, are spread over the sort's tasks.
    return recent.join(newest, "url", "left").orderBy(F.desc("collection_timestamp"), "url")


def table_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table, largest first."""
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    rows = counts[0]
    for other in counts[1:]:
        rows = rows.union(other)
    return rows.orderBy(F.desc("row_count"), "table_name")


# --- runs ---------------------------------------------------------------------------------------


def _newest(runs: DataFrame, rows: int) -> DataFrame:
    return runs.orderBy(F.desc("start_timestamp"), "run_id").limit(rows)


def failed_runs(runs: DataFrame) -> DataFrame:
    return runs.where("status = 'failed'").orderBy(F.desc("start_timestamp"), "run_id")


def backfill_runs(runs: DataFrame, start: Column) -> DataFrame:
    """Completed runs that began at the backfill day, newest first."""
    hits = runs.where((F.col("status") == "completed") & (F.col("start_date") == start))
    return hits.orderBy(F.desc("start_timestamp"), "run_id")


def daily_runs(runs: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    return since(runs, "start_timestamp", as_of, days).groupBy(F.to_date("start_timestamp").alias("date")).agg(
        F.count("*").alias("runs"),
        F.sum("queries_count").alias("total_queries"),
        F.sum("urls_collected").alias("total_urls"),
        F.sum("articles_scraped").alias("total_articles"),
        F.count_if(F.col("status") == "completed").alias("successful_runs"),
        F.count_if(F.col("status") == "failed").alias("failed_runs"),
    ).orderBy(F.desc("date"))


def range_runs(runs: DataFrame) -> DataFrame:
    """How often each exact range was collected."""
    return runs.where("status = 'completed'").groupBy("start_date", "end_date").agg(F.count("*").alias("runs"))


def recent_runs(runs: DataFrame, rows: int | None = 10, as_of: Column | None = None, days: int = 7) -> DataFrame:
    """The newest runs: `rows` of them, and with `as_of` only those of the last `days` days (all of these with rows=None)."""
    if as_of is not None:
        runs = since(runs, "start_timestamp", as_of, days)
    return (runs if rows is None else _newest(runs, rows)).select(
        "run_id", "start_date", "end_date", "status", "urls_collected", "articles_scraped",
        percent(F.col("articles_scraped"), F.col("urls_collected")).alias("scrape_success_rate"),
        F.timestamp_diff("SECOND", "start_timestamp", "end_timestamp").alias("duration_seconds"),
    )


def urls_per_query(runs: DataFrame, rows: int = 10) -> DataFrame:
    done = _newest(runs.where("status = 'completed' AND queries_count > 0"), rows)
    return done.select(
        "run_id", "start_date", "end_date", F.col("queries_count").alias("executed"), "urls_collected",
        ratio(F.col("urls_collected"), F.col("queries_count")).alias("urls_per_query"),
    )


def query_efficiency(runs: DataFrame) -> DataFrame:
    done = runs.where("status = 'completed' AND queries_count > 0")
    exact = F.col("urls_collected") / F.col("queries_count")
    return done.select(
        "run_id", F.col("queries_count").alias("executed"), "urls_collected",
        ratio(F.col("urls_collected"), F.col("queries_count")).alias("urls_per_query"),
        F.when(exact > 3, "efficient").when(exact > 1, "normal").otherwise("wasteful").alias("efficiency"),
    )


def dedup_effect(runs: DataFrame, rows: int = 10) -> DataFrame:
    done = _newest(runs.where("status = 'completed'"), rows)
    return done.select(
        "run_id", F.col("urls_collected").alias("total_found"), F.col("articles_scraped").alias("after_dedup"),
        (F.col("urls_collected") - F.col("articles_scraped")).alias("duplicates_skipped"),
    )


def company_queries(runs: DataFrame, run_queries: DataFrame, pattern: str) -> DataFrame:
    """Distinct queries of completed runs that match, sorted. The match is made before the join."""
    hits = run_queries.where(F.col("query").like(pattern)).select("run_id", "query")
    done = runs.where("status = 'completed'").select("run_id")
    return hits.join(done, "run_id", "left_semi").select("query").distinct().orderBy("query")


def company_cost(run_queries: DataFrame, articles: DataFrame) -> DataFrame:
    """Distinct queries per company site, its collected rows, and rows per query; most queries first."""
    sites = run_queries.select("query").distinct().groupBy(query_site(F.col("query")).alias("company"))
    queries = sites.agg(F.count("*").alias("total_queries"))
    results = articles.groupBy(query_site(F.col("query")).alias("company")).agg(F.count("*").alias("total_results"))
    joined = queries.join(results, "company", "left")
    found = F.coalesce("total_results", F.lit(0))
    return joined.select(
        "company", "total_queries", found.alias("total_results"), ratio(found, F.col("total_queries"), 4).alias("avg_results")
    ).orderBy(F.desc("total_queries"), "company")


# --- extraction log -----------------------------------------------------------------------------


def scraper_report(log: DataFrame) -> DataFrame:
    return counts_with_share(log.where("scraper_used IS NOT NULL"), "scraper_used")


def error_report(log: DataFrame) -> DataFrame:
    return counts_with_share(log.where("error_type IS NOT NULL"), "error_type")


def scrape_summary(log: DataFrame, filtered: Column, elapsed_s: Column | None = None) -> DataFrame:
    """One row over the attempted urls. Rates are over the attempted ones; `success_rate_total` is over all."""
    ok = F.col("scraper_used").isNotNull()
    base = log.agg(
        F.count("*").alias("attempted"), F.count_if(ok).alias("successful"), F.count_if(~ok).alias("failed"),
        F.avg(F.when(ok, F.col("processing_time_s"))).alias("_mean"),
        F.sum("processing_time_s").alias("_spent"),
    ).withColumn("filtered", filtered)
    total = F.col("attempted") + F.col("filtered")
    elapsed = F.col("_spent") if elapsed_s is None else elapsed_s
    return base.select(
        total.alias("total_urls"), "filtered", percent(F.col("filtered"), total, 1).alias("filtered_pct"), "attempted",
        "successful", percent(F.col("successful"), F.col("attempted"), 1).alias("success_rate"),
        percent(F.col("successful"), total, 1).alias("success_rate_total"),
        "failed", percent(F.col("failed"), F.col("attempted"), 1).alias("failed_rate"),
        F.round("_mean", 4).alias("mean_time_s"), F.round(F.try_divide(F.col("attempted"), elapsed), 4).alias("articles_per_s"),
    )


def errors_by_host(log: DataFrame) -> DataFrame:
    failed = log.where("error_type IS NOT NULL").groupBy(host(F.col("url")).alias("host"))
    return failed.agg(F.count("*").alias("errors")).orderBy(F.desc("errors"), "host")
