"""From search rows to article rows, and from stored articles to new enrichments."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wirelake.functions.links import FILTER_REASON, host, rejection_rule
from wirelake.operators.filters import may_be_among
from wirelake.operators.joins import without
from wirelake.operators.keyed import first_per_key
from wirelake.operators.shares import percent
from wirelake.plans import extraction
from wirelake.plans.reports import earliest_articles, urls_needing_enrichment
from wirelake.plans.runs import end_events, start_events
from wirelake.plans.text import keywords, sentiment, summaries
from wirelake.sources.store import NewsStore, stamp_enrichments


def split_links(results: DataFrame, link: str = "link") -> DataFrame:
    """Adds `rule`, null for an article link, and `reason` for the filtered ones. Every row is kept."""
    ruled = results.withColumn("rule", rejection_rule(F.col(link)))
    return ruled.withColumn("reason", F.when(F.col("rule").isNotNull(), FILTER_REASON))


def new_links(results: DataFrame, processed: DataFrame, link: str = "link") -> DataFrame:
    """Rows whose link was not processed before, repeated links included; a frame without links is left as it is."""
    return without(results, processed, link) if link in results.columns else results


def join_content(results: DataFrame, content: DataFrame, link: str, *order: Column) -> DataFrame:
    """Search rows with the content of their url; every row is kept, unscraped ones with nulls.

    Content is reduced to its first row per url in the given order; on a column that both sides have, the
    search row's value wins. A link on very many search rows is split by AQE from the measured sizes.
    """
    taken = set(results.columns) - {link}
    once = first_per_key(content, "url", *order).withColumnRenamed("url", link)
    once = once.select(link, *[c for c in once.columns if c != link and c not in taken])
    return results.join(once, link, "left")


# Writes a frame under a stage name and reads it back.
Keep = Callable[[DataFrame, str], DataFrame]


@dataclass
class Collection:
    """Frames of one collection; nothing runs until one of them is used."""

    links: DataFrame  # new search rows with rule and reason, and text, publish date and sentiment for the article links
    errors: DataFrame  # wanted urls without text

    @property
    def articles(self) -> DataFrame:
        return self.links.where("rule IS NULL").drop("rule", "reason").withColumnRenamed("link", "url")

    @property
    def filtered(self) -> DataFrame:
        return self.links.where("rule IS NOT NULL").select(F.col("link").alias("url"), "rule", "reason")


def collect(
    results: DataFrame, processed: DataFrame, pages: DataFrame, lexicon: DataFrame, id_col: str, at: Column,
    *page_order: Column, keep: Keep, text_col: str = "description", negators: list[str] | None = None,
    described: bool = False,
) -> Collection:
    """New links, classified; text and metadata for the article links; sentiment of the description.

    `keep` writes the new links, the extracted texts and the joined rows as stages, so that each is made once, however
    often it is read. With `described`, articles get a summary and keywords, made once per url.

    Pages are extracted where they are stored, and only their texts move. A Bloom filter of the asked urls, which the tasks
    that read the pages get with the plan, leaves about the asked pages to be extracted; the join with the asked urls decides.
    """
    links = keep(split_links(new_links(results, processed)), "new_links")
    wanted = links.where("rule IS NULL")
    asked = wanted.select(F.col("link").alias("url")).distinct()
    near = pages.where(may_be_among("url", asked, "url", wanted.count()))
    texts = keep(extraction.extract_described(near).join(asked, "url", "left_semi"), "page_texts")
    content = extraction.contents(texts)
    if described:
        content = describe(first_per_key(content, "url", *page_order), "url")
    scores = sentiment(wanted, id_col, text_col, lexicon, negators)
    scored = links.join(scores, id_col, "left")
    # A filtered link finds no content: its page was not asked for unless another row asks for the same url,
    # and equal urls have equal rules.
    joined = keep(join_content(scored, content.drop("page_description", "page_tags"), "link", *page_order), "joined_rows")
    return Collection(joined, extraction.errors_of(asked, texts, at))


def describe(articles: DataFrame, id_col: str, by: str = "semantic", text_col: str = "article_text") -> DataFrame:
    """Adds `summary` and `keywords` of the articles whose text the strategy `by` found.

    For the strategy "meta" they are the page's own description and tags. Articles with another text have empty ones,
    articles without a text have nulls.
    """
    told = articles.where(F.col("scraper_used") == by)
    found = summaries(told, id_col, text_col).join(keywords(told, id_col, text_col), id_col, "full")
    joined = articles.join(found, id_col, "left")
    for name, own in (("summary", "page_description"), ("keywords", "page_tags")):
        stated = F.when(F.col("scraper_used") == "meta", F.col(own)) if own in articles.columns else F.lit(None)
        joined = joined.withColumn(name, F.when(F.col("scraper_used").isNotNull(), F.coalesce(name, stated, F.lit(""))))
    return joined


def record(
    run: Collection, news: NewsStore, run_id: str, start: Column, end: Column, at: Column, queries: DataFrame, companies: DataFrame
) -> dict[str, int]:
    """Writes a collection to the tables and returns the row counts. `queries` are the ones that got an answer, `companies`
    (`company`) those that were asked for.

    The run's start is logged first and its end last; a run that fails on the way is logged as failed. Each table gets the
    rows of a run in one commit, and one that has them already is left as it is, so a run may be recorded again.
    """
    this = news.spark.range(1).select(F.lit(run_id).alias("run_id"), start.alias("start_date"), end.alias("end_date"))
    news.append_events(start_events(this, at))

    def log_end(executed: int | None, urls: int | None, scraped: int | None, error: str | None) -> None:
        counts = {"queries_count": executed, "urls_collected": urls, "articles_scraped": scraped}
        row = this.select("run_id", *[F.lit(n).cast("long").alias(c) for c, n in counts.items()], F.lit(error).alias("error_message"))
        news.append_events(end_events(row, at))

    def once(table: str, write: Callable[[], int]) -> int:
        stored = news.rows_of_run(table, run_id)
        return stored if stored else write()

    this_run = F.lit(run_id)
    scores = run.articles.select("url", "sentiment", F.col("score").alias("sentiment_score"))
    try:
        counts = {
            "companies": once("run_companies", lambda: news.append_companies(companies, this_run, at)),
            "articles": once("collected_articles", lambda: news.append_articles(run.articles, this_run, at)),
            "enrichments": once("article_enrichments", lambda: news.append_enrichments(scores, this_run, at)),
            "errors": once("scrape_errors", lambda: news.append_errors(run.errors, this_run)),
            "filtered": once("filtered_links", lambda: news.append_filtered(run.filtered, this_run, at)),
            "queries": once("run_queries", lambda: news.append_queries(queries, this_run, at)),
        }
        counts["scraped"] = news.rows_of_run("collected_articles", run_id, "scraper_used IS NOT NULL")
    except Exception as error:
        log_end(None, None, None, str(error))
        raise
    log_end(counts["queries"], counts["articles"], counts["scraped"], None)
    return counts


def collection_report(run: Collection) -> DataFrame:
    """One row per host: links found, filtered, attempted, with text, and the sentiment of the articles."""
    article = F.col("rule").isNull()
    report = run.links.groupBy(host(F.col("link")).alias("host")).agg(
        F.count("*").alias("found"),
        F.count("rule").alias("filtered"),
        F.count_if(article).alias("attempted"),
        F.count_if(article & F.col("scraper_used").isNotNull()).alias("scraped"),
        *[F.count_if(article & (F.col("sentiment") == s)).alias(s) for s in ("positive", "neutral", "negative")],
    )
    return report.withColumn("scraped_pct", percent(F.col("scraped"), F.col("attempted"), 1))


def collection_counts(run: Collection) -> DataFrame:
    """One row: search rows, articles with text, articles with a sentiment."""
    return run.links.agg(
        F.count("*").alias("serp_results_count"),
        F.count_if(F.col("rule").isNull() & F.col("scraper_used").isNotNull()).alias("articles_scraped"),
        F.count("sentiment").alias("enriched"),
    )


def enrichment_rows(articles: DataFrame) -> DataFrame:
    return articles.select("url", "sentiment")


def refresh_enrichments(
    articles: DataFrame, enrichments: DataFrame, lexicon: DataFrame, version: str, run_id: Column, at: Column, *tie: Column,
    text_col: str = "description", negators: list[str] | None = None,
) -> DataFrame:
    """Enrichment rows under `version` for the urls that have none of it yet."""
    urls = urls_needing_enrichment(articles, enrichments, version)
    needed = articles.where("article_text IS NOT NULL").join(urls, "url", "left_semi")
    texts = earliest_articles(needed, *tie).select("url", text_col)
    scored = sentiment(texts, "url", text_col, lexicon, negators).withColumnRenamed("score", "sentiment_score")
    return stamp_enrichments(scored, run_id, at, version)
