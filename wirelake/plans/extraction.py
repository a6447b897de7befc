"""Article text and metadata from a table of pages."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wirelake import schemas
from wirelake.functions import html as H
from wirelake.functions import structured
from wirelake.functions.times import coerce_timestamp

ERROR_TYPE = "All Scrapers Failed"  # Fixed values of the error rows.
ERROR_MESSAGE = "All scrapers failed"


def extract(pages: DataFrame, strategies: dict[str, H.Strategy] | None = None, html: str = "html") -> DataFrame:
    """Replaces the page by `article_text` and `scraper_used`; both are null where no strategy finds enough text.

    Each strategy sits in a projection of its own behind a test on the result so far, so it is evaluated once
    per page and only for the pages that the earlier ones left open.
    """
    return _extracted(pages.withColumn("_body", H.visible(F.col(html))).drop(html), strategies)


def _extracted(df: DataFrame, strategies: dict[str, H.Strategy] | None = None) -> DataFrame:
    """The same for pages whose visible markup is in `_body`."""
    df = df.withColumns({c: F.lit(None).cast("string") for c in ("article_text", "scraper_used")})
    for name, strategy in (strategies or H.STRATEGIES).items():
        df = df.withColumn("_found", F.when(F.col("scraper_used").isNull(), strategy(F.col("_body"))))
        df = df.withColumns(_outcome(name))
    return _settled(df.drop("_body", "_found"))


def _outcome(name: str) -> dict[str, Column]:
    """Text and strategy after the strategy `name` gave `_found`, which is null where an earlier one had a text."""
    ok = H.has_content(F.col("_found"))
    return {
        "article_text": F.when(ok, F.col("_found")).otherwise(F.col("article_text")),
        "scraper_used": F.when(ok, F.lit(name)).otherwise(F.col("scraper_used")),
    }


def _settled(df: DataFrame) -> DataFrame:
    """The same rows, behind a one-row generator that a later filter on the outcome is not pushed through.

    Pushed through the projections, the filter would hold the whole chain, each step written out several times.
    """
    others = [c for c in df.columns if c not in ("article_text", "scraper_used")]
    return df.select(*others, F.inline_outer(F.array(F.struct("article_text", "scraper_used"))))


def python_strategy(find: Callable[[str], str | None]) -> Callable[[Column], Column]:
    """A user's extractor, a function from a page to its text or None, as a column function on Arrow batches.

    Null pages are passed over without a call.
    """

    @F.pandas_udf("string")
    def found(batch: pd.Series) -> pd.Series:
        return batch.map(find, na_action="ignore").astype(object)

    return found


def extract_then_python(
    pages: DataFrame, extractors: dict[str, Callable[[str], str | None]], html: str = "html",
    strategies: dict[str, H.Strategy] | None = None,
) -> DataFrame:
    """The native chain, then the user's Python extractors in order, each on the pages still open.

    A page that already has its text reaches the Python worker as a null, so only open pages are sent and
    searched, and the pages are read once.
    """
    df = extract(pages.withColumn("_page", F.col(html)), strategies, html)
    for name, find in extractors.items():
        df = df.withColumn("_open", F.when(F.col("scraper_used").isNull(), F.col("_page")))
        df = df.withColumn("_found", python_strategy(find)(F.col("_open")))
        df = df.withColumns(_outcome(name))
    return _settled(df.drop("_page", "_open", "_found"))


def contents(extracted: DataFrame) -> DataFrame:
    return extracted.where("scraper_used IS NOT NULL")


def errors(extracted: DataFrame, at: Column) -> DataFrame:
    """Error rows of the pages without text."""
    return _error_rows(extracted.where("scraper_used IS NULL"), at)


def errors_of(asked: DataFrame, extracted: DataFrame, at: Column) -> DataFrame:
    """Error rows of the asked urls none of whose pages gave a text, those without a stored page among them."""
    return _error_rows(asked.join(contents(extracted).select("url"), "url", "left_anti"), at)


def _error_rows(failed: DataFrame, at: Column) -> DataFrame:
    rows = failed.select(
        "url", F.lit(ERROR_TYPE).alias("error_type"), F.lit(ERROR_MESSAGE).alias("error_message"), at.alias("timestamp")
    )
    return schemas.conform(rows, schemas.ERRORS)


def extract_described(pages: DataFrame, html: str = "html") -> DataFrame:
    """Text as by `extract`, with the publish date, description and tags that the page states."""
    stated = _described(pages.withColumn("_body", H.visible(F.col(html))), html, keep=["_body"])
    stated = stated.withColumnsRenamed({"description": "page_description", "tags": "page_tags"}).drop("title")
    return _extracted(stated)


def page_metadata(pages: DataFrame, html: str = "html") -> DataFrame:
    """Title, publish date, description and tags as the page states them; null where it does not.

    Meta tags and the title element come first, then microdata, then JSON-LD blocks, and for the date any other `<time>`."""
    return _described(pages.withColumn("_body", H.visible(F.col(html))), html)


def _described(body: DataFrame, html: str, keep: list[str] | None = None) -> DataFrame:
    """Metadata of pages (`html`) whose visible markup is in `_body`; the page itself is dropped."""
    def stated(text: Column) -> Column:
        return F.nullif(text, F.lit(""))

    b = F.col("_body")
    linked = body.withColumn("_linked", structured.linked_nodes(F.col(html)))

    def first(markup: Column, name: str) -> Column:
        own = H.plain(F.coalesce(stated(markup), structured.item_markup(b, name)))
        return F.coalesce(stated(own), structured.linked_value(F.col("_linked"), name))

    published = F.coalesce(
        stated(H.meta_content(b, "article:published_time")), structured.item_markup(b, "datePublished"),
        structured.linked_value(F.col("_linked"), "datePublished"),
        stated(F.regexp_extract(b, r"""(?is)<time\b[^>]*\sdatetime\s*=\s*["']([^"']*)["']""", 1)),
    )
    others = [c for c in body.columns if c not in (html, "_body")]
    found = linked.select(
        *others, *(keep or []), first(H.title_markup(b), "headline").alias("title"), published.alias("_published"),
        first(H.meta_content(b, "description"), "description").alias("description"),
        first(H.meta_content(b, "keywords"), "keywords").alias("tags"),
    )
    return found.withColumn("publish_date", coerce_timestamp(F.col("_published"))).drop("_published")
