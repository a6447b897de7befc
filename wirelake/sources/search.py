"""Search-result payloads: fetch log, page chains, rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAYLOAD = T.StructType([
    T.StructField("general", T.StructType([T.StructField("query", T.StringType())])),
    T.StructField("organic", T.ArrayType(T.StructType([
        T.StructField("title", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("link", T.StringType()),
        T.StructField("rank", T.StringType()),
    ]))),
    T.StructField("pagination", T.StructType([T.StructField("next_page_link", T.StringType())])),
])


def is_json(payload: Column) -> Column:
    return F.try_parse_json(payload).isNotNull()


def read_payloads(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Adds `echoed_query`, `organic` and `next_page_link`; a text that is not JSON has no results.

    Fields are read as text and cast one by one, so a field of another type is null and costs nothing else.
    """
    parsed = F.when(is_json(F.col(payload)), F.from_json(payload, PAYLOAD))
    rank = "CAST(try_cast(r.rank AS DOUBLE) AS BIGINT)"
    results = F.expr(f"transform(_parsed.organic, r -> struct(r.title, r.description, r.link, {rank} AS rank))")
    return (
        raw.withColumn("_parsed", parsed)
        .withColumn("echoed_query", F.col("_parsed.general.query"))
        .withColumn("organic", results)
        .withColumn("next_page_link", F.col("_parsed.pagination.next_page_link"))
        .drop("_parsed", payload)
    )


def result_rows(pages: DataFrame) -> DataFrame:
    """One row per search result; a field that the payload lacks is null."""
    return pages.withColumn("_r", F.explode("organic")).select(
        *[c for c in pages.columns if c not in ("organic", "next_page_link", "echoed_query")],
        F.col("echoed_query").alias("query"), "_r.title", "_r.description", "_r.link", "_r.rank",
    )


def resolve_fetches(attempts: DataFrame, *keys: str, max_attempts: int | None) -> DataFrame:
    """Outcome of each page from the log of its attempts (`attempt` from 0, `status`, `payload`): the resolved one, and its payload.

    The first attempt with status 200 and a payload that is JSON counts; one that is not is tried again like an error.
    Status 0 stands for an error that is not retried. Attempts from `max_attempts` on don't count; None: all count.
    """
    tried = attempts if max_attempts is None else attempts.where(F.col("attempt") < max_attempts)
    good = (F.col("status") == 200) & is_json(F.col("payload"))
    pages = tried.groupBy(*keys).agg(
        F.min(F.when(good, F.struct("attempt", "payload"))).alias("_good"),
        F.min(F.when(F.col("status") == 0, F.col("attempt"))).alias("_fatal"),
    )
    in_time = F.col("_fatal").isNull() | (F.col("_good.attempt") < F.col("_fatal"))
    return pages.select(*keys, *[F.when(in_time, F.col(f"_good.{c}")).alias(name) for c, name in (("attempt", "resolved_attempt"), ("payload", "payload"))])


def chained_pages(pages: DataFrame, max_pages: int | None) -> DataFrame:
    """Pages that a reader following next links would see, up to `max_pages` per query (None: all).

    `pages` has `query`, `page_no`, `n_results` (null or 0 for an empty or unresolved page) and `next_page_link`.
    Page n + 1 is read only if page n has results and a next link; an empty page ends the chain.
    """
    near = pages.where(F.col("n_results") > 0)
    near = near if max_pages is None else near.where(F.col("page_no") < max_pages)
    near = near.groupBy("query", "page_no").agg(
        F.max("n_results").alias("n_results"), F.max("next_page_link").alias("next_page_link")
    )
    order = Window.partitionBy("query").orderBy("page_no")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    no_gap = F.row_number().over(order) == F.col("page_no") + 1
    linked = F.coalesce(F.bool_and(F.col("next_page_link").isNotNull()).over(earlier), F.lit(True))
    kept = near.withColumn("_kept", no_gap & linked).where("_kept")
    return kept.select(
        "query", "page_no", "n_results", F.concat("next_page_link", F.lit("&brd_json=1")).alias("next_request")
    )


def failed_queries(queries: DataFrame, pages: DataFrame) -> DataFrame:
    """Queries whose first page was not resolved or has no results. `pages` as in `chained_pages`."""
    first = pages.where((F.col("page_no") == 0) & (F.col("n_results") > 0)).select("query")
    return queries.select("query").distinct().join(first, "query", "left_anti")


def union_pages(*frames: DataFrame) -> DataFrame:
    """All rows of the page frames; a column that one of them lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
