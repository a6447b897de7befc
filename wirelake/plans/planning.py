"""Which searches to run: date ranges, backfill, generated queries, and those already executed."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wirelake.functions.links import search_url
from wirelake.functions.times import days_before
from wirelake.operators.joins import contained, without
from wirelake.sources.reference import with_usable_url

DEFAULT_DAYS = 10  # Fixed values: days of a request without dates, and first day of a backfill.
BACKFILL_START = "2026-01-01"


@dataclass(frozen=True)
class DateRange:
    """A requested range with both ends included."""

    start: date
    end: date

    def __post_init__(self):
        if self.start > self.end:
            raise ValueError("the start date must not be after the end date")

    @staticmethod
    def of(start: str | None, end: str | None, today: date) -> DateRange:
        """Range from two `YYYY-MM-DD` texts; the last ten days where they are absent."""
        def parsed(text: str | None, default: date) -> date:
            return default if text is None else datetime.strptime(text, "%Y-%m-%d").date()

        return DateRange(parsed(start, today - timedelta(days=DEFAULT_DAYS)), parsed(end, today))

    @staticmethod
    def last_days(days: int, today: date) -> DateRange:
        return DateRange(today - timedelta(days=days), today)

    @property
    def columns(self) -> tuple[Column, Column]:
        return F.lit(self.start), F.lit(self.end)


def last_run_end(runs: DataFrame) -> DataFrame:
    """End date of the newest completed run: where a run "since the last one" begins."""
    done = runs.where("status = 'completed'")
    return done.select(F.max_by("end_date", F.struct("start_timestamp", "run_id")).alias("end_date"))


def date_windows(runs: DataFrame, as_of: Column, days: int) -> DataFrame:
    """The three ways to choose a range: default, last `days` days, since the newest completed run."""
    today = F.to_date(as_of)
    one = last_run_end(runs).select(F.col("end_date").alias("since"), today.alias("today"))
    rows = F.array(
        F.struct(F.lit("default").alias("mode"), F.date_sub("today", DEFAULT_DAYS).alias("start_date"), F.col("today").alias("end_date")),
        F.struct(F.lit("last_days").alias("mode"), F.date_sub("today", days).alias("start_date"), F.col("today").alias("end_date")),
        F.struct(F.lit("since_last").alias("mode"), F.col("since").alias("start_date"), F.col("today").alias("end_date")),
    )
    return one.select(F.inline(rows))


def generate_queries(ranges: DataFrame, distinct: bool = False, encode: bool = False) -> DataFrame:
    """One search per row of `newsroom_url, start_date, end_date`; repeated newsrooms stay repeated unless `distinct`."""
    query = search_url(F.col("newsroom_url"), F.col("start_date"), F.col("end_date"), encode=encode)
    queries = ranges.withColumn("query", query)
    return queries.select("newsroom_url", "start_date", "end_date", "query").distinct() if distinct else queries


def term_queries(terms: DataFrame, domains: list[str], start: Column, end: Column) -> DataFrame:
    """One search per term and outlet. The outlets are a short configured list, so they travel in the plan."""
    each = terms.select("term", F.explode(F.array(*[F.lit(d) for d in domains])).alias("domain"))
    return each.withColumn("query", search_url(F.col("domain"), start, end, term=F.col("term")))


def executed_queries(runs: DataFrame, run_queries: DataFrame, start: Column, end: Column) -> DataFrame:
    """Distinct queries of completed runs whose range meets [start, end].

    The queries are not made distinct per run first: that would shuffle all of them even where the runs in
    range are few enough for a broadcast, and AQE splits a run with very many queries.
    """
    done = runs.where((F.col("status") == "completed") & (F.col("start_date") <= end) & (F.col("end_date") >= start))
    return run_queries.join(done.select("run_id"), "run_id", "left_semi").select("query").distinct()


def executed_by_range(ranges: DataFrame, runs: DataFrame, run_queries: DataFrame) -> DataFrame:
    """For each requested range, the number of completed runs that meet it and of distinct queries they executed.

    `ranges` has `range_start` and `range_end`. No range meets a run: a range meets what began by its last day, less what
    ended before its first, and both are running sums over the days. For queries, the runs of a query are merged to pieces
    that do not overlap. The pieces that meet a range follow each other, so of a query with several of them all but one are
    taken off by the gaps between them that lie inside the range. Pieces and gaps are counted by their days, of which a
    calendar has few, however many runs and queries there are. Runs that end before they begin count nowhere.
    """
    done = runs.where("status = 'completed' AND start_date <= end_date").select("run_id", "start_date", "end_date")
    # the days of a query once, combined before the shuffle, so that a query of very many runs is as many rows as it has days
    dated = run_queries.join(done, "run_id").select("query", "start_date", "end_date").distinct()
    of_query = Window.partitionBy("query").orderBy("start_date", "end_date")
    before = F.max("end_date").over(of_query.rowsBetween(Window.unboundedPreceding, -1))
    reach = F.max("end_date").over(of_query.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    steps = dated.select("start_date", before.alias("reached"), reach.alias("reach"), F.lead("query").over(of_query).isNull().alias("last"))
    gap = F.col("reached") < F.col("start_date")
    # one row for each piece's begin, with the end of the piece before it, and one for the last end of the query
    edges = steps.select(F.inline(F.array(
        F.struct(F.when(F.col("reached").isNull() | gap, F.col("start_date")).alias("begin"), F.when(gap, F.col("reached")).alias("end")),
        F.struct(F.lit(None).cast("date").alias("begin"), F.when(F.col("last"), F.col("reach")).alias("end")),
    ))).where("begin IS NOT NULL OR end IS NOT NULL")
    # behind a generator, so that the filters of those who read it are not pushed into it and all of them share one exchange
    pieces = edges.groupBy("begin", "end").agg(F.count("*").alias("n")).select(F.inline(F.array(F.struct("begin", "end", "n"))))
    asked = ranges.select("range_start", "range_end").distinct().where("range_start <= range_end")
    met = _met(asked, done.groupBy("start_date", "end_date").agg(F.count("*").alias("n")), pieces)
    inside = contained(asked, pieces.where("begin IS NOT NULL AND end IS NOT NULL"), ("range_start", "range_end"), ("end", "begin"))
    extra = inside.groupBy("range_start", "range_end").agg(F.sum("n").alias("extra"))
    rows = met.join(extra, ["range_start", "range_end"], "left").where("n_runs > 0")
    return rows.select("range_start", "range_end", "n_runs", (F.col("n_pieces") - F.coalesce("extra", F.lit(0))).alias("n_queries"))


def _met(ranges: DataFrame, runs: DataFrame, pieces: DataFrame) -> DataFrame:
    """The ranges with the runs (`start_date`, `end_date`, `n`) and pieces (`begin`, `end`, `n`) that meet each of them."""
    kinds = ["runs_begun", "runs_ended", "pieces_begun", "pieces_ended"]

    def days(df: DataFrame, first: str, last: str, what: str) -> DataFrame:
        def event(day: str, kind: str) -> Column:
            return F.struct(F.col(day).alias("day"), *[(F.col("n") if k == kind else F.lit(0).cast("long")).alias(k) for k in kinds])

        return df.select(F.inline(F.array(event(first, f"{what}_begun"), event(last, f"{what}_ended"))))

    bounds = ranges.select(F.explode(F.array("range_end", F.date_sub("range_start", 1))).alias("day"), *[F.lit(0).cast("long").alias(k) for k in kinds])
    events = days(runs, "start_date", "end_date", "runs").union(days(pieces, "begin", "end", "pieces")).union(bounds)
    daily = events.where("day IS NOT NULL").groupBy("day").agg(*[F.sum(k).alias(k) for k in kinds])
    # one row for each day at most; behind a generator, so that both joins read one and the same exchange
    sums = daily.select("day", *[F.sum(k).over(Window.orderBy("day")).alias(k) for k in kinds])
    until = sums.select(F.inline(F.array(F.struct("day", *kinds))))
    last = until.select(F.col("day").alias("range_end"), "runs_begun", "pieces_begun")
    first = until.select(F.date_add("day", 1).alias("range_start"), "runs_ended", "pieces_ended")
    return ranges.join(last, "range_end").join(first, "range_start").select(
        "range_start", "range_end", (F.col("runs_begun") - F.col("runs_ended")).alias("n_runs"),
        (F.col("pieces_begun") - F.col("pieces_ended")).alias("n_pieces"))


def backfill_urls(reference: DataFrame, known: DataFrame, start: str = BACKFILL_START) -> DataFrame:
    """Newsrooms that are not among the known ones (column `newsroom_url`), with the day to collect from."""
    current = with_usable_url(reference).select("newsroom_url").distinct()
    return without(current, known, "newsroom_url").withColumn("start_date", F.lit(start).cast("date"))


def effective_ranges(
    reference: DataFrame, new: DataFrame, start: Column, end: Column, force: bool = False, scope: str = "url"
) -> DataFrame:
    """The range to search for each company: from the backfill day for a new newsroom, else as requested.

    With scope "all", one new newsroom moves the start for every company. `force` leaves the request as it is.
    """
    companies = with_usable_url(reference)
    if force:
        return companies.withColumn("start_date", start.cast("date")).withColumn("end_date", end.cast("date"))
    if scope == "all":
        begin = F.coalesce(new.select(F.min("start_date")).scalar(), start.cast("date"))
        return companies.withColumn("start_date", begin).withColumn("end_date", end.cast("date"))
    joined = companies.join(new.select("newsroom_url", F.col("start_date").alias("_from")), "newsroom_url", "left")
    begin = F.coalesce(F.col("_from"), start.cast("date"))
    return joined.withColumn("start_date", begin).withColumn("end_date", end.cast("date")).drop("_from").select(
        *companies.columns, "start_date", "end_date"
    )


def queries_to_execute(queries: DataFrame, executed: DataFrame, force: bool = False) -> DataFrame:
    """Generated queries whose exact text was not executed before."""
    return queries if force else without(queries, executed, "query")


def collection_plan(
    reference: DataFrame, known: DataFrame, runs: DataFrame, run_queries: DataFrame, start: Column, end: Column,
    backfill_start: str = BACKFILL_START, force: bool = False, scope: str = "url",
) -> DataFrame:
    """Every generated query with `skip` = it was executed before.

    History is looked up over the widest range planned; the dates are part of the query text, so the exact
    comparison decides.
    """
    new = backfill_urls(reference, known, backfill_start)
    queries = generate_queries(effective_ranges(reference, new, start, end, force, scope))
    if force:
        return queries.withColumn("skip", F.lit(False))
    widest = F.least(F.lit(backfill_start).cast("date"), start.cast("date"))
    done = executed_queries(runs, run_queries, widest, end).withColumn("_done", F.lit(True))
    return queries.join(done, "query", "left").select(*queries.columns, F.coalesce("_done", F.lit(False)).alias("skip"))


def executed_now(plan: DataFrame, resolved_pages: DataFrame) -> DataFrame:
    """Planned queries that were run and got a first page; the others stay open for the next run."""
    first = resolved_pages.where("page_no = 0").select("query")
    return plan.where(~F.col("skip")).select("query").distinct().join(first, "query", "left_semi")


def plan_counts(reference: DataFrame, plan: DataFrame, new: DataFrame) -> DataFrame:
    """One row: companies, queries generated, skipped and to execute, newsrooms to backfill."""
    return plan.agg(
        F.count("*").alias("queries_generated"),
        F.count_if("skip").alias("queries_skipped"),
        F.count_if(~F.col("skip")).alias("queries_executed"),
    ).select(
        reference.select(F.count("*")).scalar().alias("companies_count"),
        "queries_generated", "queries_skipped", "queries_executed",
        new.select(F.count("*")).scalar().alias("backfill_urls_count"),
    )


def window_of(as_of: Column, days: int) -> tuple[Column, Column]:
    return F.to_date(days_before(as_of, days)), F.to_date(as_of)
