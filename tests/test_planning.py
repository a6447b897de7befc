import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from wirelake.plans import planning, runs

JAN = ("2026-01-05", "2026-01-10")


def day(text):
    return F.lit(text).cast("date")


def companies(spark, *urls):
    return spark.createDataFrame([(f"c{i}", u) for i, u in enumerate(urls)], "corporation string, newsroom_url string")


def newsrooms(spark, *urls):
    return spark.createDataFrame([(u,) for u in urls], "newsroom_url string")


def history(spark, *rows):
    """Runs as (id, start, end, status, queries)."""
    table = spark.createDataFrame([(r[0], date.fromisoformat(r[1]), date.fromisoformat(r[2]), r[3]) for r in rows],
                                  "run_id string, start_date date, end_date date, status string")
    queries = spark.createDataFrame([(r[0], q) for r in rows for q in r[4]], "run_id string, query string")
    return table, queries


def plan(spark, urls, known, past, force=False):
    table, queries = history(spark, *past)
    return planning.collection_plan(
        companies(spark, *urls), newsrooms(spark, *known), table, queries, day(JAN[0]), day(JAN[1]), "2026-01-01", force)


def texts(df):
    return [r.query for r in df.collect()]


def test_same_range_twice_executes_nothing(spark):
    first = plan(spark, ["a", " b "], ["a", "b"], [("0", "2000-01-01", "2000-01-01", "completed", ["x"])])
    assert first.where("skip").count() == 0 and first.count() == 2
    again = plan(spark, ["a", "b"], ["a", "b"], [("1", *JAN, "completed", texts(first))])
    assert again.where("NOT skip").count() == 0


def test_failed_runs_do_not_count(spark):
    queries = texts(plan(spark, ["a"], ["a"], [("0", *JAN, "failed", ["x"])]))
    assert plan(spark, ["a"], ["a"], [("1", *JAN, "failed", queries)]).where("skip").count() == 0


def test_new_company_is_backfilled_alone(spark):
    done = texts(plan(spark, ["a", "b"], ["a", "b"], [("0", *JAN, "failed", ["x"])]))
    later = plan(spark, ["a", "b", "new"], ["a", "b"], [("1", *JAN, "completed", done)]).where("NOT skip").collect()
    assert [(r.newsroom_url, str(r.start_date)) for r in later] == [("new", "2026-01-01")]


def test_force_executes_all_as_requested(spark):
    done = texts(plan(spark, ["a"], ["a"], [("0", *JAN, "failed", ["x"])]))
    forced = plan(spark, ["a", "new"], ["a"], [("1", *JAN, "completed", done)], force=True)
    assert forced.where("skip").count() == 0
    assert {str(r.start_date) for r in forced.collect()} == {JAN[0]}


def test_unusable_newsrooms_and_repeats(spark):
    p = plan(spark, ["a", None, "  ", "a"], [], [("0", *JAN, "failed", ["x"])])
    assert p.count() == 2 and len(set(texts(p))) == 1


def test_scope_all_moves_every_start(spark):
    new = planning.backfill_urls(companies(spark, "a", "n"), newsrooms(spark, "a"), "2026-01-01")
    moved = planning.effective_ranges(companies(spark, "a", "n"), new, day(JAN[0]), day(JAN[1]), scope="all")
    assert {str(r.start_date) for r in moved.collect()} == {"2026-01-01"}
    none = planning.effective_ranges(companies(spark, "a"), new.where("false"), day(JAN[0]), day(JAN[1]), scope="all")
    assert {str(r.start_date) for r in none.collect()} == {JAN[0]}


def test_unanswered_queries_stay_open(spark):
    p = plan(spark, ["a", "b", "b"], ["a", "b"], [("0", *JAN, "failed", ["x"])])
    first, second = sorted(set(texts(p)))
    resolved = spark.createDataFrame([(second, 0), (second, 1), (first, 1)], "query string, page_no int")
    assert texts(planning.executed_now(p, resolved)) == [second]


def test_date_ranges():
    today = date(2026, 2, 11)
    assert planning.DateRange.of(None, None, today) == planning.DateRange(date(2026, 2, 1), today)
    assert planning.DateRange.of("2026-1-5", "2026-01-10", today).start == date(2026, 1, 5)
    assert planning.DateRange.last_days(3, today).start == date(2026, 2, 8)
    for bad in (("2026-01-10", "2026-01-05"), ("01/05/2026", None), ("2026-13-01", None)):
        with pytest.raises(ValueError):
            planning.DateRange.of(*bad, today)


def test_run_events(spark):
    ids = spark.createDataFrame([("1", date(2026, 1, 1), date(2026, 1, 2)), ("2", date(2026, 1, 1), date(2026, 1, 2)), ("3", date(2026, 1, 1), date(2026, 1, 2))],
                                "run_id string, start_date date, end_date date")
    at = F.lit("2026-01-03 10:00:00").cast("timestamp_ntz")
    started = runs.start_events(ids, at)
    ends = spark.createDataFrame([("1", 5, None), ("2", None, "it's 'broken'; DROP")], "run_id string, urls_collected long, error_message string")
    events = started.union(runs.end_events(ends, at))
    rows = {r.run_id: (r.status, r.urls_collected, r.error_message) for r in runs.run_rows(events).collect()}
    assert rows == {"1": ("completed", 5, None), "2": ("failed", None, "it's 'broken'; DROP"), "3": ("started", None, None)}
    states = {r.run_id: r.status for r in runs.run_states(events, "status").collect()}
    assert states == {"1": "completed", "2": "failed", "3": "started"}
    later = F.lit("2026-01-04 10:00:00").cast("timestamp_ntz")
    again = spark.createDataFrame([("2", 7, None)], "run_id string, urls_collected long, error_message string")
    events = events.union(runs.start_events(ids.where("run_id = '2'"), later)).union(runs.end_events(again, later))
    row = runs.run_rows(events).where("run_id = '2'").first()
    assert (row.status, row.urls_collected, row.error_message) == ("completed", 7, None)


@pytest.mark.parametrize("seed", [1, 2])
def test_ranges_against_all_pairs(spark, seed):
    """Runs that overlap, touch, lie inside others, and leave gaps inside and outside of the ranges; a query of a third of all runs."""
    pick = random.Random(seed)
    day = date(2024, 1, 1)
    runs = [(f"r{i}", s := day + timedelta(days=pick.randrange(120)), s + timedelta(days=pick.randrange(-1, 12)), pick.choice(["completed"] * 4 + ["failed"])) for i in range(150)]
    queries = [(r[0], f"q{k}") for r in runs for k in {pick.randrange(12), pick.randrange(40), 0 if pick.random() < 0.33 else 1}]
    queries += queries[:50] + [("unknown", "q0")]
    ranges = [(s := day + timedelta(days=pick.randrange(-5, 130)), s + timedelta(days=pick.randrange(-1, 60))) for _ in range(120)]
    got = {tuple(r)[:2]: tuple(r)[2:] for r in planning.executed_by_range(
        spark.createDataFrame(ranges + ranges[:5], "range_start date, range_end date"),
        spark.createDataFrame(runs, "run_id string, start_date date, end_date date, status string"),
        spark.createDataFrame(queries, "run_id string, query string")).collect()}
    wanted = {}
    for a, b in ranges:
        met = {r[0] for r in runs if r[3] == "completed" and r[1] <= r[2] and r[1] <= b and r[2] >= a and a <= b}
        if met:
            wanted[a, b] = len(met), len({q for run, q in queries if run in met})
    assert got == wanted
