import itertools
import json
import random

from wirelake.sources import search


def test_resolution_against_a_retry_loop(spark):
    cases = list(itertools.product([(200, "{}"), (200, "{"), (200, None), (0, None), (429, "{}"), (500, None)], repeat=3))
    log = [(n, a, s, p) for n, case in enumerate(cases) for a, (s, p) in enumerate(case)]
    df = spark.createDataFrame(log, "page int, attempt int, status int, payload string")
    for limit in (1, 2, None):
        got = {r.page: (r.resolved_attempt, r.payload) for r in search.resolve_fetches(df, "page", max_attempts=limit).collect()}
        for n, case in enumerate(cases):
            wanted = (None, None)
            for attempt, (status, payload) in enumerate(case[:limit]):
                if status == 200 and payload == "{}":
                    wanted = (attempt, payload)
                if wanted[0] is not None or status == 0:
                    break
            assert got[n] == wanted, case


def test_chain_against_a_reader(spark):
    rng = random.Random(3)
    pages = {f"q{q}": {n: (rng.choice([0, 3, 3, 3]), rng.choice([None, "next", "next"])) for n in range(6) if rng.random() < 0.9} for q in range(60)}
    df = spark.createDataFrame(
        [(q, n, c, link) for q, p in pages.items() for n, (c, link) in p.items()], "query string, page_no int, n_results int, next_page_link string")
    for limit in (1, 2, 4, None):
        got = sorted((r.query, r.page_no) for r in search.chained_pages(df, limit).collect())
        wanted = []
        for q, p in pages.items():
            n = 0
            while (limit is None or n < limit) and p.get(n, (0, None))[0] > 0:
                wanted.append((q, n))
                if p[n][1] is None:
                    break
                n += 1
        assert got == sorted(wanted)


def test_payloads(spark):
    good = json.dumps({"general": {"query": "site:a"}, "organic": [{"title": "t", "link": "l", "rank": 1, "more": [1]}, {"rank": 2}]})
    raw = [(1, good), (2, good[:-1]), (3, "{}"), (4, None), (5, "no json"), (6, '{"general": {"query": "q"}, "organic": []}')]
    pages = search.read_payloads(spark.createDataFrame(raw, "id int, payload string"))
    rows = search.result_rows(pages).collect()
    assert [tuple(r) for r in rows] == [(1, "site:a", "t", None, "l", 1), (1, "site:a", None, None, None, 2)]
    assert pages.count() == 6


def test_fields_of_another_type(spark):
    payload = {"general": {"query": 7}, "organic": [{"rank": "2", "title": 5}, {"rank": 1.0, "link": "l"}, {"rank": "x"}, {"rank": [1], "title": {"a": 1}}]}
    rows = search.result_rows(search.read_payloads(spark.createDataFrame([(json.dumps(payload),)], "payload string"))).collect()
    assert [(r.query, r["title"], r.link, r["rank"]) for r in rows] == [
        ("7", "5", None, 2), ("7", None, "l", 1), ("7", None, None, None), ("7", '{"a":1}', None, None)]


def test_failed_queries_and_union(spark):
    queries = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "query string")
    resolved = spark.createDataFrame([("a", 0, 3), ("b", 1, 3), ("c", 0, 0)], "query string, page_no int, n_results long")
    assert sorted(r.query for r in search.failed_queries(queries, resolved).collect()) == ["b", "c"]
    both = search.union_pages(queries, resolved)
    assert both.count() == 7 and both.where("page_no IS NULL").count() == 4
