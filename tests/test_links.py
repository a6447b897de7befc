import pytest
from pyspark.sql import functions as F

from wirelake.functions import links

# One invented url for each rule and place where its mark may stand, and others that come close to a rule.
LISTINGS = {
    "https://alpha.test/updates?page=7": "pagination",
    "https://alpha.test/updates?sort=old&page=2": "pagination",
    "https://alpha.test/page/12/": "pagination",
    "https://beta.test/press": "index",
    "https://beta.test/about/press-release//": "index",
    "https://beta.test/en/MEDIA": "index",
    "https://gamma.test/tag/turbines": "section",
    "https://gamma.test/x/archive/y": "section",
    "https://delta.test/find?search=turbine": "search",
    "https://delta.test/find?lang=de&search=turbine": "search",
    "https://epsilon.test/reports/1987/": "year_archive",
}
ARTICLES = [
    "https://alpha.test/homepage=2",
    "https://beta.test/newsroom/turbine-opens",
    "https://beta.test/pressroom",
    "https://gamma.test/category",
    "https://delta.test/research?topic=wind",
    "https://epsilon.test/reports/1987/summary",
    "https://epsilon.test/reports/19870",
]
OTHERS = {
    "HTTPS://X.COM/NEWS///": "index",
    "https://x.com/a&PAGE=2": "pagination",
    "https://x.com/author/jane": "section",
    "https://x.com/?a=1&q=deal": "search",
    "https://x.com/?s=deal": "search_term",
    "https://x.com/?s=2429": None,
    "https://x.com/?s=deal&item=12": None,
    "https://x.com/?s=": None,
    "https://x.com/2026/": "year_archive",
    "https://x.com/2026/01": None,
    "https://x.com/12026": None,
    None: "missing",
}


def test_rules(spark):
    wanted = {**LISTINGS, **dict.fromkeys(ARTICLES), **OTHERS}
    df = spark.createDataFrame([(u,) for u in wanted], "url string")
    got = {r.url: r.rule for r in df.select("url", links.rejection_rule(F.col("url")).alias("rule")).collect()}
    assert got == wanted


@pytest.mark.parametrize("query", [
    "https://www.google.com/search?q=site:https://a.com/press+before:2024-01-31+after:2024-01-01&gl=US",
    "site:https://a.com/press before:2024-01-31 after:2024-01-01",
])
def test_site_of_both_spellings(spark, query):
    df = spark.createDataFrame([(query,)], "q string").select(links.query_site(F.col("q")).alias("s"))
    assert df.first().s == "https://a.com/press"


def test_search_url(spark):
    df = spark.createDataFrame([("https://a.com/p?x=1&y=2", "2026-01-01", "2026-01-10", 'a & "b"')], "u string, s string, e string, t string")
    row = df.select(
        links.search_url(F.col("u"), F.col("s"), F.col("e")).alias("plain"),
        links.search_url(F.col("u"), F.col("s"), F.col("e"), encode=True).alias("encoded"),
        links.search_url(F.col("u"), F.col("s"), F.col("e"), term=F.col("t")).alias("term"),
    ).first()
    tail = "+before:2026-01-10+after:2026-01-01&gl=US&hl=en&brd_json=1"
    assert row.plain == "https://www.google.com/search?q=site:https://a.com/p?x=1&y=2" + tail
    assert row.encoded == "https://www.google.com/search?q=site:https%3A%2F%2Fa.com%2Fp%3Fx%3D1%26y%3D2" + tail
    assert row.term == "https://www.google.com/search?q=a%20%26%20%22b%22+site:https://a.com/p?x=1&y=2" + tail
