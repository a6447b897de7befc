import math
import random
import re
from collections import Counter
from itertools import zip_longest

import pytest
from pyspark.sql import functions as F

from wirelake.functions import html
from wirelake.plans import extraction, text


def scores(spark, texts, lexicon, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    words = spark.createDataFrame(lexicon, "word string, val double")
    return {r.id: (r.score, r.sentiment) for r in text.sentiment(docs, "id", "t", words, **options).collect()}


def test_sentiment(spark):
    texts = ["Good news.", "not good", "not a very good", "not one two three good", "bad", "good bad", "", None, "plain", "good not"]
    got = scores(spark, texts, [("good", 2.0), ("bad", -2.0)])
    norm = lambda s: round(s / math.sqrt(s * s + 15), 6)
    wanted = [2, 2 * -0.74, 2 * -0.74, 2, -2, 0, 0, 0, 0, 2]
    assert [got[i][0] for i in range(10)] == [norm(s) for s in wanted]
    assert [got[i][1] for i in range(10)] == ["positive", "negative", "negative", "positive", "negative", *["neutral"] * 4, "positive"]


def plain_rules(texts, values, rules):
    """The rules word by word."""
    out = []
    for t in texts:
        words = re.findall(r"[^\W\d_]+", t or "")
        low, shouted = [w.lower() for w in words], [len(w) > 1 and w.isupper() for w in words]
        mixed = any(shouted) and not all(shouted)
        turn = low.index(rules.contrast) if rules.contrast in low else None
        total = 0.0
        for i, w in enumerate(low):
            if w not in values:
                continue
            v = values[w] + (math.copysign(rules.capitals, values[w]) if mixed and shouted[i] and values[w] else 0)
            v += math.copysign(1, v) * sum(rules.boosters.get(low[i - d], 0) * rules.decay[d - 1] for d in (1, 2, 3) if i >= d) if v else 0
            v *= -0.74 if any(low[i - d] in rules.negators for d in (1, 2, 3) if i >= d) else 1
            total += v * (1 if turn is None or i == turn else rules.before_contrast if i < turn else rules.after_contrast)
        asks = (t or "").count("?")
        marks = min((t or "").count("!"), 4) * rules.exclamation + (rules.many_questions if asks > 3 else asks * rules.question if asks > 1 else 0)
        total += math.copysign(marks, total) if total else 0
        out.append(round(total / math.sqrt(total * total + 15), 6))
    return out


def test_sentiment_by_rules(spark):
    values = {"good": 2.0, "bad": -2.0, "fine": 0.5, "but": 0.1}
    pick = random.Random(3)
    vocabulary = ["good", "GOOD", "bad", "Bad", "fine", "very", "slightly", "VERY", "not", "never", "but", "But", "plain", "é", "x"]
    texts = ["".join(pick.choice(vocabulary) + pick.choice([" ", " ", ", ", "! ", "? "]) for _ in range(pick.randrange(12))) for _ in range(300)]
    texts += ["", None, "GOOD NEWS", "good", "very good", "so very good", "slightly bad", "not very good", "good but bad", "good!!!!!!", "bad???", "??!", "sort of good"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    lexicon = spark.createDataFrame(list(values.items()), "word string, val double")
    for rules in (text.RULES, text.Rules(boosters={"x": 1.0}, decay=(1.0, 0.5, 0.25), contrast="é", negators=("plain",))):
        got = {r.id: (r.score, r.sentiment) for r in text.sentiment_by_rules(docs, "id", "t", lexicon, rules).collect()}
        wanted = plain_rules(texts, values, rules)
        assert [got[i][0] for i in range(len(texts))] == pytest.approx(wanted, abs=2e-6)
        assert all(label == ("positive" if s > 0.1 else "negative" if s < -0.1 else "neutral") for s, label in got.values())


def test_rules_shuffle_partial_sums_only(spark, data):
    docs, lexicon = spark.read.parquet(f"{data}/documents.parquet"), spark.sql("SELECT * FROM VALUES ('the', 1.0D) AS l(word, val)")
    plan = text.sentiment_by_rules(docs, "doc_id", "text", lexicon)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Window" not in plan


def test_rules_with_a_lexicon_of_unknown_or_large_size(spark):
    """A lexicon that only seems large moves no words; a large one moves those it may hold. Repeated and null words, ids and values."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    pick = random.Random(4)
    vocabulary = ["w1", "W1", "wa", "WA", "wb", "very", "NOT", "not", "but", "plain", "x"]
    texts = [" ".join(pick.choice(vocabulary) + pick.choice(["", "!", "??"]) for _ in range(pick.randrange(9))) for _ in range(200)] + ["", None, "plain", "WA WB"]
    docs = spark.createDataFrame([(None if n % 50 == 7 else n // 2, t) for n, t in enumerate(texts)], "id int, t string")
    few = spark.createDataFrame([("wa", 2.0), ("wb", -1.5), ("wb", 0.5), ("w", None), ("plain", None), (None, 3.0), ("but", 0.25)], "word string, val double")
    wanted = sorted(map(str, text.sentiment_by_rules(docs, "id", "t", few).collect()))
    many = spark.range(2_000_000).where("id % 500000 = 1").select(F.concat(F.lit("none"), F.col("id")).alias("word"), F.lit(1.0).alias("val"))
    rows = text.sentiment_by_rules(docs, "id", "t", few.union(many))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan
    assert sorted(map(str, rows.collect())) == wanted
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = text.sentiment_by_rules(docs, "id", "t", few)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "getbit" in plan and "LeftOuter" not in plan
        assert sorted(map(str, rows.collect())) == wanted
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_large_lexicon_without_broadcast(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    few = scores(spark, ["w1 w2 not w3", "x"], [(f"w{i}", float(i)) for i in range(10)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert scores(spark, ["w1 w2 not w3", "x"], [(f"w{i}", float(i)) for i in range(10)]) == few
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_keywords_and_summary(spark):
    docs = spark.createDataFrame([
        (1, "Rain falls. Rain and rain on hills! Hills are green? The end."), (2, ""), (3, None), (4, "one")], "id int, t string")
    words = {r.id: r.keywords for r in text.keywords(docs, "id", "t", k=2, stopwords=["the"]).collect()}
    assert words == {1: "rain, hills", 4: "one"}
    found = {r.id: r.summary for r in text.summaries(docs, "id", "t", k=2).collect()}
    assert found == {1: "Rain falls. Rain and rain on hills!", 2: "", 3: "", 4: "one"}


def plain_central(t, k):
    found = [s.strip() for s in re.findall(r"[^.!?\n]+[.!?]*", t or "")]
    sets = [set(w.lower() for w in re.findall(r"[^\W\d_]+", s)) for s in found]
    score = [sum(len(a & b) for j, b in enumerate(sets) if j != i) / math.sqrt(len(a)) if a else None for i, a in enumerate(sets)]
    best = sorted((i for i, s in enumerate(score) if s is not None), key=lambda i: (-score[i], i))[:k]
    return " ".join(found[i] for i in sorted(best))


def test_central_summaries(spark):
    pick = random.Random(9)
    words = "rain hill green wind sea stone bird late early north".split()
    texts = [" ".join(" ".join(pick.choice(words) for _ in range(pick.randrange(9))) + pick.choice([".", "!", "?", "\n", ". "]) for _ in range(pick.randrange(12))) for _ in range(120)]
    texts += ["", None, "one", "Rain. Rain falls on the hills and on the sea. The hills are green. Sea and hills and rain.", "12. 13."]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = {r.id: r.summary for r in text.central_summaries(docs, "id", "t", k=2).collect()}
    assert [got[i] for i in range(len(texts))] == [plain_central(t, 2) for t in texts]
    # a sentence of one frequent word does not come before one that shares several
    assert got[len(texts) - 2] == "Rain falls on the hills and on the sea. Sea and hills and rain."


def test_one_exchange(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    plan = text.keywords(docs, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    told = text.summaries(docs, "doc_id", "text")
    told.collect()
    final = told._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


@pytest.mark.parametrize("job", [text.keywords, text.central_summaries, text.summaries])
def test_memory_of_a_task_is_that_of_its_texts(spark, job):
    """A task sorts its texts by id, and no table of its words and no sort of them grows with the partition."""
    docs = spark.createDataFrame([(i, f"a b{i}. c a") for i in range(50)], "id int, t string")
    found = job(docs, "id", "t")
    found.collect()
    final = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert not any(step in final for step in ("HashAggregate", "SortAggregate", "Window", "Generate")) and "MapInArrow" in final


def test_texts_across_batches(spark):
    """Ids that come several times, also over many batches, nulls, ties, long words; the texts of an id count together."""
    pick = random.Random(4)
    some = ["Rain rain on hills. Hills.", "b a. c", "", None, "12 34", "É été ÉTÉ. x", "sea wind sea? no"]
    rows = [(pick.choice([None, *range(6)]), pick.choice(some)) for _ in range(90)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        docs = spark.createDataFrame(rows, "id int, t string")
        got = {r.id: r.keywords for r in text.keywords(docs, "id", "t", k=4, min_length=2, stopwords=["no"]).collect()}
        told = text.summaries(docs, "id", "t", k=2).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    counts = {i: Counter(w for j, t in rows if j == i for w in re.findall(r"[^\W\d_]{2,}", (t or "").lower()) if w != "no") for i, _ in rows}
    assert got == {i: ", ".join(sorted(c, key=lambda w: (-c[w], w.encode()))[:4]) for i, c in counts.items() if c}
    wanted = []
    for i in range(6):
        lists = [[s.strip() for s in re.findall(r"[^.!?\n]+[.!?]*", t or "")] for j, t in rows if j == i]
        joined = [[w for a in column if a for w in re.findall(r"[^\W\d_]+", a.lower())] for column in zip_longest(*lists)]
        often = Counter(w for words in joined for w in words)
        score = {n: sum(often[w] for w in words) / len(words) for n, words in enumerate(joined) if words}
        best = sorted(sorted(score, key=lambda n: (-score[n], n))[:2])
        wanted += [(i, " ".join(own[n] for n in best if n < len(own))) for own in lists]
    assert Counter((r.id, r.summary) for r in told) == Counter(wanted)


LONG = "word " * 30
PAGES = {
    "semantic": f"<html><script>var t='<article>{LONG}</article>'</script><article><p>{LONG}&amp; more</p></article>",
    "density": f"<div>{LONG * 5}</div><p>x</p>",
    "readability": f"<p><a href=x>{'short ' * 12}</a></p><p><a href=y>{'text ' * 15}</a></p>",
    "meta": f'<meta name="description" content="{LONG}"><p>x</p>',
    None: "<p>too short</p>",
}


def test_chain(spark):
    pages = spark.createDataFrame([(n or "none", p) for n, p in PAGES.items()], "url string, html string")
    got = {r.url: r for r in extraction.extract(pages).collect()}
    assert {u: r.scraper_used for u, r in got.items()} == {n or "none": n for n in PAGES}
    assert got["semantic"].article_text == (LONG + "& more").strip()
    at = F.lit("2026-01-01").cast("timestamp_ntz")
    assert [(r.url, r.error_type) for r in extraction.errors(extraction.extract(pages), at).collect()] == [("none", "All Scrapers Failed")]
    chain, failed = (df._jdf.queryExecution().optimizedPlan().toString() for df in (extraction.extract(pages), extraction.errors(extraction.extract(pages), at)))
    assert failed.count("(?:article)") == chain.count("(?:article)") > 0  # the filter does not repeat the chain


def test_density_keeps_all_blocks(spark):
    """Neither the size of the page nor that of a block decides; links and boilerplate elements are left out."""
    blocks = [f"Paragraph {i}: " + "some words " * (5 + 9 * i) for i in range(5)]
    page = "<head><title>T</title></head><nav><a href=x>Home</a></nav><div><h1>Heading</h1>" + "".join(f"<p>{b}</p>" for b in blocks)
    page += "<p>Be.</p><p><a href=x>more of this kind</a></p></div><footer>the end of it</footer>"
    wanted = " ".join(["Heading", *[b.strip() for b in blocks], "Be."])
    for html_page, text_ in ((page, wanted), (page.replace("some words ", "w "), wanted.replace("some words ", "w ").replace("some words", "w"))):
        row = extraction.extract(spark.createDataFrame([("u", html_page)], "url string, html string")).first()
        assert (row.scraper_used, row.article_text) == ("density", text_)


def test_python_extractors_see_open_pages_only(spark):
    def loud(page):
        if "too short" not in page:
            raise ValueError("a page with text was sent")
        return "found " * 40

    def unused(page):
        raise ValueError("no page was left")

    pages = spark.createDataFrame([(n or "none", p) for n, p in PAGES.items()] + [("null", None)], "url string, html string")
    open_and_null = pages.where("url <> 'null'")
    got = {r.url: r.scraper_used for r in extraction.extract_then_python(open_and_null, {"mine": loud, "second": unused}).collect()}
    assert got == {**{n: n for n in PAGES if n}, "none": "mine"}
    assert extraction.extract_then_python(pages, {"mine": loud}).where("url = 'null'").first().scraper_used is None


def test_metadata(spark):
    page = ('<title>A &amp; B</title><meta name="description" content="about"><meta name="keywords" content="x, y">'
            '<time datetime="2026-01-02">')
    row = extraction.page_metadata(spark.createDataFrame([("u", page), ("v", "")], "url string, html string")).orderBy("url").collect()
    assert (row[0].title, row[0].description, row[0].tags, str(row[0].publish_date)) == ("A & B", "about", "x, y", "2026-01-02 00:00:00")
    assert row[1].title is None and row[1].publish_date is None


@pytest.mark.parametrize(("markup", "content"), [
    ('<meta name="description" content="a">', "a"), ("<META CONTENT='a' NAME='description'/>", "a"), ("<meta property=description content=a>", "a"),
    ('<meta name="description2" content="b"><meta content="a" name="description">', "a"), ('<meta name="description">', ""),
    ('<meta name="description" content="it&#8217;s &#x201c;x&rdquo; &amp;#65; &#65;&#0; &#xD800; &#99999999;">', "it’s “x” &#65; A&#0; &#xD800; &#99999999;"),
])
def test_meta_tags(spark, markup, content):
    df = spark.createDataFrame([(markup,)], "h string")
    assert df.select(html.meta(F.col("h"))).first()[0] == content


@pytest.mark.parametrize("n", [99, 100])
def test_content_threshold(spark, n):
    df = spark.createDataFrame([(" \n" + "x" * n + "\t ",)], "t string")
    assert df.select(html.has_content(F.col("t"))).first()[0] is (n >= 100)


def test_long_page_does_not_overflow(spark):
    page = "<article>" + "<p>" + "a<b>\n" * 200_000 + "</article>"
    row = extraction.extract(spark.createDataFrame([("u", page)], "url string, html string")).first()
    assert row.scraper_used == "semantic"
