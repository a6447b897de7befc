"""Nested elements, character references and structured metadata against plain versions."""

import html as stdlib
import random
import re

import pytest
from pyspark.sql import functions as F

from wirelake.functions import elements, references
from wirelake.plans import extraction

TAG = re.compile(r"(?i)</?(nav|aside|article)\b[^>]*>")
RNG = random.Random(11)


def random_page(tags):
    return "".join(RNG.choice([f"t{i} ", RNG.choice(tags), RNG.choice(tags)]) for i in range(RNG.randrange(14)))


def pieces(page, names):
    """Text between the tags of these names, and the step of the tag before each."""
    out, last, step = [], 0, 0
    for m in TAG.finditer(page):
        if m[1].lower() in names:
            out.append((page[last : m.start()], step))
            last, step = m.end(), -1 if m[0].startswith("</") else 1
    return [*out, (page[last:], step)]


def plain_first(page):
    depth, inside = 0, None
    for text, step in pieces(page, {"article"}):
        if inside is not None and depth + step == 0:
            break
        depth = max(0, depth + step)
        if depth and inside is None:
            inside = []
        if inside is not None:
            inside.append(text)
    return None if inside is None else " ".join(inside)


def plain_outside(page):
    parts = pieces(page, {"nav", "aside"})
    depths, depth = [], 0
    for _, step in parts:
        depth = max(0, depth + step)
        depths.append(depth)
    return "|".join(text for i, (text, _) in enumerate(parts) if depths[i] <= min(depths[i:]))


def values(spark, rows, column):
    df = spark.createDataFrame(list(enumerate(rows)), "i int, t string")
    return [r[0] for r in df.select("i", column(F.col("t")).alias("x")).orderBy("i").select("x").collect()]


def test_first_element(spark):
    tags = ["<article>", "</article>", "<ARTICLE class=x>", "</Article >", "<b>"]
    pages = [random_page(tags) for _ in range(300)] + ["<article><p>A</p><article>inner</article><p>rest</p></article>after", "", None]
    assert values(spark, pages, lambda t: elements.first_element(t, "article")) == [None if p is None else plain_first(p) for p in pages]


def test_outside(spark):
    tags = ["<nav>", "</nav>", "<aside id=x>", "</aside>", "<p>"]
    pages = [random_page(tags) for _ in range(300)] + ["a<nav>b<nav>c</nav>d</nav>e", "never <nav>closed", "", None]
    assert values(spark, pages, lambda t: elements.outside(t, ["nav", "aside"], "|")) == [None if p is None else plain_outside(p) for p in pages]


def test_many_tags(spark):
    page = "<nav>x</nav>y" * 2000
    assert values(spark, [page], lambda t: elements.outside(t, ["nav"], "")) == ["y" * 2000]


def test_references_as_the_standard_has_them(spark):
    names = list(stdlib.entities.html5)
    ends = ["", " ", ";", "x", "1", "=", "&", "é"]
    texts = [f"a &{n}{RNG.choice(ends)} b &{RNG.choice(names)}" for n in names]
    numbers = [n for n in range(0x20, 0x2FFF, 7) if not 0x7F <= n < 0xA0] + [0x80, 0x96, 0x9F, 0x1F600, 0x10FFFD, 0xE9]
    texts += [f"&#{n};&#x{n:x};&#X{n:04X} &#00{n}{RNG.choice(ends[:3])}" for n in numbers]
    texts += ["&#38;lt; &amp;amp; &amp;#65;", "&", "&&", "&;", "&#;", "&#x;", "&#xg;", "a & b &c", "&bogus;", "&notit;", "&amp", "&#65"]
    wanted = [stdlib.unescape(t).replace("\xa0", " ") if "&#160" not in t else None for t in texts]
    got = values(spark, texts, references.resolved)
    assert [(t, g) for t, g, w in zip(texts, got, wanted, strict=True) if w is not None and g != w] == []


def test_references_that_name_no_character_stay(spark):
    texts = ["&#0;", "&#xD800;", "&#x110000;", "&#99999999;", None, ""]
    assert values(spark, texts, references.resolved) == texts


@pytest.mark.parametrize(("page", "wanted"), [
    ('<script type="application/ld+json">{"headline": "H", "datePublished": "2024-05-06T07:08:09", "keywords": ["a", "b"]}</script>', ("H", None, "a, b", "2024-05-06 07:08:09")),
    ('<title>Own</title><script type="application/ld+json">{"headline": "H"}</script>', ("Own", None, None, "None")),
    ('<script type="application/ld+json">[]</script><script type="application/ld+json">{"@graph": [{}, {"description": "later"}]}</script>', (None, "later", None, "None")),
    ('<script type="application/ld+json">{"headline": {"x": 1}, "keywords": []}</script>', ('{"x":1}', None, None, "None")),
    ('<script>{"headline": "not stated"}</script>', (None, None, None, "None")),
    ("<h1 itemprop='headline'>A &amp; <i>B</i></h1><time itemprop=datePublished datetime='2024-01-02'>x</time>", ("A & B", None, None, "2024-01-02 00:00:00")),
    ("<span itemprop=headlines>no</span><span itemprop=headline></span>", (None, None, None, "None")),
    ("", (None, None, None, "None")), (None, (None, None, None, "None")),
])
def test_stated_metadata(spark, page, wanted):
    row = extraction.page_metadata(spark.createDataFrame([(page,)], "html string")).first()
    assert (row.title, row.description, row.tags, str(row.publish_date)) == wanted
