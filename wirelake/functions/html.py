"""Text and metadata out of an HTML string, as native column expressions.

The patterns repeat single characters only (`[^>]*`, `.*?` under `(?s)`), so the matcher needs no
recursion and a long page cannot overflow a task's stack.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from wirelake.functions.elements import first_element, outside
from wirelake.functions.references import resolved
from wirelake.functions.words import trimmed

MIN_CHARS = 100  # Fixed value: shorter texts do not count as content.
HIDDEN = r"(?is)<(?:script\b.*?</script\s*>|style\b.*?</style\s*>|!--.*?-->)"
BLOCK_TAG = r"(?i)</?(?:p|div|article|section|main|header|footer|nav|aside|ul|ol|li|table|tr|td|h[1-6]|br|blockquote)\b[^>]*>"
ANY_TAG = r"<[^>]*>"
# Parts of a page that are not its article.
HEAD = r"(?is)<head\b.*?</head\s*>"
FRAME = ["nav", "footer", "aside", "form"]
LINK = r"(?is)<a\b[^>]*>(.*?)</a\s*>"
TAG_WORTH = 10  # Characters of text that a block has for each of its inline tags, to count as text.

Strategy = Callable[[Column], Column]


def visible(html: Column) -> Column:
    """The page without scripts, styles and comments."""
    return F.regexp_replace(html, HIDDEN, " ")


def plain(markup: Column) -> Column:
    """Markup as text: tags become blanks, references are resolved, blanks are folded."""
    text = resolved(F.regexp_replace(markup, ANY_TAG, " "))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def has_content(text: Column) -> Column:
    return F.length(trimmed(text)) >= MIN_CHARS


def semantic(body: Column) -> Column:
    """Text of the first article element, with the articles inside it."""
    return plain(F.coalesce(first_element(body, "article"), F.lit("")))


def density(body: Column) -> Column:
    """All blocks that are mainly text: under half of it in links, and TAG_WORTH characters or more for each inline tag.

    The parts between block tags are the blocks, joined in page order. No test is on the length of a block or of the page.
    """
    def block(part: Column) -> Column:
        tags = F.length(part) - F.length(F.replace(part, F.lit("<"), F.lit("")))
        linked = F.array_join(F.regexp_extract_all(part, F.lit(LINK), F.lit(1)), " ")
        texts = F.transform(F.array(part, linked), plain)
        return F.struct(F.get(texts, F.lit(0)).alias("text"), tags.alias("tags"), F.length(F.get(texts, F.lit(1))).alias("links"))

    def is_text(b: Column) -> Column:
        return (2 * b["links"] < F.length(b["text"])) & (F.length(b["text"]) >= TAG_WORTH * b["tags"])

    parts = F.split(outside(F.regexp_replace(body, HEAD, "<p>"), FRAME, "<p>"), BLOCK_TAG)
    kept = F.filter(F.transform(parts, block), is_text)
    return F.array_join(F.transform(kept, lambda b: b["text"]), " ")


def readability(body: Column) -> Column:
    """All paragraph elements."""
    return plain(F.array_join(F.regexp_extract_all(body, F.lit(r"(?is)<p\b[^>]*>(.*?)</p\s*>"), F.lit(1)), " "))


def meta(body: Column) -> Column:
    """The page's own description."""
    return plain(meta_content(body, "description"))


def meta_content(body: Column, name: str) -> Column:
    """Content of the page's first meta tag of that name; empty where there is none. Attributes come in any order and quotes."""
    tags = F.regexp_extract_all(body, F.lit(r"(?is)<meta\b[^>]*>"), F.lit(0))
    named = rf"""(?is)\s(?:name|property)\s*=\s*["']?{re.escape(name)}["'\s/>]"""
    tag = F.get(F.filter(tags, lambda t: F.rlike(t, F.lit(named))), F.lit(0))

    return F.coalesce(attribute(tag, "content"), F.lit(""))


def attribute(tag: Column, name: str) -> Column:
    """Value of a tag's attribute, in either kind of quotes or none; null where it is missing or empty."""
    def value(pattern: str) -> Column:
        return F.nullif(F.regexp_extract(tag, rf"(?is)\s{name}\s*=\s*{pattern}", 1), F.lit(""))

    return F.coalesce(value('"([^"]*)"'), value("'([^']*)'"), value(r"""([^"'\s/>]+)"""))


def title_markup(body: Column) -> Column:
    return F.regexp_extract(body, r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1)


# Cheap and precise first; a text found by one strategy stops the chain.
STRATEGIES: dict[str, Strategy] = {
    "semantic": semantic,
    "density": density,
    "readability": readability,
    "meta": meta,
}
