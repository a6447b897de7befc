"""Rules over links and search queries."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from wirelake.functions.words import trimmed

# A link that shows one of these is a listing, not an article.
PAGING_MARKS = ["?page=", "&page=", "/page/"]
INDEX_NAMES = ["press", "newsroom", "news", "press-releases", "media", "press-release"]
SECTION_MARKS = ["/category/", "/tag/", "/topic/", "/archive/", "/author/"]
SEARCH_MARKS = ["?search=", "?q=", "&search=", "&q="]

# Fixed value: the reason text of the filtered list.
FILTER_REASON = "Non-article URL (pagination/index/home page)"


def _has_any(text: Column, marks: list[str]) -> Column:
    return reduce(or_, [text.contains(m) for m in marks])


def rejection_rule(link: Column) -> Column:
    """Name of the first rule that marks the link as a listing page; null for an article link."""
    u = F.lower(link)
    term = F.regexp_extract(u, r"\?s=([^&]+)", 1)
    return (
        F.when(u.isNull(), "missing")
        .when(_has_any(u, PAGING_MARKS), "pagination")
        .when(u.rlike(f"/({'|'.join(INDEX_NAMES)})/*$"), "index")
        .when(_has_any(u, SECTION_MARKS), "section")
        .when(_has_any(u, SEARCH_MARKS), "search")
        .when(u.contains("?s=") & ~u.contains("&item=") & (term != "") & ~term.rlike(r"^\d+$"), "search_term")
        .when(u.rlike(r"/\d{4}/?$"), "year_archive")
    )


def is_article(link: Column) -> Column:
    return rejection_rule(link).isNull()


def host(link: Column) -> Column:
    return F.regexp_extract(link, "^https?://([^/]+)", 1)


def query_site(query: Column) -> Column:
    """Site of a search query in either spelling: `+` between the terms, or a blank."""
    return F.regexp_extract(query, "site:([^+ &]+)", 1)


def usable_url(url: Column) -> Column:
    """The url without padding, or null where nothing is left."""
    return F.nullif(trimmed(url), F.lit(""))


def search_url(site: Column, start: Column, end: Column, term: Column | None = None, encode: bool = False) -> Column:
    """Search request for one site and date range. `encode` escapes the site, which is literal otherwise."""
    if encode:
        site = escape(site)
    parts = [F.lit("https://www.google.com/search?q=")]
    if term is not None:
        parts += [escape(term), F.lit("+")]
    parts += [
        F.lit("site:"), site, F.lit("+before:"), end.cast("string"), F.lit("+after:"), start.cast("string"),
        F.lit("&gl=US&hl=en&brd_json=1"),
    ]
    return F.concat(*parts)


def escape(text: Column) -> Column:
    """Percent escapes for a URL, a blank as %20."""
    return F.replace(F.url_encode(text), F.lit("+"), F.lit("%20"))
