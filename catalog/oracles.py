"""DuckDB SQL for the queries of `queries.py`, over the same test tables."""

from __future__ import annotations

import re

from catalog.views import LEXICON, NEGATORS, REFERENCES, RULES, STATED

# --- input views --------------------------------------------------------------------------------

_ART_TS = "TIMESTAMP '2024-01-01 00:00:00' + to_minutes((doc_id * 40) % 2000000000)"
_LINK = """CASE page_id % 12 WHEN 0 THEN concat(b, '?page=2') WHEN 1 THEN concat(b, '/newsroom/') WHEN 2 THEN concat(b, '/category/x')
    WHEN 3 THEN concat(b, '?q=merger') WHEN 4 THEN concat(b, '?s=merger') WHEN 5 THEN concat(b, '?s=2429&item=12')
    WHEN 6 THEN concat(b, '?s=2429') WHEN 7 THEN concat(b, '/2024/') WHEN 8 THEN concat(b, '/2024/01/a')
    WHEN 9 THEN concat(b, '?utm_source=feed') ELSE url END"""

VIEWS: dict[str, str] = {
    "reference_data": """
        SELECT s_suppkey AS id, s_name AS corporation, n_name AS sector, s_suppkey % 3 <> 0 AS f100,
          CASE WHEN s_suppkey % 11 = 0 THEN NULL WHEN s_suppkey % 13 = 0 THEN '   '
               ELSE concat(' https://www.corp', CAST(s_suppkey % 40 AS VARCHAR), '.example.com/newsroom ') END AS newsroom_url
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "usable": """
        SELECT id, corporation, sector, f100, trim(newsroom_url) AS newsroom_url FROM reference_data
        WHERE newsroom_url IS NOT NULL AND trim(newsroom_url) <> ''""",
    "reference_snapshots": """
        SELECT s_suppkey, snap_id, TIMESTAMP '2024-01-01 00:00:00' + to_hours(snap_id * 20) AS loaded_at
        FROM supplier CROSS JOIN (VALUES (0), (1), (2)) s(snap_id) WHERE s_suppkey % 3 <= snap_id""",
    "collected_articles": f"""
        SELECT concat('https://www.corp', CAST(k % 40 AS VARCHAR), '.example.com/news/', CAST(k AS VARCHAR)) AS url,
          doc_id, text AS title, text AS description, doc_id % 10 + 1 AS rank,
          concat('site:https://www.corp', CAST(k % 40 AS VARCHAR), '.example.com/newsroom before:2024-01-31 after:2024-01-01') AS query,
          CASE WHEN n_chars >= 100 THEN text END AS article_text,
          CASE WHEN doc_id % 4 <> 0 THEN ts - INTERVAL '1' DAY END AS publish_date,
          CASE WHEN n_chars < 100 THEN NULL WHEN doc_id % 20 < 15 THEN 'semantic' WHEN doc_id % 20 < 19 THEN 'density' ELSE 'readability' END AS scraper_used,
          ts AS collection_timestamp, concat('run', CAST(doc_id % 25 AS VARCHAR)) AS run_id
        FROM (SELECT *, doc_id - CASE WHEN doc_id % 10 = 9 THEN 1 ELSE 0 END AS k, {_ART_TS} AS ts FROM documents) d""",
    "article_enrichments": """
        SELECT event_id, concat('https://www.corp', CAST((user_id * 3) % 40 AS VARCHAR), '.example.com/news/', CAST(user_id * 3 AS VARCHAR)) AS url,
          CASE WHEN value > 20 THEN 'positive' WHEN value < 5 THEN 'negative' ELSE 'neutral' END AS sentiment, value / 100 AS sentiment_score,
          [event_type, CASE WHEN value > 20 THEN 'big' ELSE 'small' END] AS issue_labels,
          [concat('user', CAST(user_id % 7 AS VARCHAR))] AS entity_labels, props AS custom_metadata,
          ts AS enrichment_timestamp, CASE WHEN event_type = 'purchase' THEN 'v2.0' ELSE 'v1.0' END AS enrichment_version
        FROM events""",
    "run_queries": """
        SELECT CAST(l_orderkey AS VARCHAR) AS run_id, concat('https://www.google.com/search?q=site:https://www.corp', CAST(l_suppkey % 40 AS VARCHAR),
          '.example.com/newsroom+before:', strftime(l_shipdate, '%Y-%m-%d'), '+after:1995-01-01&gl=US&hl=en&brd_json=1') AS query
        FROM lineitem""",
    "collection_runs": """
        SELECT CAST(o_orderkey AS VARCHAR) AS run_id, CAST(o_orderdate AS DATE) AS start_date,
          CAST(o_orderdate AS DATE) + CAST(o_orderkey % 10 AS INT) AS end_date,
          n AS queries_count, urls AS urls_collected, scr AS articles_scraped,
          CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'started' ELSE 'failed' END AS status,
          o_orderdate AS start_timestamp, o_orderdate + to_seconds(o_orderkey % 3600) AS end_timestamp
        FROM orders JOIN (SELECT l_orderkey, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS urls,
            CAST(sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS BIGINT) AS scr
          FROM lineitem GROUP BY l_orderkey) l ON o_orderkey = l_orderkey""",
    "run_events": """
        SELECT CAST(o_orderkey AS VARCHAR) AS run_id, 0 AS seq, 'started' AS status, CAST(0 AS BIGINT) AS urls_collected, o_orderdate AS event_timestamp FROM orders
        UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 1, CASE o_orderstatus WHEN 'F' THEN 'completed' ELSE 'failed' END, CAST(floor(o_totalprice) AS BIGINT),
          o_orderdate + to_seconds(o_orderkey % 3600) FROM orders WHERE o_orderstatus <> 'O'
        UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 0, 'started', 0, o_orderdate + INTERVAL 1 DAY + to_seconds(o_orderkey % 3600) FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 5 = 0
        UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 1, 'completed', 7, o_orderdate + INTERVAL 2 DAY + to_seconds(o_orderkey % 3600) FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 5 = 0""",
    "serp_results": f"""
        SELECT page_id, host, concat('site:', host) AS query, title, CASE WHEN page_id % 5 <> 0 THEN title END AS description,
          {_LINK} AS link, row_number() OVER (PARTITION BY host ORDER BY page_id) AS rank,
          CAST(floor((row_number() OVER (PARTITION BY host ORDER BY page_id) - 1) / 10) AS INT) AS page_no
        FROM (SELECT *, regexp_replace(url, '[?#].*$', '') AS b, regexp_extract(url, '^https?://([^/]+)', 1) AS host,
          regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages) p""",
    "serp_attempts": """
        SELECT host, page_no, attempt, n, (page_no + length(host) + attempt) % 3 = 0 AS cut, CASE WHEN length(host) % 9 = 0 THEN 500 WHEN (page_no + length(host) + attempt) % 4 = 0 THEN 429
          WHEN (page_no + length(host) + attempt) % 7 = 0 THEN 504 ELSE 200 END AS status
        FROM (SELECT host, page_no, count(*) AS n FROM serp_results GROUP BY ALL) r CROSS JOIN (VALUES (0), (1), (2)) a(attempt)""",
    "resolved": """
        SELECT host, page_no, min(attempt) FILTER (WHERE status = 200 AND NOT cut) AS resolved_attempt,
          CASE WHEN length(host) % 13 = 0 THEN 0 ELSE max(n) END AS n FROM serp_attempts GROUP BY host, page_no""",
    "chain": """
        SELECT host AS query, page_no, n AS n_results,
          CASE WHEN n = 10 THEN concat('https://search.example.com/?start=', (page_no + 1) * 10, '&brd_json=1') END AS next_request,
          count(*) OVER (PARTITION BY host ORDER BY page_no) AS seen,
          coalesce(min(n) OVER (PARTITION BY host ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 10) AS least_n
        FROM resolved WHERE resolved_attempt IS NOT NULL AND n > 0""",
    "pages_mixed": """
        SELECT page_id, url, CASE WHEN page_id % 10 = 0 THEN replace(h, '<meta charset="utf-8">', concat('<meta charset="utf-8"><meta name="description" content="',
            about, '"><meta name="keywords" content="news, page"><meta property="article:published_time" content="', published, '">'))
          WHEN page_id % 5 = 0 THEN replace(h, '<meta charset="utf-8">', concat('<meta charset="utf-8"><meta content=', chr(39), about, chr(39),
            ' name=', chr(39), 'description', chr(39), '/><META CONTENT=', chr(39), 'news, page', chr(39), ' NAME=keywords><meta content=', chr(39), published,
            chr(39), ' property=', chr(39), 'article:published_time', chr(39), '>'))
          ELSE h END AS html
        FROM (SELECT page_id, url, repeat('This page&#8217;s own &#x201C;news&rdquo;. ', 8) AS about,
            CASE WHEN page_id % 2 = 0 THEN '2024-02-03T04:05:06' ELSE 'Feb 3, 2024' END AS published,
            CASE WHEN page_id % 3 = 0 THEN replace(replace(html, '<article>', '<div>'), '</article>', '</div>')
              WHEN page_id % 7 = 0 THEN regexp_replace(html, '(?s)<article>.*?</article>', '') ELSE html END AS h FROM pages) p""",
    "scrape_log": """
        SELECT page_id, url, CASE WHEN page_id % 13 = 0 THEN NULL WHEN page_id % 4 = 0 THEN 'density' WHEN page_id % 29 = 1 THEN 'readability' ELSE 'semantic' END AS scraper_used,
          CASE WHEN page_id % 26 = 0 THEN 'Timeout' WHEN page_id % 13 = 0 THEN 'All Scrapers Failed' END AS error_type,
          CAST(length(html) AS DOUBLE) / 1000 AS processing_time_s
        FROM pages""",
    "processed_urls": "SELECT link FROM serp_results WHERE page_id % 3 = 0",
    "lexicon": "SELECT word, CAST(val AS DOUBLE) AS val FROM (VALUES " + ", ".join(f"('{w}', {x})" for w, x in LEXICON) + ") l(word, val)",
    "ruled": r"""
        SELECT page_id, link, CASE
            WHEN u IS NULL THEN 'missing'
            WHEN contains(u, '?page=') OR contains(u, '&page=') OR contains(u, '/page/') THEN 'pagination'
            WHEN regexp_matches(rtrim(u, '/'), '(/press|/newsroom|/news|/press-releases|/media|/press-release)$') THEN 'index'
            WHEN contains(u, '/category/') OR contains(u, '/tag/') OR contains(u, '/topic/') OR contains(u, '/archive/') OR contains(u, '/author/') THEN 'section'
            WHEN contains(u, '?search=') OR contains(u, '?q=') OR contains(u, '&search=') OR contains(u, '&q=') THEN 'search'
            WHEN contains(u, '?s=') AND NOT contains(u, '&item=') AND regexp_extract(u, '\?s=([^&]+)', 1) <> ''
              AND NOT regexp_full_match(regexp_extract(u, '\?s=([^&]+)', 1), '\d+') THEN 'search_term'
            WHEN regexp_matches(u, '/\d{4}/?$') THEN 'year_archive' END AS rule
        FROM (SELECT page_id, link, lower(link) AS u FROM serp_results) r""",
    "content_once": """
        SELECT url, scraper_used, processing_time_s FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id) AS rn
          FROM scrape_log WHERE scraper_used IS NOT NULL) s WHERE rn = 1""",
    "known_newsrooms": "SELECT DISTINCT regexp_extract(query, 'site:([^+ &]+)', 1) AS newsroom_url FROM collected_articles",
    "new_newsrooms": """
        SELECT DISTINCT newsroom_url FROM usable WHERE newsroom_url NOT IN (SELECT newsroom_url FROM known_newsrooms)""",
    "executed_history": """
        SELECT DISTINCT query FROM run_queries JOIN collection_runs USING (run_id)
        WHERE status = 'completed' AND start_date <= DATE '1996-03-13' AND end_date >= DATE '1995-01-01'""",
    "plan": """
        SELECT id, newsroom_url, DATE '1995-01-01' AS start_date, DATE '1996-03-13' AS end_date, q AS query,
          q IN (SELECT query FROM executed_history) AS skip
        FROM (SELECT id, newsroom_url, concat('https://www.google.com/search?q=site:', newsroom_url,
            '+before:1996-03-13+after:1995-01-01&gl=US&hl=en&brd_json=1') AS q FROM usable) u""",
    "latest_e": """
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY enrichment_timestamp DESC, event_id DESC) AS rn
          FROM article_enrichments) e WHERE rn = 1""",
}


# The named references that the pages of the fixture have; those without a semicolon count at the beginning of a longer word too.
_NAMED = {"amp;": "&", "lt;": "<", "gt;": ">", "quot;": '"', "nbsp;": " ", "rdquo;": "”", "copy;": "©", "middot;": "·", "hellip;": "…", "eacute;": "é",
          "euro;": "€", "notin;": "∉"}
_BARE = {"amp": "&", "copy": "©", "not": "¬", "Aacute": "Á", "lt": "<", "gt": ">", "quot": '"'}


def _decoded(text: str) -> str:
    """Character references of a text, each read once."""
    names = ", ".join(f"'{n}'" for n in (*_NAMED, *_BARE))
    chars = ", ".join(f"'{c}'" for c in (*_NAMED.values(), *_BARE.values()))
    bare = "|".join(sorted(_BARE, key=len, reverse=True))
    name = "regexp_extract(p, '^[A-Za-z][A-Za-z0-9]*;', 0)"
    return f"""array_to_string(list_transform(string_split({text}, '&'), lambda p, i: CASE WHEN i = 1 THEN p
        WHEN regexp_matches(p, '^#[xX][0-9a-fA-F]+') THEN chr(CAST('0x' || regexp_extract(p, '^#[xX]([0-9a-fA-F]+)', 1) AS INT)) || regexp_replace(p, '^#[xX][0-9a-fA-F]+;?', '')
        WHEN regexp_matches(p, '^#[0-9]+') THEN replace(chr(CAST(regexp_extract(p, '^#([0-9]+)', 1) AS INT)), chr(150), '–') || regexp_replace(p, '^#[0-9]+;?', '')
        WHEN list_contains([{names}], {name}) THEN list_extract([{chars}], list_position([{names}], {name})) || substr(p, length({name}) + 1)
        WHEN regexp_matches(p, '^({bare})') THEN list_extract([{chars}], list_position([{names}], regexp_extract(p, '^({bare})', 0))) || regexp_replace(p, '^({bare})', '')
        ELSE '&' || p END), '')"""


def _plain(markup: str) -> str:
    text = _decoded(f"regexp_replace({markup}, '<[^>]*>', ' ', 'g')")
    return f"trim(regexp_replace({text}, '\\s+', ' ', 'g'))"


_VISIBLE = r"regexp_replace(html, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', ' ', 'g')"
_SEMANTIC = _plain(r"regexp_extract(body, '(?is)<article\b[^>]*>(.*?)</article\s*>', 1)")
_PARAGRAPHS = _plain(r"array_to_string(regexp_extract_all(body, '(?is)<p\b[^>]*>(.*?)</p\s*>', 1), ' ')")
_BLOCK = r"(?i)</?(?:p|div|article|section|main|header|footer|nav|aside|ul|ol|li|table|tr|td|h[1-6]|br|blockquote)\b[^>]*>"


# What the pages of the fixture state, by construction.
_ABOUT = "CASE WHEN page_id % 5 = 0 THEN trim(repeat('This page’s own “news”. ', 8)) ELSE '' END"
_LINKS = _plain(r"array_to_string(regexp_extract_all(piece, '(?is)<a\b[^>]*>(.*?)</a\s*>', 1), ' ')")
_FRAME = r"(?is)<head\b.*?</head\s*>|<nav\b.*?</nav\s*>|<footer\b.*?</footer\s*>|<aside\b.*?</aside\s*>|<form\b.*?</form\s*>"

VIEWS["blocks"] = f"""
    SELECT page_id, string_agg(t, ' ' ORDER BY i) AS density FROM (
      SELECT page_id, i, {_plain('piece')} AS t, length(piece) - length(replace(piece, '<', '')) AS tags, {_LINKS} AS links
      FROM (SELECT page_id, unnest(pieces) AS piece, unnest(range(len(pieces))) AS i FROM (
        SELECT page_id, regexp_split_to_array(regexp_replace({_VISIBLE}, '{_FRAME}', '<p>', 'g'), '{_BLOCK}') AS pieces FROM pages_mixed) x) y) z
    WHERE 2 * length(links) < length(t) AND length(t) >= 10 * tags GROUP BY page_id"""
VIEWS["candidates"] = f"""
    SELECT p.page_id, url, html, {_SEMANTIC} AS semantic, density, {_PARAGRAPHS} AS readability, {_ABOUT} AS meta
    FROM (SELECT *, {_VISIBLE} AS body FROM pages_mixed) p LEFT JOIN blocks USING (page_id)"""
VIEWS["extracted"] = """
    SELECT page_id, url, html,
      CASE WHEN length(semantic) >= 100 THEN semantic WHEN length(density) >= 100 THEN density
           WHEN length(readability) >= 100 THEN readability WHEN length(meta) >= 100 THEN meta END AS article_text,
      CASE WHEN length(semantic) >= 100 THEN 'semantic' WHEN length(density) >= 100 THEN 'density'
           WHEN length(readability) >= 100 THEN 'readability' WHEN length(meta) >= 100 THEN 'meta' END AS scraper_used
    FROM candidates"""

# Nested elements, by the depth of their tags.
_SAID = " ".join(f"WHEN {k} THEN '{h}' || day || '{t}'" for k, (h, t) in enumerate((a.replace("'", "''"), b.replace("'", "''")) for a, b in STATED))
VIEWS["pages_stated"] = f"""
    SELECT page_id, url, replace(CASE WHEN page_id % 4 = 0 THEN html ELSE regexp_replace(html, '<title>[^<]*</title>', '', 'g') END, '</head>', CASE page_id % 6 {_SAID} ELSE '' END || '</head>') AS html
    FROM (SELECT *, '2024-03-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') AS day FROM pages) p"""
VIEWS["pages_nested"] = f"""
    SELECT page_id, url, CASE page_id % 4
        WHEN 0 THEN replace(h, '<article>', '<article><h2>{REFERENCES}</h2><article class=quote>Inner <article>innermost</article> text</article>')
        WHEN 1 THEN replace(h, '<article>', '<ARTICLE id=a>Begin <article>never closed<p>')
        WHEN 2 THEN replace(replace(h, '<article>', '<aside>Ad <aside>inner ad</aside> rest of the ad<nav>x</nav></aside></form><div>{REFERENCES}'), '</article>', '</div><form><p>Never closed')
        ELSE h END AS html
    FROM (SELECT page_id, url, replace(html, '</title>', ' {REFERENCES}</title>') AS h FROM pages) p"""
VIEWS["nested_bodies"] = f"SELECT page_id, {_VISIBLE} AS body FROM pages_nested"


def _parts(body: str, tag: str) -> str:
    """The parts of a page between tags, with the depth of each."""
    return f"""
    SELECT page_id, i, part, s - least(0, min(s) OVER (PARTITION BY page_id ORDER BY i)) AS depth, step FROM (
      SELECT *, sum(step) OVER (PARTITION BY page_id ORDER BY i) AS s FROM (
        SELECT page_id, unnest(regexp_split_to_array(body, '{tag}')) AS part, unnest(range(len(regexp_extract_all(body, '{tag}')) + 1)) AS i,
          unnest([0] || list_transform(regexp_extract_all(body, '{tag}'), lambda t: CASE WHEN t LIKE '</%' THEN -1 ELSE 1 END)) AS step
        FROM (SELECT page_id, {body} AS body FROM nested_bodies) b) x) y"""


VIEWS["article_parts"] = _parts("body", r"(?i)</?article\b[^>]*>")
VIEWS["first_articles"] = """
    SELECT page_id, string_agg(part, ' ' ORDER BY i) AS inside
    FROM article_parts JOIN (SELECT b.page_id, b.begin, min(z.i) AS stop FROM (SELECT page_id, min(i) AS begin FROM article_parts WHERE step = 1 GROUP BY page_id) b
      LEFT JOIN article_parts z ON z.page_id = b.page_id AND z.depth = 0 AND z.i > b.begin GROUP BY ALL) e USING (page_id)
    WHERE i >= begin AND (stop IS NULL OR i < stop) GROUP BY page_id"""
VIEWS["framed_parts"] = _parts(r"regexp_replace(body, '(?is)<head\b.*?</head\s*>', '<p>', 'g')", r"(?i)</?(?:nav|footer|aside|form)\b[^>]*>")
VIEWS["outside_frames"] = """
    SELECT page_id, string_agg(part, '<p>' ORDER BY i) AS body
    FROM (SELECT *, min(depth) OVER (PARTITION BY page_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS least FROM framed_parts) f
    WHERE depth <= least GROUP BY page_id"""
VIEWS["nested_blocks"] = f"""
    SELECT page_id, string_agg(t, ' ' ORDER BY i) AS density FROM (
      SELECT page_id, i, {_plain('piece')} AS t, length(piece) - length(replace(piece, '<', '')) AS tags, {_LINKS} AS links
      FROM (SELECT page_id, unnest(pieces) AS piece, unnest(range(len(pieces))) AS i FROM (
        SELECT page_id, regexp_split_to_array(body, '{_BLOCK}') AS pieces FROM outside_frames) x) y) z
    WHERE 2 * length(links) < length(t) AND length(t) >= 10 * tags GROUP BY page_id"""
VIEWS["nested_candidates"] = f"""
    SELECT page_id, {_plain("coalesce(inside, '')")} AS semantic, density, {_PARAGRAPHS} AS readability
    FROM nested_bodies LEFT JOIN first_articles USING (page_id) LEFT JOIN nested_blocks USING (page_id)"""

_NEG = "(" + ", ".join(f"'{n}'" for n in NEGATORS) + ")"


def _scores(view: str, key: str, text: str) -> str:
    """Sentiment of each text of a view, by its key."""
    return f"""
    SELECT k, round(s / sqrt(s * s + 15), 6) + 0.0 AS score, CASE WHEN round(s / sqrt(s * s + 15), 6) > 0.1 THEN 'positive'
        WHEN round(s / sqrt(s * s + 15), 6) < -0.1 THEN 'negative' ELSE 'neutral' END AS sentiment
    FROM (SELECT d.k, coalesce(sum(val * CASE WHEN neg THEN -0.74 ELSE 1 END), 0) AS s
      FROM (SELECT DISTINCT {key} AS k FROM {view}) d LEFT JOIN (
        SELECT k, word, coalesce(lag(word, 1) OVER w IN {_NEG}, false) OR coalesce(lag(word, 2) OVER w IN {_NEG}, false)
            OR coalesce(lag(word, 3) OVER w IN {_NEG}, false) AS neg
        FROM (SELECT k, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM (SELECT {key} AS k,
            list_filter(regexp_split_to_array(lower({text}), '[^\\p{{L}}]+'), lambda x: x <> '') AS ws FROM {view}) a) b
        WINDOW w AS (PARTITION BY k ORDER BY i)) t ON d.k = t.k LEFT JOIN lexicon USING (word)
      GROUP BY d.k) z"""


def _words(text: str) -> str:
    return rf"list_filter(regexp_split_to_array(lower({text}), '[^\p{{L}}]+'), lambda x: x <> '')"


def _keywords(view: str, key: str, text: str, k: int, min_length: int) -> str:
    return f"""
    SELECT k, string_agg(word, ', ' ORDER BY rn) AS keywords FROM (
      SELECT k, word, row_number() OVER (PARTITION BY k ORDER BY count(*) DESC, word) AS rn
      FROM (SELECT {key} AS k, unnest({_words(text)}) AS word FROM {view}) t WHERE length(word) >= {min_length} GROUP BY k, word) r
    WHERE rn <= {k} GROUP BY k"""


def _summaries(view: str, key: str, text: str) -> str:
    return rf"""
    WITH s AS (SELECT k, unnest(ss) AS sentence, unnest(range(len(ss))) AS pos
        FROM (SELECT {key} AS k, regexp_extract_all({text}, '[^.!?\n]+[.!?]*') AS ss FROM {view}) d),
      w AS (SELECT k, pos, unnest({_words('sentence')}) AS word FROM s),
      f AS (SELECT k, word, count(*) AS n FROM w GROUP BY k, word),
      sc AS (SELECT k, pos, CAST(sum(n) AS DOUBLE) / count(*) AS score FROM w JOIN f USING (k, word) GROUP BY k, pos),
      r AS (SELECT k, pos, row_number() OVER (PARTITION BY k ORDER BY score DESC, pos) AS rn FROM sc)
    SELECT d.k, coalesce(string_agg(trim(sentence), ' ' ORDER BY s.pos), '') AS summary
    FROM (SELECT {key} AS k FROM {view}) d LEFT JOIN (r JOIN s ON r.k = s.k AND r.pos = s.pos AND rn <= 3) ON d.k = r.k GROUP BY d.k"""


_FACTOR = " + ".join(
    f"CASE lag(word, {n}) OVER w " + " ".join(f"WHEN '{b}' THEN {v}" for b, v in RULES.boosters.items()) + f" ELSE 0 END * {d}" for n, d in enumerate(RULES.decay, 1))
VIEWS["told_texts"] = """
    SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN translate(substr(text, 1, 60), 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') || substr(text, 61) || ' !! now!'
        WHEN 1 THEN text || repeat('?', doc_id % 7) ELSE text END AS text FROM documents"""
VIEWS["word_values"] = rf"""
    SELECT word, CAST((ascii(word) * 31 + ascii(substr(word, 2, 1)) * 17 + length(word) * 7) % 81 - 40 AS DOUBLE) / 10 AS val
    FROM (SELECT DISTINCT unnest({_words('text')}) AS word FROM documents) d WHERE length(word) > 1 AND (length(word) * 7 + ascii(word)) % 5 = 0"""
VIEWS["told_words"] = rf"""
    SELECT doc_id, unnest(ws) AS cased, lower(unnest(ws)) AS word, unnest(range(1, len(ws) + 1)) AS i
    FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '[^\p{{L}}]+'), lambda x: x <> '') AS ws FROM told_texts) t"""
VIEWS["told_values"] = rf"""
    SELECT doc_id, i, val + CASE WHEN shouted AND mixed THEN sign(val) * {RULES.capitals} ELSE 0 END AS strong, boost, neg, CASE WHEN turn IS NULL OR i = turn THEN 1.0
        WHEN i < turn THEN {RULES.before_contrast} ELSE {RULES.after_contrast} END AS side
    FROM (SELECT doc_id, word, i, regexp_matches(cased, '^\p{{Lu}}{{2,}}$') AS shouted, min(i) FILTER (WHERE word = '{RULES.contrast}') OVER (PARTITION BY doc_id) AS turn,
        bool_or(regexp_matches(cased, '^\p{{Lu}}{{2,}}$')) OVER (PARTITION BY doc_id) AND bool_or(NOT regexp_matches(cased, '^\p{{Lu}}{{2,}}$')) OVER (PARTITION BY doc_id) AS mixed,
        {_FACTOR} AS boost, coalesce(lag(word, 1) OVER w IN {_NEG}, false) OR coalesce(lag(word, 2) OVER w IN {_NEG}, false) OR coalesce(lag(word, 3) OVER w IN {_NEG}, false) AS neg
      FROM told_words WINDOW w AS (PARTITION BY doc_id ORDER BY i)) t JOIN word_values USING (word)"""
VIEWS["told_sums"] = f"""
    SELECT doc_id, coalesce(s, 0) + sign(coalesce(s, 0)) * (least(bangs, {RULES.most_exclamations}) * {RULES.exclamation}
        + CASE WHEN asks > 3 THEN {RULES.many_questions} WHEN asks > 1 THEN asks * {RULES.question} ELSE 0 END) AS s
    FROM (SELECT doc_id, length(text) - length(replace(text, '!', '')) AS bangs, length(text) - length(replace(text, '?', '')) AS asks FROM told_texts) d
    LEFT JOIN (SELECT doc_id, sum((strong + sign(strong) * boost) * CASE WHEN neg THEN -0.74 ELSE 1 END * side) AS s FROM told_values GROUP BY doc_id) v USING (doc_id)"""
VIEWS["told_pages"] = "SELECT page_id, article_text FROM extracted WHERE scraper_used = 'semantic'"
VIEWS["page_keywords"] = _keywords("told_pages", "page_id", "article_text", 10, 1)
VIEWS["page_summaries"] = _summaries("told_pages", "page_id", "article_text")
VIEWS["titled"] = "SELECT page_id, link, title FROM serp_results"
VIEWS["title_scores"] = _scores("titled", "page_id", "title")
VIEWS["doc_scores"] = _scores("documents", "doc_id", "text")
VIEWS["earliest"] = """
    SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY collection_timestamp, doc_id) AS rn
      FROM collected_articles) a WHERE rn = 1"""
VIEWS["unversioned"] = """
    SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY collection_timestamp, doc_id) AS rn
      FROM collected_articles WHERE article_text IS NOT NULL
        AND url NOT IN (SELECT url FROM article_enrichments WHERE enrichment_version = 'v2.0')) a WHERE rn = 1"""
VIEWS["unversioned_scores"] = _scores("unversioned", "url", "description")
VIEWS["fresh_links"] = """
    SELECT s.page_id, s.host, s.link, s.title, s.description, rule FROM serp_results s JOIN ruled USING (page_id)
    WHERE s.link NOT IN (SELECT link FROM processed_urls)"""
VIEWS["wanted_links"] = "SELECT * FROM fresh_links WHERE rule IS NULL"
VIEWS["wanted_scores"] = _scores("wanted_links", "page_id", "description")
VIEWS["page_texts"] = """
    SELECT url, page_id, article_text, scraper_used FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id) AS rn FROM extracted
      WHERE scraper_used IS NOT NULL) x WHERE rn = 1"""


def _needs(sql: str) -> list[str]:
    """Views that a statement names, each after the ones it needs itself."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in order and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                visit(VIEWS[name])
                order.append(name)

    visit(sql)
    return order


def _with_views(sql: str) -> str:
    views = [f"{name} AS ({VIEWS[name]})" for name in _needs(sql)]
    return (f"WITH {', '.join(views)}\n" if views else "") + sql.strip()


# --- queries ------------------------------------------------------------------------------------

_EL = "array_to_string(issue_labels, '|') AS issue_labels, array_to_string(entity_labels, '|') AS entity_labels"
_SCORE = "round(sentiment_score, 6) AS sentiment_score"
_RUN = "run_id, start_date, end_date, queries_count, urls_collected, articles_scraped, status, start_timestamp"
_SEARCH = "concat('https://www.google.com/search?q=site:', {site}, '+before:1996-03-13+after:1995-01-01&gl=US&hl=en&brd_json=1')"
_AS_OF = "(SELECT max(collection_timestamp) FROM collected_articles)"
SQL: dict[str, str] = {
    # sources and sinks
    "reference_scan": "SELECT corporation, sector, newsroom_url FROM reference_data WHERE f100 AND newsroom_url IS NOT NULL",
    "csv_texts": "SELECT doc_id, concat(chr(34), text, chr(34), ',', chr(10), chr(92)) AS text FROM documents",
    "csv_roundtrip": "SELECT id, corporation, sector, newsroom_url FROM reference_data",
    "reference_snapshot": """
        SELECT * FROM reference_snapshots WHERE snap_id = (SELECT max(snap_id) FROM reference_snapshots
          WHERE loaded_at <= TIMESTAMP '2024-01-01 21:00:00' AND loaded_at > TIMESTAMP '2024-01-01 21:00:00' - INTERVAL 24 HOUR)""",
    "reference_snapshot_stale": "SELECT * FROM reference_snapshots WHERE snap_id = (SELECT max(snap_id) FROM reference_snapshots)",
    "serp_parse": "SELECT page_no, query, title, description, link, CASE WHEN length(host) % 2 = 0 AND rank = 7 THEN NULL ELSE rank END AS rank FROM serp_results",
    "fetch_resolution": "SELECT host, page_no, resolved_attempt FROM resolved",
    "serp_page_chain": "SELECT query, page_no, n_results, next_request FROM chain WHERE page_no < 2 AND seen = page_no + 1 AND least_n = 10",
    "serp_page_chain_all": "SELECT query, page_no, n_results, next_request FROM chain WHERE seen = page_no + 1 AND least_n = 10",
    "failed_queries": "SELECT host AS query FROM resolved GROUP BY host HAVING count(*) FILTER (WHERE page_no = 0 AND resolved_attempt IS NOT NULL AND n > 0) = 0",
    "union_pages": "SELECT page_id, CASE WHEN page_no > 0 THEN page_no END AS page_no, query, title, link, rank FROM serp_results",
    "processed_scan": "SELECT DISTINCT link AS url FROM processed_urls",
    "processed_count": "SELECT count(DISTINCT link) AS processed FROM processed_urls",
    "processed_union": "SELECT DISTINCT link FROM serp_results WHERE page_id % 3 = 0 OR page_id % 2 = 0",
    "stage_roundtrip": "SELECT run_id, seq, status, urls_collected, event_timestamp FROM run_events",
    "latest_run_stages": "SELECT run_id, status AS stage FROM run_events WHERE run_id = (SELECT max(run_id) FROM run_events)",
    "store_layout": """
        SELECT CAST(collection_timestamp AS DATE) AS day, count(*) AS n, count(DISTINCT url) AS urls FROM collected_articles GROUP BY 1""",
    "write_articles": """
        SELECT url, title, description, article_text, rank, query, CAST(NULL AS VARCHAR) AS summary, CAST(NULL AS VARCHAR) AS keywords,
          CASE WHEN doc_id % 3 = 0 THEN CAST(CAST(publish_date AS DATE) AS TIMESTAMP) ELSE publish_date END AS publish_date,
          scraper_used, TIMESTAMP '2024-03-01 00:00:00' AS collection_timestamp, '20240301_000000' AS run_id FROM collected_articles""",
    "write_enrichments": f"""
        SELECT url, sentiment, {_SCORE}, CASE WHEN event_id % 5 = 0 THEN '' ELSE array_to_string(issue_labels, '|') END AS issue_labels,
          array_to_string(entity_labels, '|') AS entity_labels, enrichment_timestamp, 'v3.0' AS enrichment_version, '20240301_000000' AS run_id
        FROM article_enrichments""",
    "run_state": """
        SELECT run_id, status, urls_collected FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY event_timestamp DESC, seq DESC, status DESC) AS rn
          FROM run_events) e WHERE rn = 1""",
    "run_log": """
        SELECT run_id, start_date, end_date, CASE WHEN again THEN 'completed' ELSE status END AS status, start_timestamp,
          CASE WHEN status <> 'started' THEN queries_count END AS queries_count,
          CASE WHEN again THEN 7 WHEN status <> 'started' THEN urls_collected END AS urls_collected, CASE WHEN status <> 'started' THEN articles_scraped END AS articles_scraped,
          CASE WHEN again THEN end_timestamp + INTERVAL 1 DAY WHEN status <> 'started' THEN end_timestamp END AS end_timestamp,
          CASE WHEN status = 'failed' AND NOT again THEN 'out of quota' END AS error_message
        FROM (SELECT *, status = 'failed' AND CAST(run_id AS BIGINT) % 5 = 0 AS again FROM collection_runs) c""",
    "run_ids": "SELECT run_id, strftime(end_timestamp, '%Y%m%d_%H%M%S') AS new_id FROM collection_runs",
    "dedup_rewrite": "SELECT url, doc_id, title, run_id, collection_timestamp FROM earliest",
    # projections and filters
    "conform_schema": "SELECT CAST(NULL AS BIGINT) AS id, corporation, sector, newsroom_url FROM reference_data",
    "query_generation": f"SELECT id, newsroom_url, {_SEARCH.format(site='newsroom_url')} AS query FROM usable",
    "query_generation_distinct": f"""
        SELECT DISTINCT newsroom_url, {_SEARCH.format(site="replace(replace(newsroom_url, ':', '%3A'), '/', '%2F')")} AS query FROM usable""",
    "term_domain_queries": """
        SELECT term, domain, concat('https://www.google.com/search?q=', replace(replace(replace(term, '&', '%26'), '"', '%22'), ' ', '%20'), '+site:', domain,
          '+before:2024-01-31+after:2024-01-01&gl=US&hl=en&brd_json=1') AS query
        FROM (SELECT DISTINCT concat(c_mktsegment, ' & "Co"') AS term FROM customer) t
        CROSS JOIN (VALUES ('wire.example.com'), ('daily.example.org')) d(domain)""",
    "url_rules": "SELECT page_id, link, coalesce(rule, 'accepted') AS rule FROM ruled",
    "url_split": "SELECT link, 'Non-article URL (pagination/index/home page)' AS reason, rule FROM ruled WHERE rule IS NOT NULL",
    "content_filter": r"SELECT doc_id, lang FROM documents WHERE length(trim(text, E' \t\n\r\x0b\x0c')) >= 100",
    "urls_in_range": """
        SELECT DISTINCT url FROM collected_articles
        WHERE CAST(collection_timestamp AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-15'""",
    "urls_lookback": f"SELECT DISTINCT url FROM collected_articles WHERE collection_timestamp >= {_AS_OF} - INTERVAL 12 DAY",
    "urls_all": "SELECT DISTINCT url FROM collected_articles",
    "failed_runs": f"SELECT {_RUN} FROM collection_runs WHERE status = 'failed'",
    "backfill_runs": f"SELECT {_RUN} FROM collection_runs WHERE status = 'completed' AND start_date = DATE '1996-01-02'",
    "title_search": """
        SELECT url, title, collection_timestamp FROM collected_articles
        WHERE collection_timestamp >= TIMESTAMP '2024-01-05 00:00:00' AND title LIKE '%the%'""",
    "by_issue": "SELECT event_id, url, array_to_string(issue_labels, '|') AS issue_labels, sentiment FROM article_enrichments WHERE list_contains(issue_labels, 'big')",
    "by_entity": "SELECT event_id, url, array_to_string(entity_labels, '|') AS entity_labels, sentiment FROM article_enrichments WHERE list_contains(entity_labels, 'user3')",
    "metadata_field": "SELECT url, json_extract_string(custom_metadata, '$.k') AS k FROM article_enrichments WHERE custom_metadata IS NOT NULL",
    "collected_on_day": f"SELECT count(*) AS articles FROM collected_articles WHERE CAST(collection_timestamp AS DATE) = CAST({_AS_OF} AS DATE)",
    "coerce_dates": """
        SELECT doc_id, CASE WHEN doc_id % 8 = 0 THEN NULL WHEN doc_id % 8 IN (1, 2, 3, 6) THEN date_trunc('day', publish_date)
          ELSE date_trunc('second', publish_date) END AS publish_date FROM collected_articles""",
    "normalize_labels": """
        SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 0 ELSE 2 END AS n_issues,
          CASE WHEN event_id % 4 = 0 THEN '' ELSE array_to_string(issue_labels, '|') END AS issues,
          CASE WHEN event_id % 6 = 0 THEN 0 ELSE 1 END AS n_versions, CASE WHEN event_id % 6 = 0 THEN '' ELSE enrichment_version END AS versions
        FROM article_enrichments""",
    # joins and set operations
    "join_content": "SELECT page_id, link, title, scraper_used, processing_time_s FROM serp_results LEFT JOIN content_once ON link = url",
    "new_links": "SELECT page_id, link FROM serp_results WHERE link NOT IN (SELECT link FROM processed_urls)",
    "executed_queries": """
        SELECT DISTINCT query FROM run_queries JOIN collection_runs USING (run_id)
        WHERE status = 'completed' AND start_date <= DATE '1996-01-31' AND end_date >= DATE '1996-01-01'""",
    "executed_by_range": """
        SELECT range_start, range_end, count(DISTINCT c.run_id) AS n_runs, count(DISTINCT query) AS n_queries
        FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS range_start, last_day(o_orderdate) AS range_end FROM orders) m
        JOIN collection_runs c ON c.status = 'completed' AND start_date <= range_end AND end_date >= range_start
        JOIN run_queries USING (run_id) GROUP BY 1, 2""",
    "backfill_urls": "SELECT newsroom_url, DATE '2026-01-01' AS start_date FROM new_newsrooms",
    "queries_to_execute": f"""
        SELECT id, {_SEARCH.format(site='newsroom_url')} AS query FROM usable
        WHERE {_SEARCH.format(site='newsroom_url')} NOT IN (SELECT query FROM executed_history)""",
    "need_enrichment": """
        SELECT DISTINCT c.url FROM collected_articles c LEFT JOIN article_enrichments e ON c.url = e.url
        WHERE e.url IS NULL AND article_text IS NOT NULL""",
    "need_enrichment_version": """
        SELECT DISTINCT c.url FROM collected_articles c LEFT JOIN article_enrichments e ON c.url = e.url AND enrichment_version = 'v2.0'
        WHERE e.url IS NULL AND article_text IS NOT NULL""",
    "articles_latest": f"""
        SELECT c.url, title, publish_date, collection_timestamp, sentiment, {_SCORE}, {_EL}
        FROM collected_articles c LEFT JOIN latest_e e ON c.url = e.url WHERE collection_timestamp >= {_AS_OF} - INTERVAL 30 DAY""",
    "enrichment_rows": "SELECT link AS url, sentiment FROM serp_results JOIN title_scores ON page_id = k",
    # aggregations
    "daily_collection": f"""
        SELECT CAST(collection_timestamp AS DATE) AS date, count(*) AS articles_collected, count(DISTINCT scraper_used) AS scrapers_used,
          count(*) FILTER (WHERE article_text IS NOT NULL) AS successful_scrapes
        FROM collected_articles WHERE collection_timestamp >= {_AS_OF} - INTERVAL 30 DAY GROUP BY 1""",
    "coverage": f"""
        SELECT count(DISTINCT c.url) AS total_articles, count(DISTINCT e.url) AS enriched_articles,
          round(CAST(count(DISTINCT e.url) AS DOUBLE) / count(DISTINCT c.url) * 100, 2) AS coverage_pct
        FROM collected_articles c LEFT JOIN article_enrichments e ON c.url = e.url WHERE collection_timestamp >= {_AS_OF} - INTERVAL 20 DAY""",
    "daily_runs": """
        SELECT CAST(start_timestamp AS DATE) AS date, count(*) AS runs, CAST(sum(queries_count) AS BIGINT) AS total_queries,
          CAST(sum(urls_collected) AS BIGINT) AS total_urls, CAST(sum(articles_scraped) AS BIGINT) AS total_articles,
          count(*) FILTER (WHERE status = 'completed') AS successful_runs, count(*) FILTER (WHERE status = 'failed') AS failed_runs
        FROM collection_runs WHERE start_timestamp >= (SELECT max(start_timestamp) FROM collection_runs) - INTERVAL 60 DAY GROUP BY 1""",
    "scraper_share": """
        SELECT scraper_used, count(*) AS articles_count,
          round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM collected_articles) * 100, 2) AS percentage
        FROM collected_articles WHERE scraper_used IS NOT NULL GROUP BY 1""",
    "duplicate_urls": "SELECT url, count(*) AS duplicate_count FROM collected_articles GROUP BY url HAVING count(*) > 1",
    "company_coverage": """
        SELECT CAST(min(publish_date) AS DATE) AS earliest_article, CAST(max(publish_date) AS DATE) AS latest_article, count(*) AS total_articles
        FROM collected_articles WHERE query LIKE '%corp7.example%' AND article_text IS NOT NULL""",
    "coverage_by_site": """
        SELECT regexp_extract(query, 'site:([^+ &]+)', 1) AS site, CAST(min(publish_date) AS DATE) AS earliest_article,
          CAST(max(publish_date) AS DATE) AS latest_article, count(*) AS total_articles
        FROM collected_articles WHERE article_text IS NOT NULL GROUP BY 1""",
    "range_runs": "SELECT start_date, end_date, count(*) AS runs FROM collection_runs WHERE status = 'completed' GROUP BY 1, 2",
    "sentiment_dist": "SELECT sentiment, count(*) AS n FROM article_enrichments GROUP BY 1",
    "scraper_report": """
        SELECT scraper_used, count(*) AS n, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () * 100, 1) AS pct
        FROM scrape_log WHERE scraper_used IS NOT NULL GROUP BY 1""",
    "error_report": """
        SELECT error_type, count(*) AS n, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () * 100, 1) AS pct
        FROM scrape_log WHERE error_type IS NOT NULL GROUP BY 1""",
    "scrape_summary": """
        SELECT a + f AS total_urls, f AS filtered, round(CAST(f AS DOUBLE) / (a + f) * 100, 1) AS filtered_pct, a AS attempted, ok AS successful,
          round(CAST(ok AS DOUBLE) / a * 100, 1) AS success_rate, round(CAST(ok AS DOUBLE) / (a + f) * 100, 1) AS success_rate_total,
          a - ok AS failed, round(CAST(a - ok AS DOUBLE) / a * 100, 1) AS failed_rate, round(m, 4) AS mean_time_s, round(a / t, 4) AS articles_per_s
        FROM (SELECT count(*) AS a, count(scraper_used) AS ok, avg(processing_time_s) FILTER (WHERE scraper_used IS NOT NULL) AS m,
            sum(processing_time_s) AS t, (SELECT count(*) FROM ruled WHERE rule IS NOT NULL) AS f FROM scrape_log) s""",
    "errors_by_host": """
        SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS host, count(*) AS errors FROM scrape_log WHERE error_type IS NOT NULL GROUP BY 1""",
    "company_cost": """
        SELECT company, total_queries, coalesce(n, 0) AS total_results, round(CAST(coalesce(n, 0) AS DOUBLE) / total_queries, 4) AS avg_results
        FROM (SELECT regexp_extract(query, 'site:([^+ &]+)', 1) AS company, count(DISTINCT query) AS total_queries FROM run_queries GROUP BY 1) q
        LEFT JOIN (SELECT regexp_extract(query, 'site:([^+ &]+)', 1) AS company, count(*) AS n FROM collected_articles GROUP BY 1) r USING (company)""",
    "table_rows": """
        SELECT 'collected_articles' AS table_name, count(*) AS row_count FROM collected_articles
        UNION ALL SELECT 'article_enrichments', count(*) FROM article_enrichments UNION ALL SELECT 'collection_runs', count(*) FROM collection_runs""",
    "table_bytes": "SELECT count(*) AS n_rows, true AS has_bytes, true AS has_files FROM events",
    "run_stats": """
        SELECT (SELECT count(*) FROM reference_data) AS companies_count, (SELECT count(*) FROM plan) AS queries_generated,
          (SELECT count(*) FROM plan WHERE skip) AS queries_skipped, (SELECT count(*) FROM plan WHERE NOT skip) AS queries_executed,
          (SELECT count(*) FROM new_newsrooms) AS backfill_urls_count, (SELECT count(*) FROM fresh_links) AS serp_results_count,
          (SELECT count(*) FROM wanted_links JOIN page_texts ON link = url) AS articles_scraped,
          (SELECT count(*) FROM wanted_links) AS enriched""",
    # windows, sorts, limits
    "latest_enrichment": f"SELECT url, sentiment, {_SCORE}, {_EL}, enrichment_timestamp, enrichment_version FROM latest_e",
    "dedup_in_place": """
        SELECT url, title, run_id, collection_timestamp
        FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY collection_timestamp, title NULLS FIRST, doc_id) AS rn FROM collected_articles) a WHERE rn = 1""",
    "url_sketches": """
        SELECT CAST(date_trunc('month', collection_timestamp) AS DATE) AS month, count(*) AS articles, count(DISTINCT url) AS urls, true AS close
        FROM collected_articles GROUP BY 1""",
    "earliest_article": "SELECT url, doc_id, title, collection_timestamp FROM earliest",
    "drop_duplicates": """
        SELECT count(*) AS kept, CAST(sum(d) AS BIGINT) AS sum_doc_id, CAST(sum(n) AS BIGINT) - count(*) AS removed
        FROM (SELECT url, min(doc_id) AS d, count(*) AS n FROM collected_articles GROUP BY url) a""",
    "recent_articles": f"""
        SELECT url, title, publish_date, scraper_used, collection_timestamp FROM collected_articles
        WHERE collection_timestamp >= {_AS_OF} - INTERVAL 7 DAY ORDER BY collection_timestamp DESC, url LIMIT 100""",
    "recent_runs": """
        SELECT run_id, start_date, end_date, status, urls_collected, articles_scraped,
          round(CAST(articles_scraped AS DOUBLE) / nullif(urls_collected, 0) * 100, 2) AS scrape_success_rate,
          date_diff('second', start_timestamp, end_timestamp) AS duration_seconds
        FROM collection_runs ORDER BY start_timestamp DESC, run_id LIMIT 10""",
    "recent_runs_days": """
        SELECT run_id, start_date, end_date, status, urls_collected, articles_scraped,
          round(CAST(articles_scraped AS DOUBLE) / nullif(urls_collected, 0) * 100, 2) AS scrape_success_rate,
          date_diff('second', start_timestamp, end_timestamp) AS duration_seconds
        FROM collection_runs WHERE start_timestamp >= (SELECT max(start_timestamp) FROM collection_runs) - INTERVAL 60 DAY""",
    "urls_per_query": """
        SELECT run_id, start_date, end_date, queries_count AS executed, urls_collected, round(CAST(urls_collected AS DOUBLE) / queries_count, 2) AS urls_per_query
        FROM collection_runs WHERE status = 'completed' AND queries_count > 0 ORDER BY start_timestamp DESC, run_id LIMIT 10""",
    "query_efficiency": """
        SELECT run_id, queries_count AS executed, urls_collected, round(CAST(urls_collected AS DOUBLE) / queries_count, 2) AS urls_per_query,
          CASE WHEN urls_collected / queries_count > 3 THEN 'efficient' WHEN urls_collected / queries_count > 1 THEN 'normal' ELSE 'wasteful' END AS efficiency
        FROM collection_runs WHERE status = 'completed' AND queries_count > 0""",
    "dedup_effect": """
        SELECT run_id, urls_collected AS total_found, articles_scraped AS after_dedup, urls_collected - articles_scraped AS duplicates_skipped
        FROM collection_runs WHERE status = 'completed' ORDER BY start_timestamp DESC, run_id LIMIT 10""",
    "company_queries": """
        SELECT DISTINCT query FROM run_queries JOIN collection_runs USING (run_id)
        WHERE status = 'completed' AND query LIKE '%site:https://www.corp7.example.com%'""",
    # planning
    "date_windows": """
        SELECT mode, CAST(start_date AS DATE) AS start_date, today AS end_date FROM (
          SELECT CAST(max(start_timestamp) AS DATE) AS today FROM collection_runs) t
        JOIN LATERAL (SELECT 'default' AS mode, today - 10 AS start_date UNION ALL SELECT 'last_days', today - 30
          UNION ALL SELECT 'since_last', (SELECT end_date FROM collection_runs WHERE status = 'completed' ORDER BY start_timestamp DESC, run_id DESC LIMIT 1)) m ON true""",
    "effective_ranges": """
        SELECT id, newsroom_url, CASE WHEN newsroom_url IN (SELECT newsroom_url FROM new_newsrooms) THEN DATE '1994-01-01' ELSE DATE '1995-01-01' END AS start_date,
          DATE '1996-03-13' AS end_date FROM usable""",
    "effective_ranges_all": """
        SELECT id, newsroom_url, CASE WHEN (SELECT count(*) FROM new_newsrooms) > 0 THEN DATE '1994-01-01' ELSE DATE '1995-01-01' END AS start_date,
          DATE '1996-03-13' AS end_date FROM usable""",
    "collection_plan": "SELECT id, newsroom_url, start_date, end_date, query, skip FROM plan",
    "collection_report": """
        SELECT host, count(*) AS found, count(rule) AS filtered, count(*) FILTER (WHERE rule IS NULL) AS attempted, count(scraper_used) AS scraped,
          count(*) FILTER (WHERE sentiment = 'positive') AS positive, count(*) FILTER (WHERE sentiment = 'neutral') AS neutral,
          count(*) FILTER (WHERE sentiment = 'negative') AS negative,
          round(CAST(count(scraper_used) AS DOUBLE) / nullif(count(*) FILTER (WHERE rule IS NULL), 0) * 100, 1) AS scraped_pct
        FROM fresh_links LEFT JOIN wanted_scores ON page_id = k LEFT JOIN page_texts ON link = url AND rule IS NULL
        GROUP BY host""",
    "recorded_articles": f"""
        SELECT l.link AS url, title, t.scraper_used,
          CASE t.scraper_used WHEN 'semantic' THEN coalesce(summary, '') WHEN 'meta' THEN {_ABOUT.replace('page_id', 't.page_id')} ELSE t.other END AS summary,
          CASE t.scraper_used WHEN 'semantic' THEN coalesce(keywords, '') WHEN 'meta' THEN 'news, page' ELSE t.other END AS keywords,
          CASE WHEN t.page_id % 10 = 0 THEN TIMESTAMP '2024-02-03 04:05:06' WHEN t.page_id % 5 = 0 THEN TIMESTAMP '2024-02-03 00:00:00' END AS publish_date,
          t.article_text, '20240301_000000' AS run_id
        FROM wanted_links l LEFT JOIN (SELECT *, '' AS other FROM page_texts) t ON l.link = t.url LEFT JOIN page_summaries s ON s.k = t.page_id
          LEFT JOIN page_keywords w ON w.k = t.page_id""",
    "recorded_errors": """
        SELECT DISTINCT link AS url, 'All Scrapers Failed' AS error_type, 'All scrapers failed' AS error_message, TIMESTAMP '2024-03-01 00:00:00' AS timestamp,
          '20240301_000000' AS run_id FROM wanted_links WHERE link NOT IN (SELECT url FROM page_texts)""",
    "recorded_filtered": """
        SELECT link AS url, rule, 'Non-article URL (pagination/index/home page)' AS reason, TIMESTAMP '2024-03-01 00:00:00' AS timestamp,
          '20240301_000000' AS run_id FROM fresh_links WHERE rule IS NOT NULL""",
    "recorded_companies": """
        SELECT DISTINCT '20240301_000000' AS run_id, corporation AS company, TIMESTAMP '2024-03-01 00:00:00' AS event_timestamp FROM reference_data""",
    "recorded_run": """
        SELECT '20240301_000000' AS run_id, 'completed' AS status, DATE '2024-02-20' AS start_date, DATE '2024-03-01' AS end_date,
          (SELECT count(DISTINCT host) FROM serp_results) AS queries_count, (SELECT count(*) FROM wanted_links) AS urls_collected,
          (SELECT count(*) FROM wanted_links JOIN page_texts ON link = url) AS articles_scraped, (SELECT count(*) FROM wanted_links) AS enrichments""",
    "recorded_queries": "SELECT DISTINCT query FROM serp_results",
    # text
    "extract_semantic": f"SELECT page_id, {_SEMANTIC} AS article_text FROM (SELECT page_id, {_VISIBLE} AS body FROM pages) p",
    "extract_chain": "SELECT page_id, article_text, scraper_used FROM extracted",
    "extract_errors": """
        SELECT url, 'All Scrapers Failed' AS error_type, 'All scrapers failed' AS error_message, TIMESTAMP '2024-03-01 00:00:00' AS timestamp
        FROM extracted WHERE scraper_used IS NULL""",
    "page_metadata": f"""
        SELECT page_id, nullif({_plain(chr(39).join(["regexp_extract(body, ", r"(?is)<title\b[^>]*>(.*?)</title\s*>", ", 1)"]))}, '') AS title,
          nullif({_ABOUT}, '') AS description, CASE WHEN page_id % 5 = 0 THEN 'news, page' END AS tags,
          CASE WHEN page_id % 10 = 0 THEN TIMESTAMP '2024-02-03 04:05:06' WHEN page_id % 5 = 0 THEN TIMESTAMP '2024-02-03 00:00:00' END AS publish_date
        FROM (SELECT page_id, html, {_VISIBLE} AS body FROM pages_mixed) p""",
    "extract_nested": """
        SELECT page_id, CASE WHEN length(semantic) >= 100 THEN semantic WHEN length(density) >= 100 THEN density WHEN length(readability) >= 100 THEN readability END AS article_text,
          CASE WHEN length(semantic) >= 100 THEN 'semantic' WHEN length(density) >= 100 THEN 'density' WHEN length(readability) >= 100 THEN 'readability' END AS scraper_used
        FROM nested_candidates""",
    # What the pages state, by construction.
    "structured_metadata": f"""
        SELECT page_id, CASE WHEN page_id % 4 = 0 THEN nullif({_plain(chr(39).join(["regexp_extract(html, ", r"(?is)<title\b[^>]*>(.*?)</title\s*>", ", 1)"]))}, '')
            ELSE CASE page_id % 6 WHEN 0 THEN 'Said &amp; done' WHEN 2 THEN '7' WHEN 3 THEN 'Item é head' END END AS title,
          CASE page_id % 6 WHEN 1 THEN 'One.' END AS description, CASE page_id % 6 WHEN 0 THEN 'a, b c' WHEN 1 THEN 'd, e' WHEN 3 THEN 'f, g' END AS tags,
          CASE WHEN page_id % 6 < 4 THEN CAST(make_date(2024, 3, CAST(page_id % 28 + 1 AS INT)) AS TIMESTAMP) END AS publish_date
        FROM pages_stated""",
    "sentiment_rules": """
        SELECT doc_id, round(s / sqrt(s * s + 15), 6) + 0.0 AS score, CASE WHEN round(s / sqrt(s * s + 15), 6) > 0.1 THEN 'positive'
          WHEN round(s / sqrt(s * s + 15), 6) < -0.1 THEN 'negative' ELSE 'neutral' END AS sentiment FROM told_sums""",
    "custom_extractor": r"""
        SELECT page_id, coalesce(scraper_used, CASE WHEN length(trim(f, E' \t\n\r\x0b\x0c')) >= 100 THEN 'footer' END) AS scraper_used,
          coalesce(article_text, CASE WHEN length(trim(f, E' \t\n\r\x0b\x0c')) >= 100 THEN f END) AS article_text
        FROM (SELECT *, regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1) AS f FROM extracted) e""",
    "keywords_topk": f"SELECT k AS doc_id, keywords FROM ({_keywords('documents', 'doc_id', 'text', 5, 3)}) z",
    "summary_central": rf"""
        WITH s AS (SELECT doc_id, unnest(ss) AS sentence, unnest(range(len(ss))) AS pos FROM (SELECT doc_id, regexp_extract_all(text, '[^.!?\n]+[.!?]*') AS ss FROM documents) d),
          w AS (SELECT DISTINCT doc_id, pos, unnest({_words('sentence')}) AS word FROM s),
          links AS (SELECT a.doc_id, a.pos, count(b.pos) AS n FROM w a LEFT JOIN w b ON a.doc_id = b.doc_id AND a.word = b.word AND a.pos <> b.pos GROUP BY ALL),
          size AS (SELECT doc_id, pos, count(*) AS n_words FROM w GROUP BY ALL),
          r AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY doc_id ORDER BY n / sqrt(n_words) DESC, pos) AS rn FROM links JOIN size USING (doc_id, pos))
        SELECT d.doc_id, coalesce(string_agg(trim(sentence), ' ' ORDER BY s.pos), '') AS summary
        FROM documents d LEFT JOIN (r JOIN s ON r.doc_id = s.doc_id AND r.pos = s.pos AND rn <= 3) ON d.doc_id = r.doc_id GROUP BY d.doc_id""",
    "summary_topk": f"SELECT k AS doc_id, summary FROM ({_summaries('documents', 'doc_id', 'text')}) z",
    "sentiment": "SELECT k AS doc_id, score, sentiment FROM doc_scores",
    "refresh_enrichment": """
        SELECT k AS url, sentiment, score AS sentiment_score, 'v2.0' AS enrichment_version, '20240301_000000' AS run_id FROM unversioned_scores""",
    # streams
    "stream_ingest": "SELECT event_id, url, sentiment, enrichment_timestamp, enrichment_version FROM article_enrichments",
    "stream_dedup": "SELECT DISTINCT url FROM article_enrichments",
    "stream_dedup_bounded": "SELECT DISTINCT url FROM article_enrichments",
    "stream_append": """
        SELECT event_id, url, sentiment, enrichment_timestamp FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY enrichment_timestamp, event_id) AS rn
          FROM article_enrichments) e WHERE rn = 1""",
}

SQL.update({f"stored_{name}": SQL[name] for name in (
    "urls_in_range", "urls_lookback", "title_search", "collected_on_day", "daily_collection", "coverage", "articles_latest", "recent_articles")})

ORACLES = {name: _with_views(sql) for name, sql in SQL.items()}
