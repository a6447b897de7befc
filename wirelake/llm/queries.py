"""The operators applied to whole tables, under the names ``opN_...``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wirelake.llm import pieces
from wirelake.llm.collocations import collocations
from wirelake.llm.content_sort import exact_copies
from wirelake.llm.decontamination import judge_contamination
from wirelake.llm.filter_audit import audit
from wirelake.llm.language import identify
from wirelake.llm.main_text import extract_main_text
from wirelake.llm.near_duplicates import near_duplicates
from wirelake.llm.repetition import repetition_signals
from wirelake.llm.substring_dedup import remove_repeats
from wirelake.llm.token_counts import count_tokens
from wirelake.llm.url_filter import judge_urls
from wirelake.llm.warc import read_archives, write_archives
from wirelake.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(job: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[job.__name__] = job
    return job


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_repetition(spark: SparkSession, folder: str) -> DataFrame:
    return repetition_signals(table(spark, folder, "documents"))


ORACLES["op1_repetition"] = r"""
WITH doc AS (
    SELECT doc_id, coalesce(text, '') AS text, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), word AS (
    SELECT doc_id, unnest(w) AS x, unnest(range(len(w))) AS i FROM doc
), pair AS (
    SELECT a.doc_id, a.i, b.i AS j FROM word a JOIN word b ON a.doc_id = b.doc_id AND a.x = b.x AND a.i < b.i
), run AS (
    SELECT doc_id, j - i AS d, min(i) AS i, count(*) AS n FROM (
        SELECT *, i - row_number() OVER (PARTITION BY doc_id, j - i ORDER BY i) AS g FROM pair) p GROUP BY doc_id, j - i, g
), spot AS (
    SELECT doc_id, n, unnest([i, i + d]) AS i FROM run WHERE n >= 3
), hit AS (
    SELECT doc_id, p, max(n) AS n FROM (SELECT doc_id, n, unnest(range(i, i + n)) AS p FROM spot) s GROUP BY doc_id, p
), cover AS (
    SELECT doc_id, count(*) AS n_repeat_words, count(*) FILTER (WHERE n >= 8) AS n_covered FROM hit GROUP BY doc_id
), longest AS (
    SELECT doc_id, max(n) AS n FROM run GROUP BY doc_id
), line AS (
    SELECT doc_id, count(*) - count(DISTINCT l) AS n_dup_lines FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM doc) s
    WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id
), c AS (
    SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_covered, 0) AS n_covered, coalesce(longest.n, 0) AS longest_repeat
    FROM doc LEFT JOIN cover USING (doc_id) LEFT JOIN longest USING (doc_id) LEFT JOIN line USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * n_covered <= 45 * n_words AND longest_repeat <= 100 AS kept,
    CAST(n_covered AS DOUBLE) / greatest(n_words, 1) AS covered_share, longest_repeat
FROM c
"""


@query
def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = write_archives(table(spark, folder, "pages"), scratch_path(spark, "warc"))
    return read_archives(spark, archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri")


ORACLES["op10_warc"] = r"""
SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
    list_aggregate(list_transform(range(8), lambda g: list_aggregate(list_transform([15, 10, 5, 0], lambda s:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(sha1(coalesce(html, '')), 5 * g + 1, 5) AS BIGINT) >> s) & 31) + 1, 1)), 'string_agg', '')), 'string_agg', '') AS payload_digest,
    CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to, url AS target_uri
FROM (SELECT *, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top FROM pages) p
"""


#: Rules of the url query.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


@query
def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(table(spark, folder, "pages"), URL_RULES)


@query
def op2_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract_main_text(table(spark, folder, "pages"))


@query
def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    return identify(table(spark, folder, "documents"))


@query
def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    judged = judge_contamination(docs, benchmark, scratch_path(spark, "index"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return judged.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


ORACLES["op8_decontamination"] = r"""
WITH item AS (
    SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
    FROM benchmark
), doc AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
    FROM documents
), phrase AS (
    SELECT DISTINCT item, list_slice(w, i, i + 12) AS p FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item WHERE len(w) > 0)
), place AS (
    SELECT doc_id, list_slice(w, i, i + n - 1) AS p, i, n
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT len(p) AS n FROM phrase) WHERE len(w) >= n)
), hit AS (
    SELECT doc_id, item, i, n FROM place JOIN phrase USING (p)
), per_doc AS (
    SELECT doc_id, count(DISTINCT item) AS n_items, sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS items_sha256 FROM hit GROUP BY doc_id
), words_hit AS (
    SELECT doc_id, count(DISTINCT place_hit) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place_hit FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN per_doc USING (doc_id) LEFT JOIN words_hit USING (doc_id)
"""


@query
def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(table(spark, folder, "documents"), scratch_path(spark, "near"), size=4, percent=80)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("doc_id").isNull())
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


ORACLES["op6_near_duplicates"] = r"""
WITH RECURSIVE doc AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), shingle AS (
    SELECT DISTINCT doc_id, list_slice(w, i, i + 3) AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM doc WHERE len(w) > 0)
), size AS (
    SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), pair AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), link AS (
    SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM doc
    UNION SELECT reach.a, e.b FROM reach JOIN (SELECT a, b FROM link UNION ALL SELECT b, a FROM link) e ON reach.b = e.a
)
SELECT doc.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(reach.b) AS component_id, doc.doc_id = min(reach.b) AS kept
FROM doc LEFT JOIN size USING (doc_id) JOIN reach ON reach.a = doc.doc_id GROUP BY doc.doc_id
"""


@query
def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents"), size=35).drop("kept_text")


ORACLES["op5_substring_dedup"] = r"""
WITH doc AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), win AS (
    SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 34), ' ')) AS h
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM doc WHERE len(w) >= 35)
), rep AS (
    SELECT doc_id, i FROM win WHERE h IN (SELECT h FROM win GROUP BY h HAVING count(*) > 1)
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM rep
), word AS (
    SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM doc
), kept AS (
    SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
), lost AS (
    SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""


@query
def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    blank = F.replace(F.coalesce("text", F.lit("")), F.lit("▁"), F.lit(" "))
    docs = table(spark, folder, "documents").select("doc_id", "text", F.sha2(blank, 256).alias("text_sha256"))
    back = pieces.decode(pieces.encode(docs, model, keep_text=False), model)
    digest = F.sha2("decoded", 256)
    return back.select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"), F.xxhash64("token_ids").alias("ids_hash"), digest.alias("decoded_sha256"),
        (digest == F.col("text_sha256")).alias("round_trip"),
    )


@query
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"), scratch_path(spark, "phrases"))


ORACLES["op11_collocations"] = r"""
WITH piece AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
    FROM documents
), words AS (
    SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM piece
), f AS (
    SELECT lang, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase, any_value(list_slice(w, i, i + m - 1)) AS w, count(*) AS f
    FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM words, (SELECT unnest([1, 2, 3]) AS m) WHERE len(w) >= m) GROUP BY ALL
), total AS (
    SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang
), candidate AS (
    SELECT * FROM f WHERE m > 1 AND f >= 10
), cut AS (
    SELECT c.lang, c.phrase, c.w, c.m, c.f AS a, k, x.f AS l, y.f AS r, (1000000::HUGEINT * c.f * c.f) // (x.f::HUGEINT * y.f) AS score
    FROM (SELECT *, unnest(range(1, m)) AS k FROM candidate) c
    JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(list_slice(c.w, 1, k), ' ')
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(list_slice(c.w, k + 1, c.m), ' ')
), best AS (
    SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_part AS (
    SELECT lang, phrase, max(f) AS f FROM (
        SELECT lang, f, unnest([array_to_string(list_slice(w, 1, 2), ' '), array_to_string(list_slice(w, 2, 3), ' ')]) AS phrase FROM candidate WHERE m = 3) GROUP BY ALL
), ranked AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
    FROM best LEFT JOIN inner_part USING (lang, phrase) WHERE f IS NULL OR 100 * f < 50 * a
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


@query
def op12_content_sort(spark: SparkSession, folder: str) -> DataFrame:
    return exact_copies(table(spark, folder, "documents"), scratch_path(spark, "copies"))


ORACLES["op12_content_sort"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query
def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit(table(spark, folder, "documents"), table(spark, folder, "labels"), scratch_path(spark, "audit"))


ORACLES["op13_filter_audit"] = r"""
WITH doc AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), label AS (
    SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id
), judged AS (
    SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, {'A': len(w) < 200, 'B': 100 * len(list_distinct(w)) < 50 * len(w),
        'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t), 'D': regexp_matches(t, '[#$%&*|]'),
        'E': coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)} AS fails
    FROM doc LEFT JOIN label USING (doc_id)
), kind AS (
    SELECT part, good, toxic, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: CASE x WHEN 'A' THEN fails.A WHEN 'B' THEN fails.B WHEN 'C' THEN fails.C WHEN 'D' THEN fails.D ELSE fails.E END) AS failed, count(*) AS n
    FROM judged GROUP BY ALL
), letter AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letter a, letter b, letter c, letter d, letter e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), step AS (
    SELECT filter_order, CAST(unnest(range(1, 6)) AS INTEGER) AS step FROM orders
), told AS (
    SELECT part, filter_order, step, good, toxic, n, failed, substr(filter_order, step, 1) AS own,
        list_has_any(failed, string_split(substr(filter_order, 1, step - 1), '')) AS before, list_has_any(failed, string_split(substr(filter_order, 1, step), '')) AS after
    FROM kind, step
), row AS (
    SELECT part, filter_order, step, own, sum(CASE WHEN NOT after THEN n ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN after AND NOT before THEN n ELSE 0 END)::BIGINT AS removed,
        sum(CASE WHEN before AND list_contains(failed, own) THEN n ELSE 0 END)::BIGINT AS redundant, sum(CASE WHEN failed = [own] THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN after AND NOT before AND good THEN n ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN after AND NOT before AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost
    FROM told GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley FROM row
"""
