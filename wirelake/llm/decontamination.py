"""Benchmark decontamination with a positional inverted index, as DataFrame functions.

The test texts are cut into phrases (windows of words). The rarest term of each phrase, by its count in the training texts,
is the one that is looked up. The index stores the postings of those terms: document, position, and the words around the
position, which are the offset-adjusted postings of the phrase's other terms at that place. A posting is a phrase match if
they equal the phrase, and a proximity match if they hold all its terms. One posting gives one row, however many phrases
share its term; only matches are exploded.

Defined results: a null or empty text has no words, is hit by nothing and is not contaminated; a null item_id counts as the
item named by the empty string; equal phrases of several items count for each; repeated rows, also of one doc_id with
different texts, are judged one by one (a row is named by 128 bits); texts are indexed whole; columns that are not named here are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wirelake.llm import rows
from wirelake.llm.url_filter import lower_ascii

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Test terms (some tens of bytes each) and phrases (some hundreds) up to which their list is broadcast; beyond, the join is
#: left to Spark, which splits the postings of a frequent term, since the list is a table and both sides are plain exchanges.
BROADCAST_TERMS, BROADCAST_PHRASES = 200_000, 50_000


def words_of(text: Column) -> Column:
    """Runs of letters, digits and characters beyond ASCII, in their own case."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SEPARATORS), lambda word: word != "")


def phrases(benchmark: DataFrame, size: int) -> DataFrame:
    """phrase (words), items: each window of ``size`` words of the items; all words of an item that has fewer."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of(lower_ascii(F.col("text"))).alias("words")
    ).where(F.size("words") > 0)
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))).alias("start")
    cut = items.select("item", "words", starts).select("item", F.slice("words", F.col("start"), size).alias("phrase"))
    return cut.groupBy("phrase").agg(F.collect_set("item").alias("items"))


def _small(terms: DataFrame) -> DataFrame:
    """Broadcast if the list is short; it is a table on disk, so counting it is cheap."""
    return F.broadcast(terms) if terms.count() <= BROADCAST_TERMS else terms


def _stored(frame: DataFrame, path: str) -> DataFrame:
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """term, n: occurrences in the training texts of each listed term (in lower case) that occurs."""
    words = docs.select(F.explode(words_of(F.col("text"))).alias("word")).select(F.lower("word").alias("term"))
    return words.join(_small(terms), "term").groupBy("term").agg(F.count("*").alias("n"))


def rarest_terms(tests: DataFrame, counts: DataFrame) -> DataFrame:
    """Adds to each phrase its rarest term and the term's place in it; a phrase with a term that never occurs is left out."""
    parts = tests.select("phrase", "items", F.posexplode(F.transform("phrase", F.lower)).alias("place", "term"))
    chosen = parts.join(counts, "term", "left").groupBy("phrase").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "place", "term")).alias("rarest"), F.first("items").alias("items")
    )
    return chosen.where("rarest.n > 0").select("phrase", "items", "rarest.place", "rarest.term")


def build_postings(docs: DataFrame, terms: DataFrame, reach: int) -> DataFrame:
    """term, key, at (from 0), around: a row for each occurrence of a listed term, with ``reach`` words on either side in
    lower case (A-Z). at_around: the term's place in them (from 0)."""
    texts = docs.select(rows.row_key(docs).alias("key"), words_of(docs["text"]).alias("words"))
    places = texts.select("key", "words", F.posexplode("words").alias("at", "word")).withColumn("term", F.lower("word"))
    first = F.greatest(F.col("at") - reach, F.lit(0))
    around = F.slice("words", first + 1, F.col("at") - first + reach + 1)
    return places.join(_small(terms), "term").select(
        "term", "key", "at", (F.col("at") - first).alias("at_around"),
        F.split(lower_ascii(F.array_join(around, " ")), " ").alias("around"),
    )


def by_term(tests: DataFrame) -> DataFrame:
    """term, tests: the phrases that are looked up by each term."""
    return tests.groupBy("term").agg(F.collect_list(F.struct("phrase", "place", "items")).alias("tests"))


def _looked_up(postings: DataFrame, listed: DataFrame) -> DataFrame:
    """Postings, each with all phrases that are looked up by its term."""
    few = (listed.agg(F.sum(F.size("tests"))).first()[0] or 0) <= BROADCAST_PHRASES
    return postings.join(F.broadcast(listed) if few else listed, "term")


def _fits(test: Column) -> Column:
    start = F.col("at_around") - test["place"]
    return (start >= 0) & (F.slice("around", F.greatest(start, F.lit(0)) + 1, F.size(test["phrase"])) == test["phrase"])


def phrase_matches(postings: DataFrame, listed: DataFrame) -> DataFrame:
    """key, start, size, items: where a phrase of the list (`by_term`) occurs word for word."""
    found = _looked_up(postings, listed).select("key", "at", F.explode(F.filter("tests", _fits)).alias("test"))
    return found.select("key", (F.col("at") - F.col("test.place")).alias("start"), F.size("test.phrase").alias("size"), "test.items")


def _near(test: Column) -> Column:
    return F.size(F.array_except(test["phrase"], F.col("around"))) == 0


def proximity_matches(postings: DataFrame, listed: DataFrame) -> DataFrame:
    """key, at, items: where all terms of a phrase occur, in any order, within the reach of the index around the rarest."""
    found = _looked_up(postings, listed).select("key", "at", F.explode(F.filter("tests", _near)).alias("test"))
    return found.select("key", "at", "test.items")


def all_matches(postings: DataFrame, listed: DataFrame) -> DataFrame:
    """key, at, start, size, items, exact: proximity matches, of which phrase matches are the exact ones; one lookup for both."""
    found = _looked_up(postings, listed).select("key", "at", "at_around", "around", F.explode(F.filter("tests", _near)).alias("test"))
    return found.select(
        "key", "at", (F.col("at") - F.col("test.place")).alias("start"), F.size("test.phrase").alias("size"), "test.items", _fits(F.col("test")).alias("exact")
    )


def contamination(docs: DataFrame, benchmark: DataFrame, folder: str, size: int = 13, proximity: bool = True) -> DataFrame:
    """key with n_hit, n_items and the sorted items of each document in which a phrase of the benchmark occurs.

    proximity: also n_near (places with a proximity match, exact ones too) and near_items; a document with proximity matches
    only has n_hit 0 and no items. Terms and postings are stored under ``folder``, which all executors share."""
    tests = _stored(phrases(benchmark, size), f"{folder}/phrases")
    terms = tests.select(F.explode(F.transform("phrase", F.lower)).alias("term")).distinct()
    counts = _stored(term_counts(docs, _stored(terms, f"{folder}/terms")), f"{folder}/counts")
    tests = _stored(rarest_terms(tests, counts), f"{folder}/tests")
    listed = _stored(by_term(tests), f"{folder}/listed")
    postings = _stored(build_postings(docs, listed.select("term"), size - 1), f"{folder}/postings")
    found = all_matches(postings, listed) if proximity else phrase_matches(postings, listed).withColumn("exact", F.lit(True))
    span = F.struct("start", (F.col("start") + F.col("size")).alias("end"))
    near = [
        F.size(F.collect_set("at")).cast("long").alias("n_near"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("near_items"),
    ] if proximity else []
    return found.groupBy("key").agg(
        F.array_sort(F.collect_set(F.when(F.col("exact"), span))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(F.col("exact"), F.col("items")))))).alias("items"), *near,
    ).select(
        "key", _union_length("spans").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"), "items",
        *(["n_near", "near_items"] if proximity else []),
    )


def _union_length(spans: str) -> Column:
    """Words inside at least one of the spans, which are sorted by their start."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def add(total: Column, span: Column) -> Column:
        new = F.greatest(span["end"] - F.greatest(span["start"], total["end"]), F.lit(0))
        return F.struct((total["n"] + new).alias("n"), F.greatest(total["end"], span["end"]).alias("end"))

    return F.aggregate(spans, zero, add, lambda total: total["n"])


def judge_contamination(docs: DataFrame, benchmark: DataFrame, folder: str, size: int = 13, share: int = 20) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items, n_near, near_items and contaminated (one word in ``share`` or more is hit) of each
    document. Proximity matches are reported and do not count as hits."""
    hits = contamination(docs, benchmark, folder, size)
    texts = docs.select("doc_id", rows.row_key(docs).alias("key"), F.size(words_of(docs["text"])).cast("long").alias("n_words"))
    none = F.lit(0).cast("long")
    return texts.join(hits, "key", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", none).alias("n_hit"), F.coalesce("n_items", none).alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("n_near", none).alias("n_near"), F.coalesce("near_items", F.array().cast("array<string>")).alias("near_items"),
        (F.coalesce("n_hit", none) > 0).alias("_hit"),
    ).withColumn("contaminated", F.col("_hit") & (share * F.col("n_hit") >= F.col("n_words"))).drop("_hit")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, folder: str, size: int = 13, share: int = 20) -> DataFrame:
    """Documents that are not contaminated, with all their columns."""
    words = docs.select(rows.row_key(docs).alias("key"), F.size(words_of(docs["text"])).alias("n_words"))
    bad = words.join(contamination(docs, benchmark, folder, size, proximity=False), "key").where(share * F.col("n_hit") >= F.col("n_words"))
    whole = docs.select(rows.row_key(docs).alias("key"), F.struct("*").alias("doc"))
    return whole.join(bad.select("key").distinct(), "key", "left_anti").select("doc.*")
