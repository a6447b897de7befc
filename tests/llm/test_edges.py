"""Every operator and stage on nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wirelake.llm import pieces
from wirelake.llm.decontamination import drop_contaminated, judge_contamination
from wirelake.llm.language import identify
from wirelake.llm.main_text import extract_main_text
from wirelake.llm.near_duplicates import drop_near_duplicates, near_duplicates
from wirelake.llm.repetition import keep_good, repetition_signals
from wirelake.llm.substring_dedup import cut_repeats, remove_repeats
from wirelake.llm.token_counts import count_tokens
from wirelake.llm.url_filter import judge_urls
from wirelake.llm.warc import read_archives, write_archives

MODEL = public_tokenizers.path("piece_bpe_32k.model")
CLASHES = ["key", "row", "set", "spans", "_row", "n_words", "kept", "anchor", "words", "path", "verdict", "features"]


def prose(n: int, seed: int) -> str:
    return " ".join(f"w{(i * i * 31 + seed * 7919 + i) % 99991}" for i in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, prose(300, 1)), (2, prose(300, 1)), (2, prose(300, 1)), (3, None), (4, ""), (5, " \n\t "), (6, prose(30000, 2)),
        (7, "one two"), (8, "One TWO"), (None, prose(80, 3)), (None, None), (9, "same " * 200), (10, "ünïcode ▁   text"),
    ]
    table = spark.createDataFrame([(i, t, "en" if t else None, None, 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for name in CLASHES:
        table = table.withColumn(name, F.lit("mine"))
    return table


@pytest.fixture(scope="module")
def pages(spark):
    rows = [
        (1, "http://a.org/x", "<p>text</p>"), (2, "http://a.org/x", "<p>text</p>"), (3, None, None), (4, "no scheme", ""), (5, "://", "<"),
        (None, "HTTP://B.COM", "<p>text</p>"), (7, "http://c.com/" + "y" * 50000, "<div>" + "long " * 50000), (2, "http://a.org/x", "<p>text</p>"),
    ]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    for name in CLASHES:
        table = table.withColumn(name, F.lit("mine"))
    return table


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, prose(40, 1)), (1, prose(40, 1)), (2, None), (3, ""), (4, "one two"), (None, prose(20, 3))]
    return spark.createDataFrame([(i, t, "mine") for i, t in rows], "item_id long, text string, key string")


def folder(tmp_path):
    return f"file://{tmp_path}/work"


DOC_OPERATORS = {
    "repetition": lambda d, b, p: repetition_signals(d),
    "tokens": lambda d, b, p: count_tokens(d, public_tokenizers.path("byte_bpe_50k.json")),
    "near": lambda d, b, p: near_duplicates(d, p),
    "repeats": lambda d, b, p: remove_repeats(d),
    "contamination": lambda d, b, p: judge_contamination(d, b, p),
    "language": lambda d, b, p: identify(d),
    "encode": lambda d, b, p: pieces.decode(pieces.encode(d, MODEL), MODEL),
}
PAGE_OPERATORS = {
    "main_text": lambda t, p: extract_main_text(t),
    "urls": lambda t, p: judge_urls(t, [("allow", "org/"), ("block", "com/")]),
    "warc": lambda t, p: read_archives(t.sparkSession, write_archives(t, p)),
}
STAGES = {
    "keep_good": lambda d, b, p: keep_good(d),
    "drop_near": lambda d, b, p: drop_near_duplicates(d, p),
    "cut": lambda d, b, p: cut_repeats(d),
    "drop_contaminated": lambda d, b, p: drop_contaminated(d, b, p),
}


@pytest.mark.parametrize("name", DOC_OPERATORS)
def test_each_document_has_a_row(name, docs, benchmark, tmp_path):
    rows = DOC_OPERATORS[name](docs, benchmark, folder(tmp_path)).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in docs.collect())


@pytest.mark.parametrize("name", PAGE_OPERATORS)
def test_each_page_has_a_row(name, pages, tmp_path):
    rows = PAGE_OPERATORS[name](pages, folder(tmp_path)).collect()
    assert sorted(str(r["page_id"]) for r in rows) == sorted(str(r["page_id"]) for r in pages.collect())


@pytest.mark.parametrize("name", STAGES)
def test_stages_keep_columns(name, docs, benchmark, tmp_path):
    out = STAGES[name](docs, benchmark, folder(tmp_path))
    assert out.columns == docs.columns
    assert all(r[c] == "mine" for r in out.collect() for c in CLASHES)


@pytest.mark.parametrize("name", [*DOC_OPERATORS, *STAGES])
def test_empty_documents(name, docs, benchmark, tmp_path):
    assert {**DOC_OPERATORS, **STAGES}[name](docs.limit(0), benchmark.limit(0), folder(tmp_path)).count() == 0


@pytest.mark.parametrize("name", PAGE_OPERATORS)
def test_empty_pages(name, pages, tmp_path):
    assert PAGE_OPERATORS[name](pages.limit(0), folder(tmp_path)).count() == 0


def test_near_copies_leave_one_row(docs, tmp_path):
    out = [r["doc_id"] for r in drop_near_duplicates(docs, folder(tmp_path), size=2).collect()]
    assert out.count(1) == 1 and 2 not in out and 7 in out and 8 not in out
    assert {3, 4, 5} <= set(out)


def test_pipeline_on_clashing_columns(docs, benchmark, spark, tmp_path):
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    table = docs
    for place, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, table, str(tmp_path)).write.parquet(f"{tmp_path}/{place}")
        table = spark.read.parquet(f"{tmp_path}/{place}")
    rows = table.collect()
    # 1, 2: a benchmark passage; 9: repeats itself; short and empty ones fail the base rule
    assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) == [6]
    assert all(r["n_tokens"] == len(r["token_ids"]) and r["key"] == "mine" for r in rows)


def test_pipeline_on_no_documents(docs, benchmark, spark, tmp_path):
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
