"""Held-out accuracy of the language profiles."""

from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from wirelake.llm.language import identify


def test_held_out_accuracy(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = identify(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert held and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_own_language_is_not_looked_at(spark, data):
    """A prediction stays the same when lang and source of held-out rows change."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    other = docs.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("z"))
    assert sorted(map(tuple, identify(docs).collect())) == sorted(map(tuple, identify(other).collect()))


def test_without_letters_or_labels(spark):
    docs = spark.createDataFrame([(1, "123 !!", "en"), (2, "words here", "en"), (3, "more words", None), (4, None, None)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in identify(docs).collect()}
    assert got[1] == got[4] == "und" and got[3] in ("en", "und")
    assert {r["lang_pred"] for r in identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
