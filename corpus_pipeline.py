"""From raw documents to training data, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again before the next stage. All
but the last return the columns of documents; the last adds token ids.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wirelake.llm import pieces
from wirelake.llm.decontamination import drop_contaminated
from wirelake.llm.near_duplicates import drop_near_duplicates
from wirelake.llm.repetition import keep_good
from wirelake.llm.substring_dedup import cut_repeats
from wirelake.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with enough words and little repetition."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity of 0.8 or more)."""
    return drop_near_duplicates(docs, scratch_path(spark, "near"), size=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 35 words or more that occur more than once."""
    return cut_repeats(docs, size=35)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is covered by benchmark phrases of 13 words."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), scratch_path(spark, "index"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their ids, whose text is what the ids decode to."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    back = pieces.decode(pieces.encode(docs, model, keep_text=False), model, text="text")
    return back.select(*docs.columns, F.size("token_ids").cast("long").alias("n_tokens"), "token_ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("near duplicates", near_dedup),
    ("substring dedup", substring_dedup),
    ("decontamination", decontaminate),
    ("sentencepiece", tokenize),
]

#: No SQL has the segmentation into pieces or the repetition rules; tests compare with a version by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_path(spark, "pipeline")
    for place, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{place}")
        docs = spark.read.parquet(f"{folder}/{place}")
    return docs


PIPELINE_QUERIES = {"pipeline": run}
PIPELINE_ORACLES: dict[str, str] = {}
