"""Names for rows that have no identifier of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "struct<a:bigint,b:bigint>"


def first_hash(docs: DataFrame) -> Column:
    return F.xxhash64(docs["doc_id"], docs["text"])


def second_hash(docs: DataFrame) -> Column:
    """Independent of the first; tells a null from what stands in the other column."""
    return F.xxhash64(docs["text"], docs["doc_id"], docs["text"].isNull())


def row_key(docs: DataFrame) -> Column:
    """128 bits of a row's doc_id and text: equal rows share them, and of 10^11 unlike rows no two are expected to."""
    return F.struct(first_hash(docs).alias("a"), second_hash(docs).alias("b"))
