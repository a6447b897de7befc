"""Exact copies by sorting whole texts: range partitions, an external sort, and comparison of neighbours.

Rows are ordered by the first characters of their text, the SHA-256 digest of the whole text, and doc_id downwards. Spark
samples splitters from these bounded keys only (a splitter never holds a long text), deals the rows to ranges and sorts each
with spilling. Equal texts are neighbours then; each row is compared in full with the one before it. As doc_id is part of the
splitters, any number of copies of one text spreads over as many tasks as its bytes need.

A task sees the runs of equal texts in its range whole, but for its first and last run, which may go on in the ranges beside
it. Those two are marked, merged by their digest (two rows for each range at most, so they are broadcast), and joined back to
the marked rows. A task holds the ids of one run of its range at a time.

Defined results: a null text is empty, and empty texts are equal; the row with the largest doc_id stays, a null doc_id only
where the group has no other; of repeated rows (equal text and doc_id) exactly one is kept; an empty table gives no rows;
extra columns are never read. Texts are never cut or changed unless ``normalise`` is given.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wirelake.llm.arrays import map_in_tasks

HEAD = 64
FIELDS = ["doc_id", "keep_id", "size", "first", "digest", "range"]


def content_order(docs: DataFrame, normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """doc_id, text, digest in ranges and sorted, the largest doc_id of equal texts first."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (normalise(text) if normalise else text).alias("text"))
    rows = rows.select("*", F.unhex(F.sha2("text", 256)).alias("digest"), F.substring("text", 1, HEAD).alias("head"))
    order = [F.asc("head"), F.asc("digest"), F.desc_nulls_last("doc_id")]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a sorted range with the size and first doc_id of their run of equal texts.

    ``range`` is set on the first and the last run only."""
    here = TaskContext.get().partitionId()
    last_text, ids, digest, first_run = None, [], None, True

    def rows(doc_ids: pa.Array, digests: pa.Array, starts: np.ndarray, edge: bool) -> pa.RecordBatch:
        sizes = np.diff(np.r_[starts, len(doc_ids)])
        head = np.zeros(len(doc_ids), bool)
        head[starts] = True
        return pa.RecordBatch.from_arrays([
            doc_ids, doc_ids.take(pa.array(np.repeat(starts, sizes))), pa.array(np.repeat(sizes, sizes)), pa.array(head), digests,
            pa.array([here if edge else None] * len(doc_ids), pa.int32()),
        ], FIELDS)

    def closed(edge: bool) -> pa.RecordBatch:
        whole = pa.concat_arrays(ids)
        return rows(whole, pa.array([digest] * len(whole), pa.binary()), np.array([0]), edge)

    for batch in batches:
        if not batch.num_rows:
            continue
        doc_ids, text, digests = batch.column(0), batch.column(1), batch.column(2)
        differs = pc.not_equal(text[1:], text[:-1]).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.r_[last_text is None or text[0].as_py() != last_text, differs])
        last_text = text[-1].as_py()
        if len(starts) and ids:
            ids.append(doc_ids[: starts[0]])
            yield closed(first_run)
            ids, first_run = [], False
        if len(starts) > 1:
            a, b = starts[0], starts[-1]
            if first_run:
                yield rows(doc_ids[a : starts[1]], digests[a : starts[1]], np.array([0]), True)
                starts, a, first_run = starts[1:], starts[1], False
            if b > a:
                yield rows(doc_ids[a:b], digests[a:b], starts[:-1] - a, False)
        begin = starts[-1] if len(starts) else 0
        ids.append(doc_ids[begin:])
        digest = digests[-1].as_py()
    if ids:
        yield closed(True)


def exact_copies(docs: DataFrame, folder: str, normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row. ``folder`` is a shared one, for the table of runs."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, keep_id {kind}, size long, first boolean, digest binary, range int"
    map_in_tasks(content_order(docs, normalise).select("doc_id", "text", "digest"), runs, schema).write.parquet(f"{folder}/runs")
    rows = docs.sparkSession.read.parquet(f"{folder}/runs")
    ends = rows.where("range IS NOT NULL").groupBy("digest", "range").agg(F.max("size").alias("size"), F.max("keep_id").alias("keep_id"))
    whole = ends.groupBy("digest").agg(
        F.sum("size").alias("group_size"), F.min("range").alias("first_range"), F.min_by("keep_id", "range").alias("kept_id"))
    whole = whole.withColumnRenamed("digest", "of")
    marked = rows.join(F.broadcast(whole), (F.col("digest") == F.col("of")) & F.col("range").isNotNull(), "left")
    inside = F.col("of").isNull()
    return marked.select(
        "doc_id", F.when(inside, F.col("keep_id")).otherwise(F.col("kept_id")).alias("keep_id"),
        F.when(inside, F.col("size")).otherwise(F.col("group_size")).alias("group_size"),
        (F.col("first") & (inside | (F.col("range") == F.col("first_range")))).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, folder: str) -> DataFrame:
    """The rows of docs that stay, with all their columns: one for each distinct text.

    Of repeated rows (equal doc_id and text) the one stays that is least by all its columns."""
    found = exact_copies(docs.select("doc_id", "text"), folder).where("kept")
    stay = found.select(F.col("doc_id").alias("kept doc"), F.col("text_sha256").alias("kept digest"))
    marked = docs.withColumn("own digest", F.sha2(F.coalesce("text", F.lit("")), 256))
    mine = marked.join(stay, F.col("doc_id").eqNullSafe(F.col("kept doc")) & (F.col("own digest") == F.col("kept digest")), "left_semi")
    same = Window.partitionBy("doc_id", "own digest").orderBy(*[F.col(f"`{c}`") for c in docs.columns])
    return mine.withColumn("place in group", F.row_number().over(same)).where("`place in group` = 1").select(*docs.columns)
