"""Interaction audit of filters: what each filter removes, in every order, from one truth table per document.

A document that fails the filters in ``fails`` (bit k: filter k) survives a subset S of the filters if it fails none of S.
Its 32-bit word has bit S set for every subset S that it survives. Tasks count these words by position with carry-save
adders, whole arrays at a time, and Spark sums the 32 counts per part and label. Every figure of every order of the filters
is a difference of such counts, so the number of orders never multiplies the documents.

Spread: texts are read once where they lie; rows of (doc_id, part, digest, fails) go to a table. Copies are found by the
least doc_id per SHA-256 digest (combined before the shuffle, then a table) and joined back, labels by doc_id; Spark splits a
hot digest in the join. Only counts per part leave the tasks.

Defined results: a null text is empty, a null part is the empty string; repeated rows count each; a null doc_id has no label,
is no one's smaller doc_id and has none itself; of several label rows of a document, any 1 counts; an empty table gives no
rows. Words are told apart by 64-bit hashes inside a slice of a batch. Extra columns are never read.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wirelake.llm.arrays import Spans, find_words, map_batches, map_in_tasks, mix, sums_by, text_slices

LEAST_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 2
SYMBOLS = "#$%&*|"
NAMES = "ABCDE"
SUBSETS = 32
COUNTS = ("kept", "good", "toxic")

_CAPITAL = np.isin(np.arange(256), np.arange(ord("A"), ord("Z") + 1))
_SYMBOL = np.isin(np.arange(256), [ord(c) for c in SYMBOLS])


def text_failures(docs: DataFrame, part: str = "source") -> DataFrame:
    """doc_id, part, digest, fails of every document: bits 0 to 3 are the filters A to D, which need the text alone."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce(part, F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"))

    def judge(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        fails = np.zeros(batch.num_rows, np.int32)
        for row, end, data, offsets in text_slices(batch.column(3)):
            words = find_words(data, offsets)
            owner, n_words = words.rows(), words.counts
            hashes = mix(Spans(data).hash(words.starts, words.ends) + mix(owner.astype(np.uint64) + np.uint64(1)))
            distinct = np.bincount(owner[np.unique(hashes, return_index=True)[1]], minlength=end - row)
            points = sums_by((data & 0xC0) != 0x80, offsets)
            failed = [
                n_words < LEAST_WORDS, 100 * distinct < DISTINCT_PERCENT * n_words,
                100 * sums_by(_CAPITAL[data], offsets) > CAPITAL_PERCENT * points, sums_by(_SYMBOL[data], offsets) > 0,
            ]
            fails[row:end] = sum(f.astype(np.int32) << k for k, f in enumerate(failed))
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fails)], ["doc_id", "part", "digest", "fails"])

    return map_batches(rows, judge, "doc_id long, part string, digest binary, fails int")


def with_copies(failures: DataFrame, folder: str, bit: int = 4) -> DataFrame:
    """The failures with one more bit: an equal text has a smaller doc_id.

    ``failures`` is read twice: pass a stored table. The least doc_ids are stored too, as Spark splits the rows of a hot digest
    only in a join of two tables, not where one side is an aggregate on the same exchange."""
    copied = failures.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    copied.select("digest", "first").write.parquet(f"{folder}/copies")
    later = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    marked = failures.join(failures.sparkSession.read.parquet(f"{folder}/copies"), "digest", "left")
    return marked.select("doc_id", "part", F.col("fails").bitwiseOR(later.cast("int") * (1 << bit)).alias("fails"))


def with_labels(failures: DataFrame, labels: DataFrame) -> DataFrame:
    """part, fails and the labels good and toxic (any label row of the document has 1)."""
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(*[
        F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))
    ])
    return failures.join(known, "doc_id", "left").select(
        "part", "fails", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def survival_words() -> np.ndarray:
    """The word of each set of failed filters: bit S is set where S holds none of them."""
    return np.array([sum(1 << s for s in range(SUBSETS) if not s & fails) for fails in range(SUBSETS)], np.uint32)


def positional_counts(words: np.ndarray) -> np.ndarray:
    """How many words have each of the 32 bits set.

    Three words of weight 2^k make one of weight 2^k (their sum) and one of weight 2^(k+1) (their carry), for a third of an
    array at a time; bits are counted singly only in the two words at most that are left of each weight."""
    counts, weight, level = np.zeros(SUBSETS, np.int64), 1, words
    bits = np.arange(SUBSETS, dtype=np.uint32)
    while len(level):
        carries = []
        while len(level) > 2:
            third = len(level) // 3
            a, b, c, rest = level[:third], level[third : 2 * third], level[2 * third : 3 * third], level[3 * third :]
            half = a ^ b
            carries.append((a & b) | (half & c))
            level = np.concatenate([half ^ c, rest])
        counts += weight * ((level[:, None] >> bits) & np.uint32(1)).sum(axis=0, dtype=np.int64)
        level = np.concatenate(carries) if carries else words[:0]
        weight *= 2
    return counts


def survivors(judged: DataFrame) -> DataFrame:
    """part and, for all documents and those of each label, the number that survive each subset of the filters."""
    table = survival_words()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.column(0).dictionary_encode()
            codes, words = part.indices.to_numpy(), table[batch.column(1).to_numpy()]
            order = np.argsort(codes, kind="stable")
            cuts = np.searchsorted(codes[order], np.arange(len(part.dictionary) + 1))
            keep = [np.ones(len(codes), bool), *(pc.fill_null(batch.column(i), False).to_numpy(zero_copy_only=False) for i in (2, 3))]
            rows = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            lists = [[positional_counts(words[r[k[r]]]).tolist() for r in rows] for k in keep]
            yield pa.RecordBatch.from_arrays([part.dictionary, *(pa.array(x, pa.list_(pa.int64())) for x in lists)], ["part", *COUNTS])

    counted = map_in_tasks(judged.select("part", "fails", "good", "toxic"), count, "part string, kept array<long>, good array<long>, toxic array<long>")
    return counted.groupBy("part").agg(*[F.array(*[F.sum(F.col(c)[s]) for s in range(SUBSETS)]).alias(c) for c in COUNTS])


def order_steps() -> list[dict[str, int | str]]:
    """Every step of every order: the subsets before and after it, and its filter."""
    steps = []
    for order in permutations(range(len(NAMES))):
        before = 0
        for step, own in enumerate(order, 1):
            steps.append({"filter_order": "".join(NAMES[k] for k in order), "step": step, "before": before, "after": before | 1 << own, "own": own})
            before |= 1 << own
    return steps


def all_removed(own: int) -> Column:
    """Documents that filter ``own`` removes, summed over all orders."""
    bit, others = 1 << own, len(NAMES) - 1
    weight = {s: math.factorial(s.bit_count()) * math.factorial(others - s.bit_count()) for s in range(SUBSETS) if not s & bit}
    return sum((F.lit(w) * (F.col("kept")[s] - F.col("kept")[s | bit]) for s, w in weight.items()), F.lit(0).cast("long"))


def order_report(counted: DataFrame) -> DataFrame:
    """A row per part, order of the filters and step, from the counts of ``survivors``."""
    plan = F.from_json(F.lit(json.dumps(order_steps())), "array<struct<filter_order: string, step: int, before: int, after: int, own: int>>")
    rows = counted.withColumn("shares", F.array(*[all_removed(k) for k in range(len(NAMES))])).select("*", F.inline(plan))
    bit = F.expr("shiftleft(1, own)")

    def at(column: str, subset: Column) -> Column:
        return F.get(F.col(column), subset)

    removed = at("kept", F.col("before")) - at("kept", F.col("after"))
    return rows.select(
        "part", "filter_order", "step", at("kept", F.col("after")).alias("kept"), removed.alias("removed"),
        (at("kept", F.lit(0)) - at("kept", bit) - removed).alias("redundant"),
        (at("kept", F.lit(SUBSETS - 1).bitwiseXOR(bit)) - at("kept", F.lit(SUBSETS - 1))).alias("unique_fails"),
        (at("good", F.col("before")) - at("good", F.col("after"))).alias("good_lost"),
        (at("toxic", F.col("before")) - at("toxic", F.col("after"))).alias("toxic_lost"),
        F.get(F.col("shares"), F.col("own")).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, folder: str, part: str = "source") -> DataFrame:
    """The report over whole ``docs``; ``folder`` is a shared one for the table of failures."""
    text_failures(docs, part).write.parquet(f"{folder}/failures")
    failures = docs.sparkSession.read.parquet(f"{folder}/failures")
    return order_report(survivors(with_labels(with_copies(failures, folder), labels)))
