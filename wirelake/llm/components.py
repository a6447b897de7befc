"""Connected components of a graph of links, by contraction inside tasks and pointer jumps between them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from wirelake.llm.arrays import map_in_tasks

CHUNK = 1 << 20  # links that a task contracts at once
LINKS = "a long, b long"


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the links that is not the smallest of its component, and that smallest node."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[: len(a)], place[len(a) :]
    label = np.arange(len(nodes))
    while (label[x] != label[y]).any():
        low = np.minimum(label[x], label[y])
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        while (label[label] != label).any():
            label = label[label]
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def contracted(links: DataFrame) -> DataFrame:
    """Links (a > b) that connect the same nodes: of each chunk of a task's links, a star for each component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def closed() -> pa.RecordBatch:
            a, b = forest(*(np.concatenate(side) for side in zip(*held, strict=True)))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            held.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)))
            if sum(len(a) for a, _ in held) >= CHUNK:
                yield closed()
        if held:
            yield closed()

    return map_in_tasks(links.select("a", "b"), run, LINKS)


def components(links: DataFrame, folder: str) -> DataFrame:
    """node, root (the smallest node that it is connected with) for each node of ``links`` (a, b: numbers).

    In a round, the smaller node of each link is replaced by the smallest node that it has a link down to, and the links of
    a node, which meet in one task then, are contracted. The links of a round are a table under ``folder``, which all
    executors share, so a lost executor costs one round at most; count and checksum, by which the last round is known, are
    taken while they are written. Minima are combined before the shuffle and stored before they are joined, so that both
    sides of the join are plain exchanges and Spark can split a node with many links; a task contracts CHUNK links at a
    time, so such a node needs no more memory either. Links of a node with itself and repeated links change nothing; no links
    give an empty result."""
    spark = links.sparkSession

    def stored(frame: DataFrame, round_: int) -> tuple[DataFrame, tuple]:
        seen = Observation()
        counted = frame.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum"))
        counted.write.parquet(f"{folder}/round-{round_}")
        return spark.read.parquet(f"{folder}/round-{round_}"), (seen.get["n"], seen.get["sum"])

    edges, state = stored(contracted(links), 0)
    round_, before = 0, None
    while state[0] and state != before:
        round_, before = round_ + 1, state
        edges.groupBy("a").agg(F.min("b").alias("m")).write.parquet(f"{folder}/least-{round_}")
        least = spark.read.parquet(f"{folder}/least-{round_}").select(F.col("a").alias("b"), "m")
        jumped = edges.join(least, "b", "left").select("a", F.coalesce("m", "b").alias("b"))
        edges, state = stored(contracted(jumped.repartition("a")), round_)
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
