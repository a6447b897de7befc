"""MinHash near-duplicates by a multi-index Hamming join.

A document's word shingles give a signature of PARTS minimum hashes, 16 bits each. The signature is split into CHUNKS of
WIDTH parts. Two signatures that differ in fewer than 2 * CHUNKS parts have a chunk that differs in one part at most
(pigeonhole), so each chunk is indexed once for each part that may be wrong, under its other parts. Documents that share an
entry are compared by the distance of whole signatures, and those that are near are linked if their full shingle sets are
similar enough. At a similarity of 0.8 the chance that no chunk agrees is 0.263 ** CHUNKS, 1 in 10 million.

Nothing is expanded into pairs. Equal sets are one class from the start. A bucket of the index, and then a group of near
signatures, is compared inside a task, block by block where it is large (BLOCK_ROWS, BLOCK_ITEMS), and gives a spanning
forest of what it has found. Sets travel only for classes that have a near neighbour.

Defined results: a null text, or one without words, has no shingles and is its own component; a text with fewer words than
a shingle is one shingle; repeated rows are linked; a null doc_id never names a component that has another, and is kept
only as its first row in a component of null ids; sets are told apart by two 64-bit hashes, rows by two others. Other columns are
not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wirelake.llm import rows as names
from wirelake.llm.arrays import Spans, find_words, map_batches, map_in_tasks, mix, ranges, text_slices
from wirelake.llm.components import components

CHUNKS, WIDTH = 12, 5
PARTS = CHUNKS * WIDTH
#: Differing parts beyond which sets are not compared; a pair of similarity 0.8 exceeds it once in 10 million.
FAR = 28
BLOCK_ROWS, BLOCK_ITEMS = 2048, 2_000_000

_random = np.random.default_rng(77)
_FLIPS = _random.integers(1, 1 << 63, size=PARTS, dtype=np.uint64)
_ODDS = _random.integers(1, 1 << 63, size=PARTS, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, and where those of each text begin."""
    found = find_words(data, offsets)
    words = Spans(data, lower=True).hash(found.starts, found.ends)
    n, counts = len(words), found.counts
    rolled = np.zeros(n, np.uint64)
    for i in range(size):
        rolled[: max(n - i, 0)] = rolled[: max(n - i, 0)] * _STEP + words[i:]
    left = np.repeat(found.of[1:], counts) - np.arange(n)  # words from here to the end of the text
    whole = left >= size
    for text in np.flatnonzero((counts > 0) & (counts < size)):
        value = np.uint64(counts[text])
        for word in words[found.of[text] : found.of[text + 1]]:
            value = np.uint64((int(value) * int(_STEP) + int(word)) & 0xFFFFFFFFFFFFFFFF)
        rolled[found.of[text]] = value
        whole[found.of[text]] = True
    hashes, rows = mix(rolled[whole]), found.rows()[whole]
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    return hashes[new], np.searchsorted(rows[new], np.arange(len(counts) + 1))


def signatures(hashes: np.ndarray, of: np.ndarray) -> np.ndarray:
    """PARTS minimum hashes of 16 bits of each set; zeros for an empty one."""
    out = np.zeros((len(of) - 1, PARTS), np.uint16)
    some = np.flatnonzero(np.diff(of))
    if len(some):
        for part in range(PARTS):
            least = np.minimum.reduceat((hashes ^ _FLIPS[part]) * _ODDS[part], of[:-1][some])
            out[some, part] = mix(least).astype(np.uint16)
    return out


def index_entries(signature: np.ndarray) -> np.ndarray:
    """For each signature, one key for each chunk and each part of it that may differ."""
    chunks = signature.astype(np.uint64).reshape(len(signature), CHUNKS, WIDTH)
    keys = np.empty((len(signature), CHUNKS, WIDTH), np.uint64)
    for wrong in range(WIDTH):
        key = np.zeros((len(signature), CHUNKS), np.uint64)
        for part in range(WIDTH):
            if part != wrong:
                key = (key << np.uint64(16)) | chunks[:, :, part]
        keys[:, :, wrong] = mix(mix(key) + (np.arange(CHUNKS, dtype=np.uint64) * np.uint64(WIDTH) + np.uint64(wrong + 1)) * _STEP)
    return keys.reshape(len(signature), PARTS)


def _set_ids(hashes: np.ndarray, of: np.ndarray) -> np.ndarray:
    return _set_hash(hashes, of, np.uint64(0xA5A5A5A5A5A5A5A5))


def _set_hash(hashes: np.ndarray, of: np.ndarray, flip: np.uint64) -> np.ndarray:
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mix(hashes ^ flip), out=total[1:])
    return mix(total[of[1:]] - total[of[:-1]] + np.diff(of).astype(np.uint64)).view(np.int64)


def _blobs(values: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in values], pa.binary())


def _describe(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, row (its name), n_shingles, set and check (two hashes of the set; null if empty), signature of each row."""

    def describe(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row, end, data, offsets in text_slices(batch.column(2)):
            hashes, of = shingle_sets(data, offsets, size)
            n = np.diff(of)
            ids = [pa.array(v, mask=n == 0) for v in (_set_ids(hashes, of), _set_hash(hashes, of, np.uint64(0x3C3C3C3C3C3C3C3C)))]
            columns = [batch.column(0).slice(row, end - row), batch.column(1).slice(row, end - row), pa.array(n), *ids, _blobs(signatures(hashes, of))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "n_shingles", "set", "check", "signature"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", names.row_key(docs).alias("row"), "text")
    return map_batches(rows, describe, f"doc_id {kind}, row {names.KEY}, n_shingles long, set long, check long, signature binary")


def _told_apart(rows: DataFrame, folder: str) -> DataFrame:
    """Rows whose ``set`` differs for unlike sets: of those with one hash, the least ``check`` keeps it, others get one of both.

    The table of hashes that several sets have is all but empty, so Spark broadcasts it by its size."""
    clash = rows.where("set IS NOT NULL").groupBy("set").agg(F.min("check").alias("least"), F.max("check").alias("most"))
    clash.where("least < most").select("set", "least").write.parquet(f"{folder}/clashes")
    known = rows.sparkSession.read.parquet(f"{folder}/clashes")
    own = F.when(F.col("least") < F.col("check"), F.xxhash64("set", "check")).otherwise(F.col("set"))
    return rows.join(known, "set", "left").withColumn("set", own).drop("check", "least")


def _entries(sets: DataFrame) -> DataFrame:
    def enter(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        signature = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, PARTS)
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(ids), 2000):
            keys = index_entries(signature[at : at + 2000]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(ids[at : at + 2000], PARTS))], ["key", "set"])

    return map_batches(sets.select("set", "signature"), enter, "key long, set long")


def in_blocks(rows: DataFrame, group: str, member: str, blocks: str) -> DataFrame:
    """Sends each row to the blocks of its group in which it is compared: all pairs of the ``blocks`` parts of the group."""
    own = F.pmod(F.xxhash64(member), F.col(blocks)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col(blocks).cast("int") - 1)).alias("other")
    return rows.withColumn("own", own).select("*", other).withColumns({
        "left": F.least("own", "other"), "right": F.greatest("own", "other"),
    }).drop("other", blocks)


def by_group(rows: DataFrame, keys: list[str], payload: list[str], compare: Callable, schema: str) -> DataFrame:
    """Calls ``compare`` with the payload columns of each group of rows that agree in ``keys`` (numbers)."""
    sorted_ = rows.select(*keys, *payload).repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(keys))])
            cuts = np.r_[0, np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1, batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                key = tuple(ids[:, a])
                if held and key != last:
                    yield from compare(last, pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(a, b - a))
                last = key
        if held:
            yield from compare(last, pa.Table.from_batches(held))

    return map_in_tasks(sorted_, run, schema)


class Forest:
    """Which rows are connected so far."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def later(self, i: int) -> np.ndarray:
        """Rows after ``i`` that are not connected with it."""
        return i + 1 + np.flatnonzero(self.label[i + 1 :] != self.label[i])

    def connect(self, i: int, rows: np.ndarray) -> np.ndarray:
        """Connects ``i`` with the rows; returns one row of each tree that is new to it."""
        _, first = np.unique(self.label[rows], return_index=True)
        self.label[np.isin(self.label, self.label[rows])] = self.label[i]
        return rows[first]


def _links(pairs: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    if pairs:
        a, b = (np.concatenate(side) for side in zip(*pairs, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _compare_signatures(_: tuple, table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Spanning forest of the rows of a block whose signatures are near."""
    ids = _column(table, "set")
    signature = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint16).reshape(-1, PARTS)
    forest, pairs = Forest(len(ids)), []
    for i in range(len(ids) - 1):
        near = forest.later(i)
        near = near[(signature[near] != signature[i]).sum(axis=1) <= FAR]
        if len(near):
            new = forest.connect(i, near)
            pairs.append((np.repeat(ids[i], len(new)), ids[new]))
    yield from _links(pairs)


def _compare_sets(percent: int) -> Callable:
    def compare(_: tuple, table: pa.Table) -> Iterator[pa.RecordBatch]:
        """Spanning forest of the rows of a block whose sets are similar; those of different parts, or all of one part."""
        ids, first = np.unique(_column(table, "set"), return_index=True)
        table = table.take(pa.array(first))
        part = _column(table, "own")
        blobs = table.column("shingles").to_pylist()
        of = np.r_[0, np.cumsum([len(b) // 8 for b in blobs])]
        hashes = np.frombuffer(b"".join(blobs), np.uint64)
        signature = signatures(hashes, of)
        _, items = np.unique(hashes, return_inverse=True)
        size, marked = np.diff(of), np.zeros(len(hashes) + 1, bool)
        forest, pairs, across = Forest(len(ids)), [], len(np.unique(part)) > 1
        for i in range(len(ids) - 1):
            near = forest.later(i)
            near = near[part[near] != part[i]] if across else near
            near = near[(signature[near] != signature[i]).sum(axis=1) <= FAR]
            if not len(near):
                continue
            own = items[of[i] : of[i + 1]]
            marked[own] = True
            length = size[near]
            common = np.add.reduceat(marked[items[ranges(of[near], length)]].astype(np.int64), np.cumsum(length) - length)
            marked[own] = False
            near = near[100 * common >= percent * (size[i] + length - common)]
            if len(near):
                new = forest.connect(i, near)
                pairs.append((np.repeat(ids[i], len(new)), ids[new]))
        yield from _links(pairs)

    return compare


def linked_sets(docs: DataFrame, folder: str, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Described rows (``_describe``), and set, root of the sets that are linked with others."""
    spark = docs.sparkSession
    _describe(docs, size).write.parquet(f"{folder}/rows")
    rows = _told_apart(spark.read.parquet(f"{folder}/rows"), folder)
    sets = rows.where("set IS NOT NULL").groupBy("set").agg(
        F.first("signature").alias("signature"), F.first("n_shingles").alias("n_shingles"), F.min("row").alias("row")
    )
    entries = _entries(sets)
    shared = entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = shared.select("key", F.ceil(F.col("n") / BLOCK_ROWS).alias("blocks"))
    buckets = entries.join(shared, "key").join(sets.select("set", "signature"), "set")
    near = by_group(in_blocks(buckets, "key", "set", "blocks"), ["key", "left", "right"], ["set", "signature"], _compare_signatures, "a long, b long")
    groups = components(near, f"{folder}/near").select(F.col("node").alias("set"), F.col("root").alias("group"))
    groups.write.parquet(f"{folder}/groups")
    groups = spark.read.parquet(f"{folder}/groups").join(sets.select("set", "n_shingles", "row"), "set")
    count = groups.groupBy("group").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("items"))
    count = count.select("group", F.ceil(F.greatest(F.col("n") / BLOCK_ROWS, F.col("items") / BLOCK_ITEMS)).alias("blocks"))
    wanted = groups.join(count, "group").select("row", "set", "group", "blocks")
    texts = docs.select(names.row_key(docs).alias("row"), "text").join(wanted, "row")

    def shingles(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row, end, data, offsets in text_slices(batch.column(0)):
            hashes, of = shingle_sets(data, offsets, size)
            blobs = pa.array([hashes[a:b].tobytes() for a, b in zip(of[:-1], of[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(row, end - row) for i in (1, 2, 3)), blobs], ["set", "group", "blocks", "shingles"])

    full = map_batches(texts.select("text", "set", "group", "blocks"), shingles, "set long, group long, blocks long, shingles binary")
    links = by_group(in_blocks(full, "group", "set", "blocks"), ["group", "left", "right"], ["set", "own", "shingles"], _compare_sets(percent), "a long, b long")
    roots = components(links, f"{folder}/links")
    return rows, roots.select(F.col("node").alias("set"), "root")


def near_duplicates(docs: DataFrame, folder: str, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, row, n_shingles, component, component_id (smallest doc_id connected with it) of each row of documents.

    Linked: 100 * common shingles >= percent * all shingles of both.
    Tables between the steps are written under ``folder``, which all executors share."""
    rows, roots = linked_sets(docs, folder, size, percent)
    rows = rows.join(roots, "set", "left").withColumn("component", F.coalesce("root", "set"))
    least = rows.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return rows.join(least, "component", "left").select(
        "doc_id", "row", "n_shingles", "component", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def drop_near_duplicates(docs: DataFrame, folder: str, size: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component, that with the smallest doc_id, with all columns. Texts without words stay.

    Of rows with equal doc_id and text one stays, that whose other columns come first as JSON."""
    found = near_duplicates(docs, folder, size, percent)
    first = found.where("component IS NOT NULL").groupBy("component").agg(F.min_by("row", F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("row"))
    stay = first.select("row").union(found.where("component IS NULL").select("row")).distinct()
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    order = F.to_json(F.struct(*[docs[c] for c in others])) if others else F.lit("")
    whole = docs.select(names.row_key(docs).alias("row"), order.alias("order"), F.struct("*").alias("doc"))
    return whole.join(stay, "row", "left_semi").groupBy("row").agg(F.min_by("doc", "order").alias("doc")).select("doc.*")
