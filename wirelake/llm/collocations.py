"""Phrases whose words occur together, from Rabin-Karp fingerprints of every n-gram.

Texts are first stored in slices: the lower-cased texts of one language, about ``slice_bytes`` of them, a line end between two
(a line end ends a phrase anyway). Each slice is hashed at once: prefix polynomials give the 64-bit fingerprint of every
n-gram of a slice, and a second polynomial a check of 16 bits more. A slice counts its own n-grams, comparing the check of
every occurrence, and sends one block per bucket of fingerprints: sorted fingerprints as differences, checks, counts, and the
place of one occurrence, in byte planes, so that a block takes about twelve bytes an n-gram. A bucket adds up the counts of
equal fingerprint and check; what is below ``least`` goes. The phrases that stay get their words from the places, by one join
with the slices: the words at the first and at the last place of each fingerprint are compared, and unlike ones are an error
(two phrases would have to agree in all 80 bits).

Spread: the number of buckets follows the stored bytes (``bucket_bytes`` of text each), and as an n-gram is counted inside its
slice first, a frequent one is as many entries as there are slices. Ranks are cut per task and per part of a language before
they are merged. A block has a million n-grams over the number of buckets; beyond a TB or so, larger slices and buckets
(``slice_bytes``, ``bucket_bytes``; a task takes about 30 bytes of memory for a byte of either) keep blocks worth their rows.

Defined results: a null text is empty; a null lang is ``und``; repeated rows count each; an empty table gives no rows; a text
longer than a slice is a slice of its own; extra columns and doc_id are never read; of cuts with equal scores the one after
the fewest words counts. Sums and products are exact (decimals of 38 digits; counts below 10^16).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wirelake.llm.arrays import Spans, find_words, map_batches, map_in_tasks, mix, text_buffer

SLICE_BYTES = 8_000_000
BUCKET_BYTES = 4_000_000
RANK_PARTS = 16
HASHED_BYTES = 1_000_000
SLICES_PER_GROUP = 4  # of rows of a Parquet row group, which a reader holds whole
UNKNOWN = "und"

_BLANK = np.isin(np.arange(256), [9, 32])
_STOP = np.isin(np.arange(256), [ord(c) for c in ".,;:!?\n\v\f\r"])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = np.uint64(0xD6E8FEB86659FD93)
_CHECK_STEP = np.uint64(0xA0761D6478BD642F)


def text_slices_by_language(docs: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """lang, text of the slices: texts of a language in lower case, each followed by a line end.

    A task holds two slices' worth of bytes at most while it fills the slices of all languages."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}

        def flushed(lang: str) -> pa.RecordBatch:
            size.pop(lang)
            return pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([b"".join(held.pop(lang))], pa.binary())], ["lang", "text"])

        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            whole = _LOWER[data].tobytes()
            for row, lang in enumerate(batch.column(0).to_pylist()):
                text = whole[offsets[row] : offsets[row + 1]]
                if lang in held and size[lang] + len(text) > slice_bytes:
                    yield flushed(lang)
                held.setdefault(lang, []).extend((text, b"\n"))
                size[lang] = size.get(lang, 0) + len(text) + 1
                if sum(size.values()) > 2 * slice_bytes:
                    yield flushed(max(size, key=size.__getitem__))
        for lang in sorted(held):
            yield flushed(lang)

    rows = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    return map_in_tasks(rows, cut, "lang string, text binary")


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent fingerprints of each word, HASHED_BYTES of text at a time."""
    keys, checks = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + HASHED_BYTES)))
        base, part = starts[a], data[starts[a] : ends[b - 1]]
        keys[a:b] = Spans(part).hash(starts[a:b] - base, ends[a:b] - base)
        checks[a:b] = mix(keys[a:b] * _CHECK_STEP ^ Spans(~part).hash(starts[a:b] - base, ends[a:b] - base))
        a = b
    return keys, checks


class Grams:
    """Fingerprints of the n-grams of a slice; an n-gram lies within one piece."""

    def __init__(self, data: np.ndarray):
        words = find_words(data, np.array([0, len(data)]), _BLANK | _STOP)
        starts, ends = words.starts, words.ends
        stops = np.zeros(len(data) + 1, np.int32)
        np.cumsum(_STOP[data], out=stops[1:])
        #: words that follow each word in its piece without a stop
        self.joined = stops[starts[1:]] == stops[ends[:-1]]
        self.starts = starts.astype(np.uint32)
        self.one = self.keys, self.checks = word_hashes(data, starts, ends)
        self.valid = np.ones(len(starts), bool)
        self.size = 1

    def grow(self) -> None:
        """From n-grams to those of one word more: hash * step + next word, at all places at once."""
        n = self.size
        self.keys = self.keys[:-1] * _STEP + self.one[0][n:]
        self.checks = self.checks[:-1] * _CHECK_STEP + self.one[1][n:]
        self.valid = self.valid[:-1] & self.joined[n - 1 :]
        self.size += 1

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start of each n-gram, fingerprint and check."""
        at = np.flatnonzero(self.valid)
        return self.starts[at], mix(self.keys[at]), (mix(self.checks[at]) >> np.uint64(48)).astype(np.uint16)


def grouped(keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by fingerprint and check, and where each new pair begins."""
    order = np.argsort(keys, kind="stable")
    k, c = keys[order], checks[order]
    if len(k) and bool(((k[1:] == k[:-1]) & (c[1:] != c[:-1])).any()):
        order = np.lexsort((checks, keys))
        k, c = keys[order], checks[order]
    return order, np.flatnonzero(np.r_[np.ones(min(len(k), 1), bool), (k[1:] != k[:-1]) | (c[1:] != c[:-1])])


def planes(values: np.ndarray) -> bytes:
    """All first bytes of the values, then all second ones, and so on: equal high bytes compress to nothing."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def from_planes(stored: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(stored, np.uint8).reshape(width, -1).T).view(kind).ravel()


BLOCK = "bucket long, lang string, n int, slice long, keys binary, checks binary, counts binary, places binary"


def blocks(slices: DataFrame, buckets: int, longest: int) -> DataFrame:
    """The n-grams of each slice of (slice, lang, text), counted, in blocks by bucket of their fingerprints."""
    # buckets (two at least) are ranges of the fingerprint, so a sorted list falls into them as it is
    width = np.uint64((1 << 64) // buckets + 1)

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row in range(batch.num_rows):
            name, lang = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
            grams = Grams(np.frombuffer(batch.column(2)[row].as_buffer(), np.uint8))
            for n in range(1, longest + 1):
                if n > 1:
                    if len(grams.keys) < 2:
                        break
                    grams.grow()
                starts, keys, checks = grams.entries()
                order, new = grouped(keys, checks)
                if not len(new):
                    continue
                counts = np.diff(np.r_[new, len(order)]).astype(np.uint32)
                first = order[new]
                keys, checks, places = keys[first], checks[first], starts[first]
                del order, starts, first
                bucket = (keys // width).astype(np.int64)
                cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
                rows: list[list] = [[] for _ in range(8)]
                for a, b in zip(cuts, np.r_[cuts[1:], len(keys)], strict=True):
                    base = np.uint64(bucket[a]) * width
                    block = [int(bucket[a]), lang, n, name, planes(np.diff(keys[a:b], prepend=base)), planes(checks[a:b]), planes(counts[a:b]), planes(places[a:b])]
                    for column, value in zip(rows, block, strict=True):
                        column.append(value)
                kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), *[pa.binary()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], [f.split()[0] for f in BLOCK.split(", ")])

    return map_batches(slices.select("slice", "lang", "text"), count, BLOCK)


FOUND = "lang string, n int, key long, check int, total long, slice long, place long, words long"


def frequent(blocked: DataFrame, buckets: int, least: int) -> DataFrame:
    """The n-grams that occur ``least`` times or more, with the place of an occurrence in their first and their last slice.

    ``words`` is set in rows of their own (n = 0): all word occurrences of the bucket."""
    width = np.uint64((1 << 64) // buckets + 1)

    def add(table: pa.Table) -> pa.Table:
        bucket = np.uint64(table["bucket"][0].as_py())
        langs, sizes, stored = table["lang"].to_pylist(), table["n"].to_pylist(), table["slice"].to_pylist()
        groups: dict[tuple[str, int], list[int]] = {}
        for row, key in enumerate(zip(langs, sizes, strict=True)):
            groups.setdefault(key, []).append(row)
        out = []
        for (lang, n), rows in sorted(groups.items()):
            rows.sort(key=lambda r: stored[r])
            part = [[from_planes(table[c][r].as_py(), kind) for r in rows] for c, kind in (("keys", np.uint64), ("checks", np.uint16), ("counts", np.uint32), ("places", np.uint32))]
            keys = np.concatenate([np.cumsum(k, dtype=np.uint64) + bucket * width for k in part[0]])
            of = np.repeat([stored[r] for r in rows], [len(k) for k in part[0]])
            checks, counts, places = (np.concatenate(p) for p in part[1:])
            order, new = grouped(keys, checks)
            totals = np.add.reduceat(counts[order].astype(np.int64), new)
            often = np.flatnonzero(totals >= least)
            if n == 1:
                out.append(([lang], [0], [None], [None], [None], [None], [None], [int(totals.sum())]))
            first, last = new[often], np.r_[new[1:], len(order)][often] - 1
            for group, at in ((often, order[first]), (often[last > first], order[last[last > first]])):
                size = len(at)
                out.append(([lang] * size, [n] * size, keys[at].view(np.int64), checks[at], totals[group], of[at], places[at], [None] * size))
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.int32(), *[pa.int64()] * 4]
        columns = [pa.concat_arrays([pa.array(o[i], kind) for o in out]) for i, kind in enumerate(kinds)]
        return pa.Table.from_arrays(columns, [f.split()[0] for f in FOUND.split(", ")])

    return blocked.groupBy("bucket").applyInArrow(add, FOUND)


READ = "lang string, n int, key long, check int, total long, phrase string"


def materialise(found: DataFrame, slices: DataFrame) -> DataFrame:
    """lang, n, phrase, total of the n-grams found; words come from the places, with one space between two."""
    wanted = found.where("n > 0").groupBy("slice").agg(F.collect_list(F.struct("place", "n", "key", "check", "total")).alias("wanted"))

    def read(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row in range(batch.num_rows):
            text, wanted = batch.column(1)[row].as_buffer(), batch.column(2)[row].values
            words = find_words(np.frombuffer(text, np.uint8), np.array([0, len(text)]), _BLANK | _STOP)
            place, n, *rest = (wanted.field(i) for i in range(5))
            first = np.searchsorted(words.starts, place.to_numpy())
            whole = text.to_pybytes()
            phrases = [
                b" ".join([whole[a:b] for a, b in zip(words.starts[f : f + k].tolist(), words.ends[f : f + k].tolist(), strict=True)])
                for f, k in zip(first.tolist(), n.to_pylist(), strict=True)
            ]
            lang = pa.array([batch.column(0)[row].as_py()] * len(phrases), pa.string())
            yield pa.RecordBatch.from_arrays([lang, n, *rest, pa.array(phrases, pa.binary()).cast(pa.string())], [f.split()[0] for f in READ.split(", ")])

    rows = slices.join(wanted, "slice").select("lang", "text", "wanted")
    each = map_batches(rows, read, READ).groupBy("lang", "n", "key", "check").agg(
        F.max("total").alias("total"), F.min("phrase").alias("phrase"), F.max("phrase").alias("other"))
    unlike = F.raise_error(F.concat(F.lit("equal fingerprints of unlike phrases: "), "phrase", F.lit(" and "), "other"))
    return each.select("lang", "n", F.when(F.col("phrase") == F.col("other"), F.col("phrase")).otherwise(unlike.cast("string")).alias("phrase"), "total")


def _part(first: int, size: int) -> Column:
    return F.array_join(F.slice("w", first, size), " ")


def cuts(phrases: DataFrame, longest: int) -> DataFrame:
    """lang, phrase, n, a and the lowest-scoring cut (l, r, score) of the phrases of two words or more."""
    split = phrases.where("n > 1").select("lang", "phrase", "n", F.col("total").alias("a"), F.split("phrase", " ").alias("w"))
    pieces = split.select("lang", "phrase", "n", "a", "w", F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"))
    sides = pieces.select("lang", "phrase", "n", "a", "k", F.explode(F.array(
        F.struct(F.lit(True).alias("left"), _part(1, F.col("k")).alias("part")),
        F.struct(F.lit(False).alias("left"), _part(F.col("k") + 1, F.col("n") - F.col("k")).alias("part")),
    )).alias("side")).select("lang", "phrase", "n", "a", "k", "side.left", "side.part")
    known = phrases.select("lang", F.col("phrase").alias("part"), "total")
    both = sides.join(known, ["lang", "part"]).groupBy("lang", "phrase", "k").agg(
        F.first("n").alias("n"), F.first("a").alias("a"), F.max(F.when(F.col("left"), F.col("total"))).alias("l"),
        F.max(F.when(~F.col("left"), F.col("total"))).alias("r"))
    a, l, r = (F.col(c).cast("decimal(16,0)") for c in "alr")
    exact = both.withColumn("above", (F.lit(1000000).cast("decimal(7,0)") * (a * a)).cast("decimal(38,0)")).withColumn("below", (l * r).cast("decimal(32,0)"))
    scored = exact.withColumn("score", F.expr("above div below"))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "n", "a", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "cut.n", "cut.a", "cut.l", "cut.r", "cut.score")


def without_inner(candidates: DataFrame, longest: int, percent: int) -> DataFrame:
    """Candidates that are not mostly part of a longer one: 100 * f(longer) >= percent * a."""
    long = candidates.where("n > 2").select("lang", F.col("a").alias("longer"), "n", F.split("phrase", " ").alias("w"))
    lengths = long.select("lang", "longer", "n", "w", F.explode(F.sequence(F.lit(2), F.col("n") - 1)).alias("m"))
    inner = lengths.select("lang", "longer", F.explode(F.transform(
        F.sequence(F.lit(1), F.col("n") - F.col("m") + 1), lambda i: F.array_join(F.slice("w", i, F.col("m")), " "))).alias("phrase"))
    most = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a"))
    return candidates.join(most, ["lang", "phrase"], "left").where(kept).drop("longer")


def collocations(
    docs: DataFrame, folder: str, longest: int = 3, least: int = 10, percent: int = 50, top: int = 2000,
    slice_bytes: int = SLICE_BYTES, bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of 2 to ``longest`` words of each language.

    ``folder`` is a shared one for the slices and the phrases found."""
    spark = docs.sparkSession
    stored = text_slices_by_language(docs, slice_bytes).select(F.monotonically_increasing_id().alias("slice"), "lang", "text")
    stored.write.option("compression", "zstd").option("parquet.block.row.count.limit", SLICES_PER_GROUP).parquet(f"{folder}/slices")
    slices = spark.read.parquet(f"{folder}/slices")
    buckets = 2 + (slices.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // bucket_bytes
    frequent(blocks(slices, buckets, longest), buckets, least).write.parquet(f"{folder}/found")
    found = spark.read.parquet(f"{folder}/found")
    materialise(found, slices).write.parquet(f"{folder}/phrases")
    phrases = spark.read.parquet(f"{folder}/phrases")
    words = found.where("n = 0").groupBy("lang").agg(F.sum("words").alias("all_words"))
    ranked = without_inner(cuts(phrases, longest), longest, percent)
    by = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # first the best of each of RANK_PARTS parts of a language, so that no task gets the best of all tasks
    first = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))).orderBy(*by)
    some = ranked.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by))).where(F.col("rank") <= top)
    return best.join(words, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("all_words").alias("n"), "score")
