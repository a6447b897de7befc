"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow batch.

Tasks see a text column as one byte buffer. Words, lines and their 64-bit hashes come from whole-array operations, in
slices of bounded size, so that a batch needs a few tens of MB at any length of text.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

SLICE_BYTES = 1_000_000
BATCH_SETTING, DEFAULT_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"  # the default is 64 MB
BATCH_BYTES = 8_000_000

BLANK = np.zeros(256, dtype=bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(20240607).integers(1, 1 << 63, size=256, dtype=np.uint64)
_LOWER = _BYTES.copy()
_LOWER[65:91] = _BYTES[97:123]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


class Spans:
    """Hashes of any byte range of a buffer, in constant time each."""

    def __init__(self, data: np.ndarray, lower: bool = False):
        size = 1 << max(16, int(len(data) + 1).bit_length())
        self.up, self.down = _powers(size)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((_LOWER if lower else _BYTES)[data] * self.up[: len(data)], out=self.sums[1:])

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offsets of each (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string()) if column.type != pa.large_string() else column
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of up to ``most`` bytes (one row at least): first row, end row, bytes, offsets."""
    data, offsets = text_buffer(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


@dataclass
class Words:
    """Words of consecutive texts. ``of``: first word of each text, and the number of words at the end."""

    starts: np.ndarray
    ends: np.ndarray
    of: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.of)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.of) - 1), self.counts)


def find_words(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = BLANK) -> Words:
    """Longest runs of bytes that are not ``blank``, none across two texts."""
    inside = ~blank[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(first)
    return Words(starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets))


def sums_by(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Sum of the values of each text."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[of[1:]] - total[of[:-1]]


def covered(size: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``size`` places lie in one of the ranges at least."""
    edge = np.bincount(starts, minlength=size + 1) - np.bincount(ends, minlength=size + 1)
    return np.cumsum(edge[:size]) > 0


def spaced(data: np.ndarray, words: Words, kept: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Kept words, a space after each, and the place of each word in them, and the end."""
    place = np.zeros(len(kept) + 1, np.int64)
    np.cumsum(np.where(kept, words.ends - words.starts + 1, 0), out=place[1:])
    out = np.full(place[-1], 32, np.uint8)
    length = (words.ends - words.starts)[kept]
    out[ranges(place[:-1][kept], length)] = data[ranges(words.starts[kept], length)]
    return out.tobytes(), place


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length, one after another."""
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())


def joined(data: np.ndarray, words: Words, kept: np.ndarray) -> list[bytes]:
    """Kept words of each text, with one space between them."""
    whole, place = spaced(data, words, kept)
    cut = place[words.of]
    return [whole[a : max(a, b - 1)] for a, b in zip(cut[:-1], cut[1:], strict=True)]


def map_in_tasks(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str) -> DataFrame:
    """``mapInArrow`` with batches of BATCH_BYTES, unless the session has a setting of its own, and without idle memory.

    A Python worker lives on after its task; what its allocators keep is given back after each batch and at the end."""
    spark = df.sparkSession
    if spark.conf.get(BATCH_SETTING, DEFAULT_BATCH) == DEFAULT_BATCH:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def released() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch
                del batch
                release_memory()

        yield from function(released())
        release_memory()

    return df.mapInArrow(run, schema)


def release_memory() -> None:
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: StructType | str) -> DataFrame:
    """Applies ``function`` to each Arrow batch inside the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from function(batch)

    return map_in_tasks(df, run, schema)
