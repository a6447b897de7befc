"""A Bloom filter of keys, as a column test on rows that are dear to read or to move."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 12
LEAST_BITS, MOST_BITS = 1 << 12, 1 << 26  # the largest filter has 8 MB
HASHES = 4


def filter_bits(n_keys: int) -> int:
    """Bits for so many keys: a power of two, MOST_BITS at most. Beyond, more rows pass that have no match."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_PER_KEY * max(1, n_keys) - 1).bit_length()))


def _places(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(HASHES)]


def bloom_filter(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """One row with the filter as an array of 64-bit words.

    Tasks combine the bits of a word before the shuffle; the list has bits / 64 words, however many keys there are.
    """
    place = keys.where(F.col(key).isNotNull()).select(F.explode(F.array(*_places(F.col(key), bits))).alias("place"))
    words = place.select(F.shiftright("place", 6).alias("word"), F.expr("shiftleft(1L, CAST(place & 63 AS INT))").alias("bits"))
    empty = keys.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    dense = words.union(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    listed = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return dense.agg(F.transform(listed, lambda w: w["bits"]).alias("filter"))


def may_be_among(column: str, keys: DataFrame, key: str, n_keys: int) -> Column:
    """False only for values that are not among the keys; about one in 200 of the others passes too. A null is never among them.

    The filter is a scalar subquery: it is computed once and goes to the tasks with the plan, so nothing is shuffled."""
    bits = filter_bits(n_keys)
    words = bloom_filter(keys, key, bits).scalar()
    tests = [F.getbit(F.get(words, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1 for p in _places(F.col(column), bits)]
    return reduce(and_, tests, F.col(column).isNotNull())
