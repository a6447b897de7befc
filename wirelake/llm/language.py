"""Language identification by rank-order n-gram profiles.

A profile lists the most frequent n-grams (one to three letters, with word edges) of a language in order of frequency. A
document goes to the language whose profile has its own most frequent n-grams in the most similar order: the distance is
the sum of how far each is out of place, and ``profile`` for one that the profile lacks.

Defined results: a null text, or one without a letter, is ``und`` with score 0, as is any text where nothing could be
learned; of equally near languages the first by name wins; n-grams of equal frequency are in code point order; a null
doc_id is neither held out nor learned from; repeated rows count each time; texts are counted whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wirelake.llm.arrays import map_batches, text_slices

MOST_LANGUAGES = 1000
#: Marks in the highest letter, above all code points, that keep n-grams of different lengths apart.
_SINGLE, _PAIR = 0x1FFFFF << 42, 0x1FFFFE << 42


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-case letter of each code point; 0 where it is no letter."""
    table = np.zeros(0x110000, np.int64)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """n-grams of each text as numbers of 21 bits a letter; 0 stands for the edge of a word."""
    codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    places = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=places[1:])
    letters = _letters()[codes]
    for a, b in zip(places[offsets[:-1]], places[offsets[1:]], strict=True):
        own = letters[a:b]
        if not own.any():
            yield np.zeros(0, np.int64)
            continue
        edged = np.concatenate(([0], own, [0]))
        # a pair has a letter, a triple has one in its middle; a single letter counts as one without neighbours (all ones)
        two = (edged[:-1] << 21) | edged[1:] | _PAIR
        three = (edged[:-2] << 42) | (edged[1:-1] << 21) | edged[2:]
        yield np.concatenate([own[own > 0] | _SINGLE, two[two != _PAIR], three[edged[1:-1] > 0]])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn_profiles(docs: DataFrame, profile: int = 400) -> DataFrame:
    """lang, gram, place (from 0) of the ``profile`` most frequent n-grams of each language in docs (lang, text)."""

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row, end, data, offsets in text_slices(batch.column(1)):
            by_lang: dict[str, list[np.ndarray]] = {}
            for lang, own in zip(batch.column(0).slice(row, end - row).to_pylist(), grams(data, offsets), strict=True):
                by_lang.setdefault(lang, []).append(own)
            for lang, parts in by_lang.items():
                gram, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram), pa.array(n)], ["lang", "gram", "n"])

    counted = map_batches(docs.select("lang", "text"), count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    # the bare row number, for which Spark keeps ``profile`` rows of a language in each task before it sorts them together
    return counted.withColumn("place", place).where(F.col("place") <= profile).withColumn("place", F.col("place") - 1).drop("n")


class Profiles:
    """Places of n-grams in the profile of each language."""

    def __init__(self, rows: list[tuple[str, int, int]], profile: int):
        self.langs = sorted({lang for lang, _, _ in rows})
        self.size = profile
        self.grams = np.unique(np.array([gram for _, gram, _ in rows], np.int64))
        at = {lang: i for i, lang in enumerate(self.langs)}
        self.places = np.full((len(self.langs), len(self.grams) + 1), -1, np.int32)
        for lang, gram, place in rows:
            self.places[at[lang], np.searchsorted(self.grams, gram)] = place

    def nearest(self, own: np.ndarray) -> tuple[str, float]:
        if not len(own) or not self.langs:
            return "und", 0.0
        gram, n = np.unique(own, return_counts=True)
        top = gram[np.argsort(-n, kind="stable")[: self.size]]
        at = np.searchsorted(self.grams, top)
        at[self.grams[np.minimum(at, len(self.grams) - 1)] != top] = len(self.grams)
        places = self.places[:, at]
        away = np.where(places < 0, self.size, np.abs(places - np.arange(len(top))[None, :])).sum(axis=1)
        best = int(np.argmin(away))
        return self.langs[best], 1.0 - float(away[best]) / (self.size * len(top))


def identify(docs: DataFrame, profile: int = 400) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each document; learned from the rows that are not held out.

    The profiles are ``profile`` rows for each language, of which there may be MOST_LANGUAGES."""
    known = docs.select("lang", "text", "doc_id").where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    rows = learn_profiles(known, profile).limit(MOST_LANGUAGES * profile + 1).collect()
    if len(rows) > MOST_LANGUAGES * profile:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    profiles = Profiles([(row["lang"], row["gram"], row["place"]) for row in rows], profile)

    def predict(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row, end, data, offsets in text_slices(batch.column(2)):
            found = [profiles.nearest(own) for own in grams(data, offsets)]
            ids, held = (batch.column(i).slice(row, end - row) for i in (0, 1))
            langs, scores = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([ids, held, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows_in = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return map_batches(rows_in, predict, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
