"""Quality rules from repeated word sequences, found with a suffix array per text.

All texts of a slice share one suffix array over (text, word): ranks double their length until every suffix differs, and
only suffixes that still tie are sorted again. The longest common prefixes (LCP) of neighbours give, at each word, the
longest sequence that starts there and occurs again in the text. The union of these spans is the union of the spans of
all maximal repeated sequences, because one that can grow to the left lies inside one that starts earlier.

Defined results: a null or empty text has no words and fails the base rule; repeated rows are judged one by one; a text of
any length is one unit, never cut. Columns of the input other than the text don't matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wirelake.llm.arrays import Spans, covered, find_words, map_batches, mix, sums_by, text_slices
from wirelake.llm.suffixes import common_prefixes, sort_suffixes, suffix_array

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


@dataclass(frozen=True)
class Limits:
    """min_words, max_repeat_share: the base rule. A maximal repeat counts from ``min_repeat`` words; texts of which more
    than ``max_covered`` is covered by such repeats, or with one longer than ``max_longest`` words, are rejected."""

    min_words: int = 50
    max_repeat_share: float = 0.5
    min_repeat: int = 8
    max_covered: float = 0.45
    max_longest: int = 100


def repeats(words: np.ndarray, of: np.ndarray) -> np.ndarray:
    """For each word, the length of the longest sequence that starts there and occurs again in the same text.

    words: hashes of the words of all texts; of: first word of each text, and the end.
    """
    text = np.repeat(np.arange(len(of) - 1, dtype=np.uint64), np.diff(of))
    # a word has a key of its own in each text, so that nothing agrees across two texts
    levels = sort_suffixes(mix(words + text * np.uint64(0x9E3779B97F4A7C15)))
    order = suffix_array(levels)
    shared = common_prefixes(levels, order)
    longest = np.zeros(len(words), np.int64)
    longest[order] = np.maximum(shared, np.r_[shared[1:], 0])
    return longest


def text_signals(data: np.ndarray, offsets: np.ndarray, limits: Limits) -> dict[str, np.ndarray]:
    """Counts and verdict of each text of a buffer."""
    found = find_words(data, offsets)
    n = len(found.starts)
    spans = Spans(data)
    longest = repeats(spans.hash(found.starts, found.ends), found.of)

    def in_repeats(least: int) -> np.ndarray:
        at = np.flatnonzero(longest >= least)
        reach = longest[at] if least > 3 else np.full(len(at), 3)
        return covered(n, at, at + reach)

    letters = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=letters[1:])
    counts = found.counts
    repeat = sums_by(in_repeats(3), found.of)
    long = sums_by(in_repeats(limits.min_repeat), found.of)
    top = np.zeros(len(counts), np.int64)
    if n:
        some = np.flatnonzero(counts)
        top[some] = np.maximum.reduceat(longest, found.of[:-1][some])
    base = (counts < limits.min_words) | (repeat > limits.max_repeat_share * counts)
    share = long / np.maximum(counts, 1)
    return {
        "n_words": counts,
        "word_chars": sums_by(letters[found.ends] - letters[found.starts], found.of),
        "n_symbols": sums_by(SYMBOLS[data], offsets),
        "n_dup_lines": _repeated_lines(data, offsets, spans, found.starts),
        "n_repeat_words": repeat,
        "base_failed": base,
        "kept": ~base & (share <= limits.max_covered) & (top <= limits.max_longest),
        "covered_share": share,
        "longest_repeat": top,
    }


def _repeated_lines(data: np.ndarray, offsets: np.ndarray, spans: Spans, word_starts: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of the text."""
    cuts = np.flatnonzero(data == 10)
    starts = np.unique(np.r_[offsets[:-1], cuts + 1])
    starts = starts[starts < len(data)]
    ends = np.r_[starts[1:], len(data)]
    cut = np.isin(ends - 1, cuts, assume_unique=True)
    ends = ends - cut  # without the line break itself
    some = np.searchsorted(word_starts, ends) > np.searchsorted(word_starts, starts)
    starts, ends = starts[some], ends[some]
    text = np.searchsorted(offsets, starts, "right") - 1
    key = spans.hash(starts, ends)
    order = np.lexsort((key, text))
    again = (key[order][1:] == key[order][:-1]) & (text[order][1:] == text[order][:-1])
    return np.bincount(text[order][1:][again], minlength=len(offsets) - 1)


SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, covered_share double, longest_repeat long"
)


def _columns(signals: dict[str, np.ndarray]) -> list[pa.Array]:
    return [pa.array(v, {"b": pa.bool_(), "f": pa.float64()}.get(v.dtype.kind, pa.int64())) for v in signals.values()]


def repetition_signals(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """doc_id with the counts, covered share, longest repeat and verdict of each document."""

    def judge(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row, end, data, offsets in text_slices(batch.column(1)):
            signals = text_signals(data, offsets, limits)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), *_columns(signals)], ["doc_id", *signals])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), judge, f"doc_id {kind}, {SCHEMA}")


def keep_good(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Rows of documents that pass, with all their columns."""

    def judge(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        at = batch.schema.get_field_index("text")
        kept = [text_signals(data, offsets, limits)["kept"] for _, _, data, offsets in text_slices(batch.column(at))]
        yield batch.filter(pa.array(np.concatenate(kept) if kept else np.zeros(0, bool)))

    return map_batches(docs, judge, docs.schema)
