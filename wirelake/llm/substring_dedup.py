"""Removal of word sequences that occur more than once in the corpus, with an FM-index per shard.

Every window of ``size`` words is named by the least hash of its short word runs (its anchor). Equal windows have equal
anchors, so a window whose anchor occurs once is not repeated. Successive windows with one anchor form a segment. Segments
whose anchors recur go to the shard of their anchor; all copies of a window meet there, and nothing else does. A shard is
read in parts of bounded size, cut between anchors. Each part is indexed (distinct segments only), and its segments are
streamed through the index: where the matching statistic reaches ``size``, a window occurs at another place. A segment that
itself comes more than once needs no search. The spans found go back to their documents.

Hot groups: anchors are counted before their rows are joined, so a frequent one is an ordinary skewed join key. Shards get
each distinct segment of a batch once, with its number of copies and without their places, and collapse equal ones as they
read; the spans found are joined back to the places by the segment's name, again a skewed join key. An anchor with more
rows than PART_ROWS, which near copies of one text may give it, is not kept together: its segments are cut into single
windows, each of which is an anchor of its own.

Defined results: a null or empty text has no words; texts with fewer than ``size`` words lose nothing; repeated rows, also
of one doc_id, are documents of their own and lose all that they share; windows overlap freely, also with themselves; texts
are read whole; words are compared by a 64-bit hash, rows by 96 bits; columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wirelake.llm import rows as names
from wirelake.llm.arrays import Spans, Words, covered, find_words, joined, map_batches, map_in_tasks, mix, ranges, spaced, text_slices
from wirelake.llm.fm_index import FMIndex

ANCHOR = 12  # words of a run
SEGMENT = 64  # most windows of a segment
PART_BYTES = 6_000_000  # text of the segments that are indexed together
PART_ROWS = 20_000  # segments of one anchor that are kept together; about as many fill a part
HOT = 128  # mark in the packed place of a segment whose anchor has more
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _sliding(values: np.ndarray, width: int, choose: Callable) -> np.ndarray:
    """Least or largest of each ``width`` values in a row."""
    step = 1
    while 2 * step <= width:
        values = choose(values[:-step], values[step:])
        step *= 2
    rest = width - step
    return choose(values[: len(values) - rest], values[rest:]) if rest else values


def segments(words: np.ndarray, of: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """anchor, text, first window (from 0 in its text), windows and occurrences of the anchor (2: two or more) of each segment."""
    run = min(ANCHOR, size)
    width = size - run + 1
    counts, none = np.diff(of), np.zeros(0, np.int64)
    if len(words) < size:
        return none.astype(np.uint64), none, none, none, none
    hashes = np.zeros(len(words) - run + 1, np.uint64)
    for i in range(run):
        hashes = hashes * _STEP + words[i : len(hashes) + i]
    hashes = mix(hashes) | np.uint64(1)
    least = _sliding(hashes, width, np.minimum)
    text = np.repeat(np.arange(len(counts)), counts)[: len(least)]
    valid = np.arange(len(least)) + size <= of[1:][text]
    # a run is the anchor of a window if it is the least of one that holds it
    shown = np.where(valid, least, np.uint64(0))
    edge = np.zeros(width - 1, np.uint64)
    chosen = np.flatnonzero(_sliding(np.r_[edge, shown, edge], width, np.maximum) == hashes)
    at = np.flatnonzero(valid)
    if not len(at):
        return none.astype(np.uint64), none, none, none, none
    anchor, owner = least[at], text[at]
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])]
    group = np.cumsum(new) - 1
    # the anchors in page order change where the segments do
    home = np.searchsorted(of, chosen, "right") - 1
    change = np.r_[True, (hashes[chosen][1:] != hashes[chosen][:-1]) | (home[1:] != home[:-1])]
    occurs = np.minimum(np.bincount(np.cumsum(change) - 1), 2)
    within = np.arange(len(at)) - np.flatnonzero(new)[group]
    start = np.flatnonzero(new | (within % SEGMENT == 0))
    windows = np.diff(np.r_[start, len(at)])
    return anchor[start], owner[start], at[start] - of[owner[start]], windows, occurs[group[start]]


def _check(docs: DataFrame) -> Column:
    """32 bits beside the key; a full second hash moves more bytes than the disk budget has."""
    return names.second_hash(docs).bitwiseAND(0xFFFFFFFF)


def _keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """key names a row until its segments are found, where a clash of two rows costs work only; key and check name its spans.

    Whole rows are moved by key alone and with all that is needed of them (doc), so that the texts move once for both joins."""
    return docs.select(names.first_hash(docs).alias("key"), _check(docs).alias("check"), F.struct(*columns).alias("doc"))


def _segment_rows(docs: DataFrame, size: int) -> DataFrame:
    """anchor, key, place (first window and number of windows), occurs: the segments of all documents, without their words."""

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        for row, _, data, offsets in text_slices(batch.column(1)):
            found = find_words(data, offsets)
            anchor, text, first, windows, occurs = segments(Spans(data).hash(found.starts, found.ends), found.of, size)
            columns = [anchor.view(np.int64), keys[row + text], (first << 8) | windows, occurs]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor", "key", "place", "occurs"])

    return map_batches(docs.select("key", "doc.text"), cut, "anchor long, key long, place long, occurs long")


def _cut_segments(batch: pa.RecordBatch, size: int) -> Iterator[tuple[np.ndarray, ...]]:
    """anchor, name (hash of its words), row and first word of the segments at the wanted places, and their texts on call.

    batch: doc (with its text), places. A segment of a hot anchor comes as single windows."""
    for row, end, data, offsets in text_slices(pc.struct_field(batch.column(0), "text")):
        found = find_words(data, offsets)
        words = Spans(data).hash(found.starts, found.ends)
        anchor, text, first, windows, _ = segments(words, found.of, size)
        places = batch.column(1).slice(row, end - row)
        wanted = np.concatenate([np.zeros(0, np.int64), places.flatten().to_numpy(zero_copy_only=False)])
        owner = np.repeat(np.arange(end - row), places.value_lengths().to_numpy(zero_copy_only=False))
        # a segment is known by its text and its place, as it was when it was counted
        mine, place = _pair(text, (first << 8) | windows), _pair(owner, wanted & ~HOT)
        hot = np.isin(mine, place[wanted & HOT > 0])
        parts = np.where(hot, windows, 1)[keep := np.isin(mine, place)]
        anchor, text, first, windows, hot = (np.repeat(v[keep], parts) for v in (anchor, text, first, windows, hot))
        first = first + ranges(np.zeros(len(parts), np.int64), parts)
        a = found.of[text] + first
        b = a + np.where(hot, 1, windows) + size - 1
        name = _Sequence(words).hash(a, b)

        def texts(which: np.ndarray, data=data, found=found, a=a, b=b) -> list[bytes]:
            whole, at = spaced(data, found, np.ones(len(found.starts), bool))
            return [whole[i : j - 1] for i, j in zip(at[a[which]], at[b[which]], strict=True)]

        yield np.where(hot, name, anchor).view(np.int64), name.view(np.int64), row + text, first, texts


def _segment_texts(rows: DataFrame, size: int) -> DataFrame:
    """anchor, name, segment (its words) and copies: the distinct segments of each batch."""

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for anchor, name, _, _, texts in _cut_segments(batch, size):
            _, one, copies = np.unique(name, return_index=True, return_counts=True)
            columns = [pa.array(anchor[one]), pa.array(name[one]), pa.array(texts(one), pa.binary()).cast(pa.string()), pa.array(copies)]
            yield pa.RecordBatch.from_arrays(columns, ["anchor", "name", "segment", "copies"])

    return map_batches(rows, cut, "anchor long, name long, segment string, copies long")


def _segment_places(rows: DataFrame, size: int) -> DataFrame:
    """name, key, check, start: where the segments are."""

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for _, name, row, first, _ in _cut_segments(batch, size):
            columns = [pa.array(name), batch.column(2).take(pa.array(row)), batch.column(3).take(pa.array(row)), pa.array(first)]
            yield pa.RecordBatch.from_arrays(columns, ["name", "key", "check", "start"])

    return map_batches(rows, cut, "name long, key long, check long, start long")


def _pair(text: np.ndarray, place: np.ndarray) -> np.ndarray:
    return mix(text.astype(np.uint64) * _STEP + place.astype(np.uint64))


class _Sequence:
    """Hashes of ranges of word hashes."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        up, down = np.full(n + 1, _STEP), np.full(n + 1, pow(int(_STEP), -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(words * np.cumprod(up)[:n], out=self.sums[1:])
        self.down = np.cumprod(down)

    def hash(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self.sums[b] - self.sums[a]) * self.down[a] + (b - a).astype(np.uint64))


def _search(table: pa.Table, size: int) -> Iterator[pa.RecordBatch]:
    """name, first, last: the repeated words of the distinct segments of a part of a shard (name, segment, copies)."""
    data, offsets = _buffer(table.column("segment"))
    found = find_words(data, offsets)
    words = Spans(data).hash(found.starts, found.ends)
    several = table.column("copies").to_numpy() > 1
    length, begin = found.counts, found.of
    _, number = np.unique(words, return_inverse=True)
    repeated = np.repeat(several, length)
    if not several.all():
        number = number + 1
        index = FMIndex(number, begin)
        single = np.flatnonzero(~several)
        own = ranges(begin[single], length[single])
        reach = index.matching_statistics(number[own], np.r_[0, np.cumsum(length[single])])
        repeated[own] = reach >= size
    repeated &= np.arange(len(number)) + size <= np.repeat(begin[1:], length)  # a window starts here and is repeated
    change = np.diff(np.r_[False, repeated, False].astype(np.int8))
    start, stop = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    home = np.searchsorted(begin, start, "right") - 1  # the segment; its last window starts before its end
    spans = [pa.array(start - begin[home], pa.int64()), pa.array(stop - begin[home] + size - 1, pa.int64())]
    yield pa.RecordBatch.from_arrays([table.column("name").combine_chunks().take(pa.array(home)), *spans], ["name", "first", "last"])


def _buffer(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    return next(((data, offsets) for _, _, data, offsets in text_slices(column.combine_chunks(), 1 << 62)), (np.zeros(0, np.uint8), np.zeros(1, np.int64)))


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor and name, each name once with all its copies."""
    last: pa.RecordBatch | None = None  # the last name may go on in the next batch
    for batch in batches:
        if not batch.num_rows:
            continue
        if last is not None:
            batch = pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
        anchors, found = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "name"))
        first = np.flatnonzero(np.r_[True, (found[1:] != found[:-1]) | (anchors[1:] != anchors[:-1])])
        copies = np.add.reduceat(batch.column("copies").to_numpy(zero_copy_only=False), first)
        batch = batch.take(pa.array(first)).set_column(3, "copies", pa.array(copies))
        last = batch.slice(batch.num_rows - 1)
        if batch.num_rows > 1:
            yield batch.slice(0, batch.num_rows - 1)
    if last is not None:
        yield last


def _shards(rows: DataFrame, size: int) -> DataFrame:
    """Searches each shard in parts that end between two anchors."""
    placed = rows.repartition("anchor").sortWithinPartitions("anchor", "name")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        weight = 0
        for batch in _collapsed(batches):
            anchors = batch.column(0).to_numpy(zero_copy_only=False)
            cuts = np.r_[0, np.flatnonzero(anchors[1:] != anchors[:-1]) + 1]
            total = np.r_[0, np.cumsum(pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False))]
            begin = 0
            for a in cuts:
                fresh = a > 0 or not held or held[-1].column(0)[-1].as_py() != anchors[0]
                if fresh and weight + total[a] - total[begin] >= PART_BYTES:
                    if a > begin:
                        held.append(batch.slice(begin, a - begin))
                    yield from _search(pa.Table.from_batches(held), size)
                    held, weight, begin = [], 0, a
            held.append(batch.slice(begin))
            weight += int(total[-1] - total[begin])
        if held:
            yield from _search(pa.Table.from_batches(held), size)

    return map_in_tasks(placed, run, "name long, first long, last long")


def repeated_spans(docs: DataFrame, size: int) -> DataFrame:
    """key and spans (check; first word and end) of the documents (key, check, doc with its text) with repeated windows."""
    rows = _segment_rows(docs, size)
    recurring = rows.groupBy("anchor").agg(F.sum("occurs").alias("n")).where("n > 1")
    mark = F.when(F.col("n") > PART_ROWS, HOT).otherwise(0)
    places = rows.select("anchor", "key", "place").join(recurring, "anchor").select("key", F.col("place").bitwiseOR(mark).alias("place"))
    texts = docs.join(places.groupBy("key").agg(F.collect_set("place").alias("places")), "key").select("doc", "places", "key", "check")
    spans = _shards(_segment_texts(texts, size), size)
    found = _segment_places(texts, size).join(spans, "name")
    span = F.array(F.col("start") + F.col("first"), F.col("start") + F.col("last"))
    return found.groupBy("key").agg(F.collect_set(F.struct("check", span.alias("span"))).alias("found"))


def _with_spans(keyed: DataFrame, size: int) -> DataFrame:
    """doc and spans (first word, end; as a flat list) of each document."""
    own = F.filter("found", lambda f: f["check"] == F.col("check"))
    return keyed.join(repeated_spans(keyed, size), "key", "left").select("doc", F.flatten(F.transform(own, lambda f: f["span"])).alias("spans"))


def _removed(places: pa.Array, found: Words) -> np.ndarray:
    """Which words of a slice lie in one of the spans of their text."""
    flat = places.flatten().to_numpy(zero_copy_only=False)
    lengths = places.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    base = np.repeat(found.of[:-1], lengths // 2)
    return covered(len(found.starts), base + flat[0::2], base + flat[1::2])


def remove_repeats(docs: DataFrame, size: int = 35) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (words that stay, joined by a space) of each document."""

    def remove(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, texts = (pc.struct_field(batch.column(0), name) for name in ("doc_id", "text"))
        for row, end, data, offsets in text_slices(texts):
            found = find_words(data, offsets)
            gone = _removed(batch.column(1).slice(row, end - row), found)
            kept = joined(data, found, ~gone)
            lost = np.r_[0, np.cumsum(gone)]
            columns = [ids.slice(row, end - row), pa.array(found.counts, pa.int64()), pa.array(lost[found.of[1:]] - lost[found.of[:-1]], pa.int64())]
            digests = pa.array([hashlib.sha256(text).hexdigest() for text in kept])
            yield pa.RecordBatch.from_arrays([*columns, pa.array(kept, pa.binary()).cast(pa.string()), digests], ["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(_with_spans(_keyed(docs, "doc_id", "text"), size), remove, f"doc_id {kind}, n_words long, n_removed long, kept_text string, kept_sha256 string")


def cut_repeats(docs: DataFrame, size: int = 35) -> DataFrame:
    """All columns and rows of documents, with the repeated words cut out of ``text``, and ``n_chars``, if there, its new length.

    What stays keeps its white space; a text without repeated words is not changed."""
    columns = docs.columns
    at = columns.index("text")

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        whole = batch.column(0).flatten()
        texts, lengths = [], []
        for row, end, data, offsets in text_slices(whole[at]):
            found = find_words(data, offsets)
            gone = _removed(batch.column(1).slice(row, end - row), found)
            last = np.repeat(offsets[1:], found.counts)
            until = np.minimum(np.r_[found.starts[1:], len(data)], last)  # a word goes with the white space after it
            stays = ~covered(len(data), found.starts[gone], until[gone])
            cuts = np.r_[0, np.cumsum(stays)][offsets]
            left = data[stays]
            characters = np.r_[0, np.cumsum((left & 0xC0) != 0x80)]
            lengths.append(characters[cuts[1:]] - characters[cuts[:-1]])
            kept = left.tobytes()
            texts += [kept[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        new = {"text": pa.array(texts, pa.binary(), mask=whole[at].is_null().to_numpy(zero_copy_only=False)).cast(pa.string())}
        if "n_chars" in columns:
            old = whole[columns.index("n_chars")]
            new["n_chars"] = pc.if_else(whole[at].is_null(), old, pa.array(np.concatenate([np.zeros(0, np.int64), *lengths])).cast(old.type))
        yield pa.RecordBatch.from_arrays([new.get(name, whole[i]) for i, name in enumerate(columns)], columns)

    return map_batches(_with_spans(_keyed(docs, "*"), size), cut, docs.schema)
