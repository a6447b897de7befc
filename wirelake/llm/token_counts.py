"""Token counts of texts from counts of their distinct pre-tokens; no token ids are kept.

A byte-level BPE never merges across pre-tokens, so the tokens of a text are the sum of those of its pre-tokens. Each task
counts the pre-tokens of every document, has the tokenizer library count the pieces of each distinct pre-token once, and
joins the two by pre-token. A join over all tasks would shuffle one row for each document and pre-token, more bytes than
the texts have, so each Python worker keeps its own table, emptied when it holds ``TABLE_ROWS`` pre-tokens.

Defined results: a null text counts as empty, with 0 bytes and 0 tokens; repeated rows are counted one by one; texts are
never cut; special strings inside a text are one token, which is the library's default.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from wirelake.llm.arrays import map_batches, text_slices

#: The byte-level pre-tokenizer's pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
TABLE_ROWS = 500_000


class PieceCounts(dict):
    """Pieces by pre-token, counted by the library at first use."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.pattern = regex.compile(PATTERN)
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None

    def frequencies(self, text: str) -> Counter[str]:
        """Pre-tokens of a text; a special string is a pre-token of its own."""
        if self.special is None or not self.special.search(text):
            return Counter(self.pattern.findall(text))
        total: Counter[str] = Counter(self.special.findall(text))
        for part in self.special.split(text):
            total.update(self.pattern.findall(part))
        return total

    def totals(self, texts: list[str]) -> list[int]:
        by_text = [self.frequencies(text) for text in texts]
        if len(self) > TABLE_ROWS:
            self.clear()
        new = list(set().union(*by_text).difference(self))
        if new:
            self.update(zip(new, map(len, self.library.encode_batch_fast(new, add_special_tokens=False)), strict=True))
        return [sum(self[piece] * n for piece, n in counts.items()) for counts in by_text]


@lru_cache(maxsize=1)
def piece_counts(path: str) -> PieceCounts:
    return PieceCounts(path)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether the document has more than ``limit`` tokens.

    tokenizer: a byte-level BPE file of the tokenizers library that every executor can open."""

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        table = piece_counts(tokenizer)
        for row, end, data, offsets in text_slices(batch.column(1)):
            whole = data.tobytes()
            tokens = table.totals([whole[a:b].decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
            n = np.array(tokens, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(row, end - row), pa.array(np.diff(offsets)), pa.array(n), pa.array(n > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
