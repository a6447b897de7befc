"""Suffix order of a sequence, and the common prefixes of neighbours, by doubling ranks."""

from __future__ import annotations

import numpy as np


def sort_suffixes(keys: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... items; equal ranks mean equal items. In the last, all differ.

    A rank is the place of the first suffix of its kind. Only suffixes that still tie are sorted again."""
    n = len(keys)
    if not n:
        return [np.zeros(0, np.int64)]
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    rank = np.empty(n, np.int64)
    rank[order] = _heads(same)
    levels, tied, length = [rank], _tied(order, same), 1
    while len(tied):
        after = tied + length
        key = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        by = np.argsort(rank[tied] * (n + 1) + key)
        tied, key = tied[by], key[by]
        old = rank[tied]
        group = old[1:] == old[:-1]
        same = group & (key[1:] == key[:-1])
        within = np.arange(len(tied)) - _heads(group)
        rank = rank.copy()
        rank[tied] = (old + within)[_heads(same)]
        levels.append(rank)
        tied = _tied(tied, same)
        length *= 2
    return levels


def _heads(same: np.ndarray) -> np.ndarray:
    """Place of the first of each run; same: whether an item equals the one before, from the second on."""
    return np.maximum.accumulate(np.where(np.r_[True, ~same], np.arange(len(same) + 1), 0))


def _tied(order: np.ndarray, same: np.ndarray) -> np.ndarray:
    return order[np.r_[same, False] | np.r_[False, same]]


def suffix_array(levels: list[np.ndarray]) -> np.ndarray:
    order = np.empty(len(levels[-1]), np.int64)
    order[levels[-1]] = np.arange(len(order))
    return order


def common_prefixes(levels: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """Items that each suffix in order shares with the one before (0 for the first)."""
    n = len(order)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    pair = 1 + np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]])
    a, b = order[pair - 1].copy(), order[pair].copy()
    total = np.zeros(len(pair), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        rank = levels[level]
        agree = (np.maximum(a, b) < n) & (rank[np.minimum(a, n - 1)] == rank[np.minimum(b, n - 1)])
        for side in (total, a, b):
            side += agree * (1 << level)
    out[pair] = total
    return out
