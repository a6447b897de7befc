"""FM-index over word numbers: a wavelet matrix of bit vectors with counts, and matching statistics by backward search."""

from __future__ import annotations

import numpy as np

from wirelake.llm.suffixes import common_prefixes, sort_suffixes, suffix_array


class Bits:
    """A bit vector of 64-bit words, with the number of ones before each."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.zeros(len(self.words), np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def ones(self, place: np.ndarray) -> np.ndarray:
        """Number of ones before each place."""
        at = place >> 6
        below = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at] + np.bitwise_count(self.words[at] & below)


class WaveletMatrix:
    """Counts of a symbol before a place, over symbols from 0 to ``top``."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.levels: list[tuple[int, Bits, int]] = []
        for bit in range(max(top, 1).bit_length() - 1, -1, -1):
            ones = (symbols >> bit & 1).astype(bool)
            self.levels.append((bit, Bits(ones), int(len(ones) - ones.sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        every = np.arange(top + 1)
        self.first = self._down(every, np.zeros(top + 1, np.int64))

    def _down(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for bit, bits, zeros in self.levels:
            ones = bits.ones(place)
            place = np.where(symbol >> bit & 1, zeros + ones, place - ones)
        return place

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        return self._down(symbol, place) - self.first[symbol]


class FMIndex:
    """Index of several word sequences. ``words``: numbers from 1, all sequences in a row; ``of``: where each begins, and the end."""

    def __init__(self, words: np.ndarray, of: np.ndarray):
        count = len(of) - 1
        place = np.arange(len(words)) + np.repeat(np.arange(count), np.diff(of))
        symbols = np.zeros(len(words) + count, np.int64)  # 0: the end of a sequence, different from all others
        symbols[place] = words
        keys = symbols + count
        keys[symbols == 0] = np.arange(count)
        levels = sort_suffixes(keys)
        order = suffix_array(levels)
        top = int(words.max(initial=0))
        self.size = len(symbols)
        self.smaller = np.r_[0, np.cumsum(np.bincount(symbols, minlength=top + 1))]
        self.tree = WaveletMatrix(symbols[order - 1], top)
        shared = np.r_[common_prefixes(levels, order), 0]
        shared = shared.astype(np.min_scalar_type(int(shared.max(initial=0))))  # uint8 as a rule, wider for longer prefixes
        self.shared = [shared]  # smallest of 1, 2, 4, ... common prefixes from a place on
        step = 1
        while step < self.size:
            last = self.shared[-1]
            self.shared.append(np.minimum(last, np.r_[last[step:], np.zeros(min(step, len(last)), last.dtype)]))
            step *= 2

    def extend(self, word: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of the matches with a word put before them."""
        both = self.tree.rank(np.r_[word, word], np.r_[low, high]) + np.tile(self.smaller[word], 2)
        return both[: len(word)], both[len(word) :]

    def shorten(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Smallest larger ranges, which are those of shorter matches, and the lengths of these."""
        length = np.maximum(self.shared[0][low], self.shared[0][high])
        low, high = low.copy(), high.copy()
        for k in range(len(self.shared) - 1, -1, -1):
            step, least = 1 << k, self.shared[k]
            at = low - step + 1
            low -= step * ((at >= 0) & (least[np.maximum(at, 0)] >= length) & (length > 0))
            high += step * ((high <= self.size) & (least[np.minimum(high, self.size)] >= length) & (length > 0))
        none = length == 0
        low[none], high[none] = 0, self.size
        return low, high, length.astype(np.int64)

    def matching_statistics(self, words: np.ndarray, of: np.ndarray, twice: bool = True) -> np.ndarray:
        """For each word of the streamed sequences, the longest match in the index that starts there.

        twice: a match must occur at two places, as is right for sequences that are themselves in the index. All
        sequences advance together from their ends, by a word or by a step to a shorter match at a time."""
        least = 2 if twice else 1
        out = np.zeros(len(words), np.int64)
        live = np.flatnonzero(np.diff(of))
        begin, place = of[:-1][live], of[1:][live].copy()
        low, high, length = np.zeros(len(live), np.int64), np.full(len(live), self.size), np.zeros(len(live), np.int64)
        while len(place):
            a, b = self.extend(words[place - 1], low, high)
            grown = b - a >= least
            stuck = ~grown & (length > 0)
            low, high = np.where(grown, a, low), np.where(grown, b, high)
            length += grown
            if stuck.any():
                low[stuck], high[stuck], length[stuck] = self.shorten(low[stuck], high[stuck])
            place -= ~stuck
            moved = ~stuck
            out[place[moved]] = length[moved]
            going = place > begin
            if not going.all():
                begin, place, low, high, length = (x[going] for x in (begin, place, low, high, length))
        return out
