"""FM-index over short word sequences: wavelet matrix, backward search, matching statistics; in numpy."""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Packed bit planes of an integer sequence with counts per 64 bits: ``levels`` bits a symbol, and rank by symbol."""

    def __init__(self, symbols: np.ndarray, largest: int) -> None:
        self.levels = max(1, int(largest).bit_length())
        size, blocks = len(symbols), (len(symbols) >> 6) + 1
        self.words = np.zeros((self.levels, blocks), dtype=np.uint64)
        self.counts = np.zeros((self.levels, blocks), dtype=np.int32)
        self.zeros = np.zeros(self.levels, dtype=np.int64)
        for level in range(self.levels):
            bit = (symbols >> (self.levels - 1 - level) & 1).astype(bool)
            padded = np.zeros(blocks << 6, dtype=bool)
            padded[:size] = bit
            self.words[level] = np.packbits(padded, bitorder="little").view("<u8")
            ones = np.bitwise_count(self.words[level]).astype(np.int32)
            self.counts[level] = np.cumsum(ones) - ones
            self.zeros[level] = size - int(bit.sum())
            symbols = np.concatenate([symbols[~bit], symbols[bit]])
        #: Where each symbol's run begins after the last level.
        self.begins = np.zeros(largest + 1, dtype=np.int64)
        self.begins = self.ranks(np.arange(largest + 1), self.begins)

    def ranks(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each ``symbol`` stands before place ``at``."""

        for level in range(self.levels):
            block = at >> 6
            low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.counts[level][block] + np.bitwise_count(self.words[level][block] & low)
            up = (symbol >> (self.levels - 1 - level) & 1).astype(bool)
            at = np.where(up, self.zeros[level] + ones, at - ones)
        return at - self.begins[symbol]


class WordIndex:
    """FM-index of many word sequences with a weight each.

    ``symbols`` holds the sequences one after another, each closed by a zero; words are
    1, 2, and so on. Suffixes end at their zero; among equal ones the earlier sequence is first.
    ``longest`` is the length of the longest sequence.
    """

    def __init__(self, symbols: np.ndarray, weights: np.ndarray, longest: int, depth: int) -> None:
        size = self.size = len(symbols)
        self.symbols, self.depth = symbols, depth
        closing = symbols == 0
        owner = np.cumsum(closing) - closing
        # Suffix order by prefix doubling; the closing zeros are distinct, in order.
        rank = np.where(closing, owner, symbols + owner[-1] + 1)
        ranks, reach = [], 1
        while True:
            ranks.append(np.append(rank, np.full(size, -1, dtype=rank.dtype)))
            if reach > longest:
                break
            key = rank * np.int64(2 * size + 2) + ranks[-1][reach : reach + size] + 1
            order = np.argsort(key)
            fresh = np.append(False, key[order][1:] != key[order][:-1])
            rank = np.empty(size, dtype=np.int64)
            rank[order] = np.cumsum(fresh)
            reach *= 2
        suffixes = np.argsort(rank)
        # Common prefixes of neighbours, from the ranks of ever shorter pieces.
        common = np.zeros(size + 1, dtype=np.int64)
        a, b = suffixes[:-1], suffixes[1:]
        for level in range(len(ranks) - 2, -1, -1):
            step = 1 << level
            same = ranks[level][a + common[1:-1]] == ranks[level][b + common[1:-1]]
            common[1:-1] += np.where(same, step, 0)
        common[0] = common[-1] = -1
        self.common = common
        # For each depth, the interval of suffixes around a place that agree so far.
        place = np.arange(size + 1)
        self.lows = np.zeros((depth, size), dtype=np.int32)
        self.highs = np.zeros((depth, size), dtype=np.int32)
        for d in range(1, depth):
            cut = common < d
            self.lows[d] = np.maximum.accumulate(np.where(cut, place, 0))[:-1]
            self.highs[d] = np.minimum.accumulate(np.where(cut, place, size)[::-1])[::-1][1:]
        self.highs[0] = size
        last = symbols[suffixes - 1]  # the word before each suffix
        self.wavelet = WaveletMatrix(last, int(symbols.max()))
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=int(symbols.max()) + 1))])
        self.weight = np.concatenate([[0], np.cumsum(weights[owner[suffixes]])])

    def back(self, word: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: the intervals of the patterns with ``word`` put before them."""

        both = self.wavelet.ranks(np.concatenate([word, word]), np.concatenate([low, high]))
        start = self.first[word]
        return start + both[: len(word)], start + both[len(word) :]

    def statistics(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Matching statistics of the sequences ``symbols[begin[i]:end[i]]``, which stream from their ends.

        For each place of ``symbols``: the length, at most ``depth``, of the longest string that
        starts there, lies in its sequence, and occurs with a weight of two or more in the index.
        Places of other sequences have zero. All sequences move in step; one that cannot be
        extended shrinks to the next larger interval.
        """

        found = np.zeros(self.size, dtype=np.int8)
        at, first = end - 1, begin
        low, high = np.zeros(len(at), np.int64), np.full(len(at), self.size)
        length = np.zeros(len(at), dtype=np.int64)
        while len(at):
            next_low, next_high = self.back(self.symbols[at], low, high)
            fits = (next_high > next_low) & (self.weight[next_high] - self.weight[np.minimum(next_low, next_high)] >= 2)
            grown = np.flatnonzero(fits)
            low[grown], high[grown] = next_low[grown], next_high[grown]
            length[grown] += 1
            found[at[grown]] = length[grown]
            stuck = np.flatnonzero(~fits & (length > 0))
            less = np.maximum(self.common[low[stuck]], self.common[high[stuck]])
            full = np.flatnonzero(length == self.depth)  # a window is found; go on with all but its last word
            shrink = np.concatenate([stuck, full])
            length[shrink] = np.concatenate([np.maximum(less, 0), np.full(len(full), self.depth - 1)])
            low[shrink], high[shrink] = self.lows[length[shrink], low[shrink]], self.highs[length[shrink], low[shrink]]
            moved = fits.copy()
            moved |= ~fits & ~np.isin(np.arange(len(at)), stuck)  # nothing to shrink: no match here
            at = at - moved
            keep = at >= first
            if not keep.all():
                at, first, low, high, length = at[keep], first[keep], low[keep], high[keep], length[keep]
        return found
