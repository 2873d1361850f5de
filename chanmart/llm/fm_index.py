"""An FM-index over a shard's word sequence: wavelet-tree ranks, backward search, sampled suffix positions.

Symbols are small integers; 0 separates stretches of text and never occurs in
a searched phrase.  All searched phrases of equal length are searched together
(numpy vectors of lower and upper bounds), so the cost of a step is shared.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """All suffixes of ``text`` in order, by prefix doubling; separators (0) differ from each other by position.

    With separators told apart, no two suffixes are equal and an order is
    settled at the next separator, so rounds grow with the logarithm of the
    longest stretch, not of the shard.
    """
    n = len(text)
    separators = np.flatnonzero(text == 0)
    rank = text + len(separators)
    rank[separators] = np.arange(len(separators))
    done = 1
    while True:
        nxt = np.zeros(n, np.int64)
        nxt[: n - done] = rank[done:] + 1
        key = rank * (n + int(text.max()) + 3) + nxt
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        done *= 2
        if rank[order[-1]] == n - 1:
            return order


class BitRank:
    """A bit vector with rank in constant time: counts per 64-bit word, popcount inside one."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each position."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(below)

    def get(self, at: np.ndarray) -> np.ndarray:
        return ((self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)


class WaveletTree:
    """Ranks of any symbol in a sequence, level by level from the highest bit (levels stored whole)."""

    def __init__(self, sequence: np.ndarray, n_symbols: int):
        self.levels: list[tuple[int, BitRank, int]] = []
        current = sequence
        for shift in range(max(1, int(n_symbols - 1).bit_length()) - 1, -1, -1):
            bit = ((current >> shift) & 1).astype(np.uint8)
            self.levels.append((shift, BitRank(bit), int(len(bit) - bit.sum())))
            current = np.concatenate([current[bit == 0], current[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol[i]`` before position ``at[i]``."""
        start, end = np.zeros_like(at), at.copy()
        for shift, bits, zeros in self.levels:
            one = ((symbol >> shift) & 1) == 1
            s1, e1 = bits.ones(start), bits.ones(end)
            start = np.where(one, zeros + s1, start - s1)
            end = np.where(one, zeros + e1, end - e1)
        return end - start

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(at)
        for shift, bits, zeros in self.levels:
            bit = bits.get(at)
            ones = bits.ones(at)
            symbol |= bit << shift
            at = np.where(bit == 1, zeros + ones, at - ones)
        return symbol


class FMIndex:
    """Index of one shard; ``text`` must end with the separator 0."""

    def __init__(self, text: np.ndarray, n_symbols: int, sample: int = 8):
        order = suffix_array(text)
        bwt = text[order - 1]  # the suffix at 0 is preceded by the closing separator
        self.tree = WaveletTree(bwt, n_symbols)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols))])
        sampled = (order % sample == 0) | (bwt == 0)  # the first of a stretch always, so no step crosses a separator
        self.sampled = BitRank(sampled.astype(np.uint8))
        self.positions = order[sampled]
        self.n = len(text)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals [lo, hi) of the phrases, rows of equal length, by backward search."""
        lo = np.zeros(len(phrases), np.int64)
        hi = np.full(len(phrases), self.n, np.int64)
        for k in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[:, k]
            lo = self.before[c] + self.tree.rank(c, lo)
            hi = self.before[c] + self.tree.rank(c, hi)
            hi = np.maximum(lo, hi)
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array rows: step back until a sampled one, add the steps."""
        out = np.zeros(len(rows), np.int64)
        at, todo, steps = rows.copy(), np.arange(len(rows)), 0
        while len(todo):
            here = at[todo]
            known = self.sampled.get(here) == 1
            out[todo[known]] = self.positions[self.sampled.ones(here[known])] + steps
            todo, here = todo[~known], here[~known]
            c = self.tree.access(here)
            at[todo] = self.before[c] + self.tree.rank(c, here)
            steps += 1
        return out
