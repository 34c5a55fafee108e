"""An FM-index over numbered words: suffix order, wavelet matrix, backward search and location, all in numpy.

Symbol 0 separates stretches of text; phrases consist of symbols from 1. Separators are ordered by position, so
suffixes differ at the latest at their separator. Pattern operations run over all patterns of one length at once.
"""

from __future__ import annotations

import numpy as np

SAMPLE_EVERY = 8


class Bits:
    """A bit array with ranks: ones before a position, from one running count per 64 bits."""

    def __init__(self, bits: np.ndarray):
        self.n = len(bits)
        packed = np.zeros((self.n // 64 + 1) * 8, np.uint8)
        some = np.packbits(bits, bitorder="little")
        packed[: len(some)] = some
        self.words = packed.view("<u8")
        self.before = np.zeros(len(self.words) + 1, np.int32)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0


class Wavelet:
    """Rank and access over a sequence of symbols, one level of bits per binary digit of the largest symbol."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.levels, self.zeros = [], []
        for level in reversed(range(max(1, int(top).bit_length()))):
            bits = (symbols >> level) & 1 != 0
            self.levels.append((level, Bits(bits)))
            self.zeros.append(int(len(bits) - bits.sum()))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position."""
        start = np.zeros(len(at), np.int64)
        for (level, bits), zeros in zip(self.levels, self.zeros, strict=True):
            one = (symbol >> level) & 1 != 0
            a, b = bits.rank(at), bits.rank(start)
            at, start = np.where(one, zeros + a, at - a), np.where(one, zeros + b, start - b)
        return at - start

    def get(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros(len(at), np.int64)
        for (level, bits), zeros in zip(self.levels, self.zeros, strict=True):
            one = bits.get(at)
            ones = bits.rank(at)
            at = np.where(one, zeros + ones, at - ones)
            symbol |= one.astype(np.int64) << level
        return symbol


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes in order; only suffixes that are still equal take part in the next doubling."""
    n = len(text)
    separator = text == 0
    start = np.where(separator, np.cumsum(separator) - 1, text + int(separator.sum()))
    order = np.argsort(start, kind="stable")
    ordered = start[order]
    new = np.r_[True, ordered[1:] != ordered[:-1]]
    first = np.flatnonzero(new)
    group = first[np.cumsum(new) - 1]  # a suffix's rank is the place of the first one equal to it
    rank = np.empty(n, np.int64)
    rank[order] = group
    size = np.diff(np.r_[first, n])
    open_ = np.repeat(size > 1, size)
    width = 1
    while open_.any():
        at = np.flatnonzero(open_)
        suffix = order[at]
        after = suffix + width
        key = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        head = rank[suffix]
        by = np.lexsort((key, head))
        suffix, head, key = suffix[by], head[by], key[by]
        order[at] = suffix
        new = np.r_[True, (head[1:] != head[:-1]) | (key[1:] != key[:-1])]
        first = np.flatnonzero(new)
        rank[suffix] = at[first][np.cumsum(new) - 1]
        size = np.diff(np.r_[first, len(at)])
        open_[at] = np.repeat(size > 1, size)
        width *= 2
    return order


class FMIndex:
    def __init__(self, text: np.ndarray, top: int):
        """``text`` has symbols 0 to ``top`` and ends with a separator."""
        self.n = len(text)
        order = suffix_order(text)
        self.last = Wavelet(text[order - 1], top)  # order 0 wraps to the end, which is a separator
        self.below = np.r_[0, np.cumsum(np.bincount(text, minlength=top + 1))].astype(np.int64)
        opening = np.r_[True, text[:-1] == 0]
        sampled = (order % SAMPLE_EVERY == 0) | opening[order]
        self.sampled = Bits(sampled)
        self.samples = order[sampled]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of the suffixes that begin with each pattern (one per row), by backward search."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        live = np.arange(len(patterns))
        for column in reversed(range(patterns.shape[1])):
            c = patterns[live, column]
            low[live] = self.below[c] + self.last.rank(c, low[live])
            high[live] = self.below[c] + self.last.rank(c, high[live])
            live = live[low[live] < high[live]]
            if not len(live):
                break
        high = np.maximum(low, high)
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: steps back to the next sampled one."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        found = np.empty(len(rows), np.int64)
        live = np.arange(len(rows))
        while len(live):
            hit = self.sampled.get(rows[live])
            done = live[hit]
            found[done] = self.samples[self.sampled.rank(rows[done])] + steps[done]
            live = live[~hit]
            c = self.last.get(rows[live])
            rows[live] = self.below[c] + self.last.rank(c, rows[live])
            steps[live] += 1
        return found
