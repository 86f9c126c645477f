"""A compressed FM-index over integer sequences, in NumPy: suffix array of bounded depth, BWT in a
wavelet tree of rank bit vectors, and backward search that reports matching statistics.

Sequences are concatenated, each followed by a terminator of its own (larger terminators never
match a search).  Order is only needed to ``depth`` symbols, so the array is sorted by prefix doubling
in log2(depth) rounds.
"""

from __future__ import annotations

import numpy as np


class RankBits:
    """A bit vector with constant-time rank: packed words and the ones before each word."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros((n >> 6) + 1, np.uint64)
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        ones = np.bitwise_count(words).astype(np.int32)
        self.before = np.concatenate([[0], np.cumsum(ones[:-1], dtype=np.int32)]).astype(np.int32)

    def rank1(self, i: np.ndarray) -> np.ndarray:
        """Ones in [0, i)."""
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)


class WaveletTree:
    """Rank of a symbol in a prefix of a sequence; levels from the highest bit down (as a matrix)."""

    def __init__(self, seq: np.ndarray, symbols: int):
        self.depth = max(1, int(symbols - 1).bit_length())
        self.levels, self.zeros = [], []
        for k in reversed(range(self.depth)):
            bits = (seq >> k) & 1 == 1
            self.levels.append(RankBits(bits))
            self.zeros.append(int(len(bits) - bits.sum()))
            seq = np.concatenate([seq[~bits], seq[bits]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` in [0, at), element by element."""
        lo, hi = np.zeros(len(at), np.int64), at.astype(np.int64)
        for k, bits, zeros in zip(reversed(range(self.depth)), self.levels, self.zeros):
            one = (symbol >> k) & 1 == 1
            lo1, hi1 = bits.rank1(lo), bits.rank1(hi)
            lo = np.where(one, zeros + lo1, lo - lo1)
            hi = np.where(one, zeros + hi1, hi - hi1)
        return hi - lo


def sort_suffixes(seq: np.ndarray, depth: int) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """(suffix array, classes by prefix length) for prefixes of at least ``depth`` symbols.

    classes[m][i] numbers the first m symbols at i in their order; m runs over powers of two."""
    n = len(seq)
    classes = {1: seq.astype(np.int64)}
    m = 1
    while m < depth:
        c = classes[m]
        later = np.zeros(n, np.int64)
        later[: n - m] = c[m:] + 1 if n > m else 0
        key = c * np.int64(int(c.max(initial=0)) + 2) + later
        m *= 2
        classes[m] = np.unique(key, return_inverse=True)[1].astype(np.int64)
    return np.argsort(classes[m], kind="stable"), classes


class FMIndex:
    """Index of ``seq`` (non-negative symbols) for patterns of up to ``depth`` symbols."""

    def __init__(self, seq: np.ndarray, depth: int):
        self.n, self.depth = len(seq), depth
        self.sa, classes = sort_suffixes(seq, depth)
        symbols = int(seq.max()) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=symbols))])
        self.bwt = WaveletTree(seq[self.sa - 1], symbols)  # position -1 wraps to the last symbol
        self.classes, self.cuts = classes, {}

    def widened(self, m: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of all suffixes that share the first ``m`` symbols with those at ``at``."""
        if m == 0:
            return np.zeros(len(at), np.int64), np.full(len(at), self.n, np.int64)
        if m not in self.cuts:
            keys = self._prefix(self.classes, m)[self.sa]
            starts = np.concatenate([[True], keys[1:] != keys[:-1]])
            first = np.flatnonzero(starts)
            self.cuts[m] = first, np.append(first[1:], self.n), np.cumsum(starts) - 1
        lo, hi, group = self.cuts[m]
        g = group[at]
        return lo[g], hi[g]

    @staticmethod
    def _prefix(classes: dict[int, np.ndarray], m: int) -> np.ndarray:
        """Identifies the first m symbols of every suffix, in their order: from two overlapping powers of two."""
        p = 1 << (m.bit_length() - 1)
        a = classes[p]
        if p == m:
            return a
        later = np.zeros(len(a), np.int64)
        later[: len(a) - (m - p)] = a[m - p :] + 1
        return a * np.int64(int(a.max(initial=0)) + 2) + later

    def step(self, lo: np.ndarray, hi: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: the interval of symbol + pattern from that of the pattern."""
        return self.first[symbol] + self.bwt.rank(symbol, lo), self.first[symbol] + self.bwt.rank(symbol, hi)

    def statistics(self, rows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics, capped at ``depth``, of streamed rows (a padded matrix of symbols; -1: not in
        the index): per row and position the match length and its suffix-array interval.

        All rows advance together from their ends.  A match is shortened from its right end to depth - 1
        before it is extended, and further, symbol by symbol, while it can't be extended."""
        k, width = rows.shape
        length = np.zeros((k, width), np.int16)
        los, his = np.zeros((k, width), np.int64), np.zeros((k, width), np.int64)
        lo, hi, m = np.zeros(k, np.int64), np.full(k, self.n, np.int64), np.zeros(k, np.int64)
        for back in range(1, width + 1):
            live = np.flatnonzero(lengths >= back)
            if not len(live):
                break
            at = lengths[live] - back
            s = rows[live, at]
            full = m[live] == self.depth
            if full.any():
                own = live[full]
                lo[own], hi[own] = self.widened(self.depth - 1, lo[own])
                m[own] = self.depth - 1
            todo = np.flatnonzero(s >= 0)
            gone = live[s < 0]
            lo[gone], hi[gone], m[gone] = 0, self.n, 0
            while len(todo):
                own = live[todo]
                x, y = self.step(lo[own], hi[own], s[todo])
                good = y > x
                lo[own[good]], hi[own[good]] = x[good], y[good]
                m[own[good]] += 1
                todo = todo[~good]
                if len(todo):
                    own = live[todo]
                    short = m[own] - 1  # never below zero: a known symbol extends the empty match
                    for c in np.unique(short):
                        these = own[short == c]
                        lo[these], hi[these] = self.widened(int(c), lo[these])
                        m[these] = c
            length[live, at], los[live, at], his[live, at] = m[live], lo[live], hi[live]
        return length, los, his
