"""Minimal perfect hash of a set of 64-bit keys, after Limasset et al., "Fast and scalable minimal
perfect hashing for massive key sets" (2017): level by level, a key takes the bit it alone hashes
to; its number is the count of set bits before that bit.  Keys still left after the last level are
kept in a sorted array (exact, and empty in practice)."""

from __future__ import annotations

import numpy as np

GAMMA = 2.0
LEVELS = 24


def mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser (murmur3's) of keys and a seed."""
    with np.errstate(over="ignore"):
        x = x ^ np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


def build(keys: np.ndarray) -> dict[str, np.ndarray]:
    """keys: distinct uint64.  bits: all levels' words; sizes: words of each level; rest: sorted."""
    left, bits, sizes = keys, [], []
    for level in range(LEVELS):
        if not len(left):
            break
        words = max(1, int(np.ceil(GAMMA * len(left) / 64)))
        at = mix(left, level + 1) % np.uint64(words * 64)
        seen, first, n = np.unique(at, return_index=True, return_counts=True)
        alone = n == 1
        level_bits = np.zeros(words, np.uint64)
        np.bitwise_or.at(level_bits, (seen[alone] >> np.uint64(6)).astype(np.int64), np.uint64(1) << (seen[alone] & np.uint64(63)))
        bits.append(level_bits)
        sizes.append(words)
        keep = np.ones(len(left), bool)
        keep[first[alone]] = False
        left = left[keep]
    return {"bits": np.concatenate(bits) if bits else np.zeros(0, np.uint64), "sizes": np.array(sizes, np.int64), "rest": np.sort(left)}


class Lookup:
    """Numbers 0..n-1 of keys; -1 where a foreign key meets no bit."""

    def __init__(self, parts: dict[str, np.ndarray]):
        self.bits, self.sizes, self.rest = parts["bits"], parts["sizes"], parts["rest"]
        counts = np.bitwise_count(self.bits).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)])

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        todo, base = np.arange(len(keys)), 0
        for level, words in enumerate(self.sizes):
            if not len(todo):
                return out
            at = mix(keys[todo], level + 1) % np.uint64(words * 64)
            word = (at >> np.uint64(6)).astype(np.int64) + base
            bit = at & np.uint64(63)
            hit = (self.bits[word] >> bit) & np.uint64(1) == 1
            below = self.bits[word] & ((np.uint64(1) << bit) - np.uint64(1))
            number = self.before[word] + np.bitwise_count(below).astype(np.int64)
            out[todo[hit]] = number[hit]
            todo, base = todo[~hit], base + int(words)
        if len(todo) and len(self.rest):
            i = np.searchsorted(self.rest, keys[todo])
            ok = (i < len(self.rest)) & (self.rest[np.minimum(i, len(self.rest) - 1)] == keys[todo])
            out[todo[ok]] = self.before[-1] + i[ok]
        return out
