"""Minimal perfect hashing of integer keys, in numpy.

A key set is hashed level by level into bit vectors: a key that has its
place to itself sets the bit, the others go on to the next, smaller level.
The slot of a key is the number of bits set before its own, so ``n`` keys
have the slots 0 to ``n - 1``. Sets are split into buckets by a first hash;
the bit vectors of all buckets in a row make one hash of the whole set.

Keys outside the set may get any slot (or -1): the caller keeps the keys by
slot and compares.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: Bits per key that a level offers, and levels at most (each takes about half of the keys).
ROOM, MAX_LEVELS = 1.5, 64
#: Seed of the hash that deals keys to buckets; the levels take 0, 1, 2, ...
BUCKET_SEED = 0x5EED


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 well mixed bits of every key."""
    x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of every key."""
    return (mixed(keys, BUCKET_SEED) % np.uint64(buckets)).astype(np.int64)


def build(keys: np.ndarray) -> tuple[list[int], np.ndarray]:
    """(words of each level, all words) of distinct ``keys``."""
    sizes, levels, left = [], [], keys
    while len(left):
        if len(sizes) == MAX_LEVELS:
            raise ValueError("the keys are not distinct")
        n = -(-int(len(left) * ROOM) // 64) or 1
        at = mixed(left, len(sizes)) % np.uint64(64 * n)
        alone = np.bincount(at.astype(np.int64), minlength=64 * n)[at.astype(np.int64)] == 1
        bits = np.zeros(64 * n, np.uint8)
        bits[at[alone].astype(np.int64)] = 1
        levels.append(np.packbits(bits, bitorder="little").view("<u8"))
        sizes.append(n)
        left = left[~alone]
    return sizes, np.concatenate(levels) if levels else np.zeros(0, "<u8")


class PerfectHash:
    """The hash of a set from its buckets' ``(sizes, words)``, in bucket order."""

    def __init__(self, buckets: Sequence[tuple[Sequence[int], np.ndarray]]):
        deepest = max((len(s) for s, _ in buckets), default=0)
        self.sizes = np.zeros((len(buckets), deepest), np.int64)
        for k, (s, _) in enumerate(buckets):
            self.sizes[k, :len(s)] = s
        self.first = (np.cumsum(self.sizes.ravel()) - self.sizes.ravel()).reshape(self.sizes.shape)
        self.words = np.concatenate([np.zeros(0, "<u8"), *(w for _, w in buckets)])
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones
        self.n = int(ones.sum())

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of every key; -1 for keys that are surely not of the set."""
        out = np.full(len(keys), -1, np.int64)
        if not self.n:
            return out
        todo = np.arange(len(keys))
        bucket = bucket_of(keys, len(self.sizes)) if len(self.sizes) > 1 else np.zeros(len(keys), np.int64)
        for level in range(self.sizes.shape[1]):
            n = self.sizes[bucket, level]
            known = n > 0
            if not known.all():
                todo, bucket, n = todo[known], bucket[known], n[known]
            if not len(todo):
                break
            at = (mixed(keys[todo], level) % (64 * n).astype(np.uint64)).astype(np.int64)
            word = self.first[bucket, level] + (at >> 6)
            bit = np.uint64(1) << (at & 63).astype(np.uint64)
            hit = (self.words[word] & bit) != 0
            out[todo[hit]] = self.before[word[hit]] + np.bitwise_count(self.words[word[hit]] & (bit[hit] - np.uint64(1)))
            todo, bucket = todo[~hit], bucket[~hit]
        return out
