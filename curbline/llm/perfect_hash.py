"""A minimal perfect hash of distinct 64-bit keys, by cascading bit arrays.

At each level the keys that are left fall on an array of about twice their number; those that are
alone on their bit stay there, the others go down a level. The slot of a key is the rank of its
bit over all levels, so n keys have the slots 0 to n - 1. Building and looking up are array
operations; a key takes about 4 bits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SPREAD = 2
MOST_LEVELS = 128
_STEP = np.uint64(0x9E3779B97F4A7C15)
_ONE = np.uint64(1)


def mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """64-bit hashes of the keys, different at each level."""
    z = keys + np.uint64((level + 1) * int(_STEP) & (1 << 64) - 1)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


@dataclass
class PerfectHash:
    """``sizes``: bits of each level, multiples of 64. ``words``: the bits of all levels."""

    sizes: list[int]
    words: np.ndarray

    def __post_init__(self):
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)])

    @staticmethod
    def of(keys: np.ndarray) -> PerfectHash:
        """``keys`` are distinct."""
        sizes, parts, rest = [], [np.zeros(0, np.uint64)], keys
        while rest.size:
            if len(sizes) == MOST_LEVELS:
                raise ValueError("the keys of a perfect hash must be distinct")
            size = -(-SPREAD * rest.size // 64) * 64
            place = mixed(rest, len(sizes)) % np.uint64(size)
            alone = np.bincount(place.astype(np.int64), minlength=size) == 1
            parts.append(np.packbits(alone, bitorder="little").view("<u8").astype(np.uint64))
            sizes.append(size)
            rest = rest[~alone[place.astype(np.int64)]]
        return PerfectHash(sizes, np.concatenate(parts))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of every key; a key that was not built in gets -1 or any slot."""
        out = np.full(keys.size, -1, np.int64)
        left, first = np.arange(keys.size), 0
        for level, size in enumerate(self.sizes):
            place = mixed(keys[left], level) % np.uint64(size)
            word = first + (place >> np.uint64(6)).astype(np.int64)
            bit = place & np.uint64(63)
            held = self.words[word]
            hit = (held >> bit) & _ONE == _ONE
            below = held[hit] & ((_ONE << bit[hit]) - _ONE)
            out[left[hit]] = self.before[word[hit]] + np.bitwise_count(below)
            left, first = left[~hit], first + size // 64
        return out
