"""Minimal perfect hash functions over sets of 64-bit keys, built and asked with numpy.

Keys are hashed into a bit array of twice their number; a key that is alone on its bit keeps it,
the others go on to the next, smaller array until none is left.  A key's number is the count of set
bits before its own, over all arrays in turn, so n keys have the numbers 0 to n - 1.  A function
takes about four bits a key.  Keys that were not in the set get any number or none, so
whoever asks for foreign keys must compare with the key that is kept under the number.
"""

from __future__ import annotations

import numpy as np

from sessionloom.llm.words import mixed

#: Bits of an array for each key that reaches it.
SPARSENESS = 2
#: An odd step between the levels' hash functions.
STEP = 0x9E3779B97F4A7C15


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mixed(keys + np.uint64((level + 1) * STEP % (1 << 64))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Numbers of keys; ``sizes`` and ``bits`` are all there is to it, so it can travel in a row."""

    def __init__(self, sizes: list[int], bits: bytes) -> None:
        self.sizes, self.bits = sizes, bits
        flat = np.unpackbits(np.frombuffer(bits, np.uint8), count=sum(sizes)).astype(bool)
        self._set = flat
        self._rank = np.concatenate([[0], np.cumsum(flat)])

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        """The function of distinct keys (uint64)."""
        left, sizes, levels = keys.astype(np.uint64), [], [np.empty(0, bool)]
        while len(left):
            size = SPARSENESS * len(left)
            places = _places(left, len(sizes), size)
            alone = np.bincount(places, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = left[~alone[places]]
        return cls(sizes, np.packbits(np.concatenate(levels)).tobytes())

    def __len__(self) -> int:
        return int(self._rank[-1])

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 for a key that is certainly foreign."""
        keys = keys.astype(np.uint64)
        out = np.full(len(keys), -1, np.int64)
        open_, first = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            places = first + _places(keys[open_], level, size)
            hit = self._set[places]
            out[open_[hit]] = self._rank[places[hit]]
            open_ = open_[~hit]
            first += size
        return out
