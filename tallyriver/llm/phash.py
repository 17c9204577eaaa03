"""A minimal perfect hash over distinct 128-bit keys, in numpy."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from tallyriver.llm.text import mixed

#: Bits of a level for each key that reaches it.
SPREAD = 2
_STEP = 0x9E3779B97F4A7C15


class PerfectHash(NamedTuple):
    """Bit fields of all levels end to end; the rank of a key's bit is its index."""

    bits: np.ndarray
    sizes: list[int]


def _places(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
    salt = np.uint64(((level + 1) * _STEP) & 0xFFFFFFFFFFFFFFFF)
    return (mixed(mixed(high ^ salt) + low) % np.uint64(size)).astype(np.int64)


def build(high: np.ndarray, low: np.ndarray) -> PerfectHash:
    """Keys that fall on a bit alone keep it; the others go on to the next level. Equal keys are an error."""
    levels, sizes = [], []
    while len(high):
        if len(sizes) >= 200:
            raise ValueError("keys are not distinct")
        size = max(64, -(-SPREAD * len(high) // 8) * 8)
        places = _places(high, low, len(sizes), size)
        alone = np.bincount(places, minlength=size) == 1
        levels.append(alone)
        sizes.append(size)
        rest = ~alone[places]
        high, low = high[rest], low[rest]
    return PerfectHash(np.packbits(np.concatenate(levels)) if levels else np.empty(0, np.uint8), sizes)


class Lookup:
    """Index of keys under a ``PerfectHash``: exact for its keys, some index or -1 for all others."""

    def __init__(self, built: PerfectHash):
        self.sizes = built.sizes
        self.bits = np.unpackbits(built.bits)[: sum(built.sizes)].astype(bool)
        self.ranks = np.cumsum(self.bits, dtype=np.int64) - 1

    def __call__(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        found = np.full(len(high), -1, np.int64)
        open_, start = np.arange(len(high)), 0
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            at = start + _places(high[open_], low[open_], level, size)
            hit = self.bits[at]
            found[open_[hit]] = self.ranks[at[hit]]
            open_ = open_[~hit]
            start += size
        return found
