"""64-bit hashes of many runs of bytes or words at once, by polynomial prefix sums modulo 2^64.

Fast, but not strong: some long runs that differ have equal hashes for any odd base. They choose and place things (anchors,
bits of filters); nothing takes two runs for equal because their hashes are.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Bytes of text that are hashed at once.
BLOCK = 1 << 19
BYTE_BASE, WORD_BASE = np.uint64(0x9E3779B97F4A7C15 | 1), np.uint64(0xD6E8FEB86659FD93)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=64)
def powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64, and of its inverse."""
    ups = np.full(size, base, np.uint64)
    downs = np.full(size, pow(int(base), -1, 1 << 64), np.uint64)
    ups[0] = downs[0] = 1
    return np.multiply.accumulate(ups), np.multiply.accumulate(downs)


def _tables(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    return powers(int(base), 1 << max(10, int(n).bit_length()))


def run_hashes(values: np.ndarray, base: np.uint64, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``values[start:end]`` for each pair, from one pass of prefix sums."""
    ups, downs = _tables(base, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * ups[: len(values)], out=total[1:])
    return mixed((total[ends] - total[starts]) * downs[starts] + (ends - starts).astype(np.uint64) * MIX[0])


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes from each start to its end; starts ascend. Bytes are worked on block by block."""
    out = np.empty(len(starts), np.uint64)
    cuts = np.searchsorted(starts, np.arange(0, len(raw) + BLOCK, BLOCK))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if a < b:
            low = starts[a]
            values = raw[low : ends[b - 1]].astype(np.uint64) + np.uint64(1)
            out[a:b] = run_hashes(values, BYTE_BASE, starts[a:b] - low, ends[a:b] - low)
    return out
