"""Content-defined anchors of byte strings.

An anchor is a position whose ``k``-byte string has the smallest hash of all
``k``-byte strings in some window of ``length`` bytes. Equal windows have their
anchors at equal places, so two documents can share ``length`` bytes only if
they share an anchor there. All functions work on many documents at once, laid
end to end.
"""

from __future__ import annotations

import numpy as np

from .common import mix64

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_TABLE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class _Powers:
    """Powers of a number modulo 2^64, each the product of one below ``STEP`` and one of the ``STEP``-th power: the
    tables, which a Python worker keeps from task to task, stay small however far they reach."""

    BITS = 16
    STEP = 1 << BITS

    def __init__(self, base: int):
        self.low = self._grown(np.ones(1, np.uint64), base, self.STEP)
        self.base = pow(base, self.STEP, 1 << 64)
        self.high = np.ones(1, np.uint64)

    @staticmethod
    def _grown(powers: np.ndarray, base: int, size: int) -> np.ndarray:
        while len(powers) < size:
            powers = np.concatenate([powers, powers * np.uint64(pow(base, len(powers), 1 << 64))])
        return powers

    def reach(self, n: int):
        """Make the tables hold all powers up to the ``n``-th."""
        self.high = self._grown(self.high, self.base, (n >> self.BITS) + 1)

    def at(self, n: np.ndarray) -> np.ndarray:
        return self.high[n >> self.BITS] * self.low[n & (self.STEP - 1)]

    def first(self, n: int) -> np.ndarray:
        """The powers before the ``n``-th."""
        return (self.high[: (n >> self.BITS) + 1, None] * self.low).ravel()[:n]


_UP, _DOWN = _Powers(int(_BASE)), _Powers(int(_INVERSE))


class Bytes:
    """Hashes of substrings of one byte array."""

    def __init__(self, data: np.ndarray):
        self.data = data
        _UP.reach(len(data))
        _DOWN.reach(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        for k, at in enumerate(range(0, len(data), _DOWN.STEP)):
            part = data[at:at + _DOWN.STEP]
            sums = self.sums[at + 1:at + 1 + len(part)]
            np.cumsum(_TABLE[part] * _DOWN.low[: len(part)] * _DOWN.high[k], out=sums)
            sums += self.sums[at]

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * _UP.at(start))


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """best over x[i : i + width] for each i that has a whole window."""
    out, have = x, 1
    while 2 * have <= width:
        out = best(out[:-have], out[have:])
        have *= 2
    if have < width:
        out = best(out[: len(out) - (width - have)], out[width - have:])
    return out


def anchors(data: Bytes, starts: np.ndarray, ends: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of all anchors; ``starts``/``ends``: the documents in ``data``."""
    n = len(data.data)
    if n < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    hashes = mix64((data.sums[k:] - data.sums[:-k]) * _UP.first(n - k + 1)) | np.uint64(1)
    width = length - k + 1
    least = _sliding(hashes, width, np.minimum)  # of the window of `length` bytes at each position
    inside = np.zeros(len(least) + 1, np.int64)
    last = np.maximum(ends - length + 1, starts)  # windows of a document start in [start, last)
    np.add.at(inside, np.minimum(starts, len(least)), 1)
    np.add.at(inside, np.minimum(last, len(least)), -1)
    least[np.cumsum(inside[:-1]) == 0] = 0
    pad = np.zeros(width - 1, np.uint64)
    most = _sliding(np.concatenate([pad, least, pad]), width, np.maximum)  # over windows that hold position p
    at = np.flatnonzero(most == hashes)
    return at, hashes[at]
