"""Anchors: sampled grams that any two equal windows of a sequence share at the same place.

A window of ``length`` symbols holds ``length - gram + 1`` grams; the one of
least hash (the first, if several) is its anchor. Equal windows have equal
anchors at equal offsets, so windows need comparing only where anchors repeat.
The windows of one anchor are consecutive; there are about ``(length - gram) / 2``
of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Windows looked at together; positions within must fit the low bits of a key.
_POSITION_BITS = 20
_AT_ONCE = 1 << 19
_LOW = np.uint64((1 << _POSITION_BITS) - 1)
_BASE = 0x9E3779B97F4A7C15 | 1
_MULTIPLIER = np.uint64(0xD6E8FEB86659FD93)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Table:
    """Powers of the base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 1 << 12)
            self.up = _powers(_BASE, n)
            self.down = _powers(pow(_BASE, -1, 1 << 64), n)


_TABLE = _Table()


def mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _MULTIPLIER
    values = (values ^ (values >> np.uint64(32))) * _MULTIPLIER
    return values ^ (values >> np.uint64(32))


class Hashes:
    """Hashes of any stretches of a sequence of 64-bit symbols, from one running sum."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        _TABLE.grow(n + 1)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * _TABLE.up[:n], out=self._sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * _TABLE.down[starts])

    def grams(self, length: int) -> np.ndarray:
        """Hashes of all stretches of one length."""
        n = len(self._sums) - length
        return mix((self._sums[length:] - self._sums[:n]) * _TABLE.down[:n])


@dataclass
class Anchors:
    """Gram hash, place, and the first and last window of each anchor, with a hash of all those windows span."""

    gram: np.ndarray
    context: np.ndarray
    place: np.ndarray
    first: np.ndarray
    last: np.ndarray


def _sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive keys."""
    n = len(keys)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def find(symbols: np.ndarray, length: int, gram: int) -> Anchors:
    """The anchors of all windows of ``length`` symbols; none if there are fewer symbols."""
    n = len(symbols) - length + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return Anchors(none.astype(np.uint64), none.astype(np.uint64), none, none, none)
    hashes = Hashes(symbols)
    values = hashes.grams(gram)
    width = length - gram + 1
    owners = []
    for start in range(0, n, _AT_ONCE):
        stop = min(n, start + _AT_ONCE)
        part = values[start : stop + width - 1]
        keys = (part & ~_LOW) | np.arange(len(part), dtype=np.uint64)
        owners.append((_sliding_least(keys, width) & _LOW).astype(np.int64) + start)
    owner = np.concatenate(owners) if len(owners) > 1 else owners[0]
    first = np.concatenate([[0], np.nonzero(owner[1:] != owner[:-1])[0] + 1])
    last = np.append(first[1:], n) - 1
    place = owner[first]
    shape = ((place - first) << 32 | (last - first)).astype(np.uint64)
    context = mix(hashes(first, last + length) ^ mix(shape))
    return Anchors(values[place], context, place, first, last)
