"""Words, lines and n-grams of many texts at once, as numpy arrays.

A run of texts is one byte array and the offsets of its texts.  Hashes of words
and lines are differences of a polynomial prefix sum modulo 2^64, so their cost
doesn't depend on their number or length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = 0x9E3779B97F4A7C15
_TABLE = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers and their inverses, 0 to n; kept up to the slices' usual size."""
    if len(_POWERS.get("up", ())) > n:
        return _POWERS["up"][:n + 1], _POWERS["down"][:n + 1]
    size = max(n, 1 << 21)
    up, down = (np.concatenate(([np.uint64(1)], np.cumprod(np.full(size, b, np.uint64)))) for b in (_BASE, pow(_BASE, -1, 1 << 64)))
    if size <= 1 << 23:
        _POWERS.update(up=up, down=down)
    return up[:n + 1], down[:n + 1]


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string array; null is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, at, data = texts.buffers()
    at = np.frombuffer(at, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    return (np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data else np.zeros(0, np.uint8)), at - at[0]


def lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


class Texts:
    """One run of texts: ``data`` bytes, ``at`` offsets."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        self.data, self.at, self.n = data, at, len(at) - 1
        self.space = _SPACE[data]
        up, self._down = _powers(len(data))
        with np.errstate(over="ignore"):
            self._sum = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_TABLE[data] * up[:-1], dtype=np.uint64)))

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of the bytes of each [start, end)."""
        return mix((self._sum[end] - self._sum[start]) * self._down[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, text) of every word."""
        edge = np.zeros(len(self.data) + 1, bool)
        edge[self.at] = True
        inside = ~self.space
        begin = inside.copy()
        begin[1:] &= self.space[:-1] | edge[1:-1]
        close = inside
        close[:-1] &= self.space[1:] | edge[1:-1]
        start = np.flatnonzero(begin)
        return start, np.flatnonzero(close) + 1, np.searchsorted(self.at, start, "right") - 1

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, text) of every line, the empty ones too; without the line ends."""
        cut = np.flatnonzero(self.data == 10)
        start = np.sort(np.concatenate((self.at[:-1], cut + 1)), kind="stable")
        end = np.sort(np.concatenate((self.at[1:], cut)), kind="stable")
        text = np.sort(np.concatenate((np.arange(self.n), np.searchsorted(self.at, cut, "right") - 1)), kind="stable")
        return start, end, text

    def per_text(self, marks: np.ndarray) -> np.ndarray:
        """How many of the marked bytes each text has."""
        total = np.concatenate(([0], np.cumsum(marks)))
        return total[self.at[1:]] - total[self.at[:-1]]

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, text) of every run of ``size`` (up to 8) bytes within a text."""
        n = len(self.data) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        value = np.zeros(n, np.uint64)
        for k in range(size):
            value = value << np.uint64(8) | self.data[k:n + k].astype(np.uint64)
        text = np.repeat(np.arange(self.n), np.diff(self.at))[:n]
        whole = np.arange(n) + size <= self.at[1:][text]
        return mix(value[whole] + np.uint64(size)), text[whole]


    def char_grams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, text) of every run of ``size`` (up to 8) code points within a text; of ASCII ones as :meth:`grams`."""
        lead = (self.data & 0xC0) != 0x80
        if lead.all():
            return self.grams(size)
        begin = np.flatnonzero(lead)
        text = np.repeat(np.arange(self.n), np.diff(self.at))[begin]
        first = within(text, size)
        start, end = begin[first], np.append(begin, len(self.data))[first + size]
        plain = end - start == size
        value = np.zeros(int(plain.sum()), np.uint64)
        for k in range(size):
            value = value << np.uint64(8) | self.data[start[plain] + k].astype(np.uint64)
        out = self.hashes(start, end)
        out[plain] = mix(value + np.uint64(size))
        return out, text[first]


def within(text: np.ndarray, size: int) -> np.ndarray:
    """Indices of ``size`` consecutive items of one text; text: sorted."""
    n = len(text) - size + 1
    return np.flatnonzero(text[:n] == text[size - 1:]) if n > 0 else np.zeros(0, np.int64)


def chain(hashes: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` consecutive hashes from each index of ``first``."""
    value = np.zeros(len(first), np.uint64)
    for k in range(size):
        value = mix(value * np.uint64(0x2545F4914F6CDD1D) + hashes[first + k])
    return value
