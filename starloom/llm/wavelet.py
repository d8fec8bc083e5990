"""Wavelet matrix: a sequence of small numbers as bit-planes with rank and select."""

from __future__ import annotations

import numpy as np

_ONE, _SIX = np.uint64(1), np.uint64(63)


class BitPlane:
    """Bits in 64-bit words with a running count per word."""

    def __init__(self, words: np.ndarray, size: int):
        self.words, self.size = words, size
        self.before = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.bitwise_count(words), out=self.before[1:])
        self.ones = int(self.before[-1])

    @classmethod
    def of(cls, bits: np.ndarray) -> BitPlane:
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, np.uint64)
        words.view(np.uint8)[: len(packed)] = packed
        return cls(words, len(bits))

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        below = (_ONE << (at.astype(np.uint64) & _SIX)) - _ONE
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at.astype(np.uint64) & _SIX)) & _ONE

    def _nth(self, n: np.ndarray, count) -> np.ndarray:
        """The place that has exactly n of what ``count`` counts before it, and is one itself."""
        low, high = np.zeros(len(n), np.int64), np.full(len(n), self.size, np.int64)
        while len(n) and (low < high).any():
            mid = (low + high) >> 1
            enough = count(np.minimum(mid + 1, self.size)) > n
            high, low = np.where(enough & (low < high), mid, high), np.where(enough | (low >= high), low, mid + 1)
        return low

    def select(self, n: np.ndarray) -> np.ndarray:
        """Place of the n-th one, counted from 0."""
        return self._nth(n, self.rank)

    def select_zero(self, n: np.ndarray) -> np.ndarray:
        return self._nth(n, lambda at: at - self.rank(at))


class WaveletMatrix:
    """All operations take and return arrays, so that a search runs once for many queries."""

    def __init__(self, planes: list[BitPlane], size: int):
        self.planes, self.size = planes, size
        self.zeros = [p.size - p.ones for p in planes]

    @classmethod
    def of(cls, values: np.ndarray, bits: int | None = None) -> WaveletMatrix:
        values = np.asarray(values)
        bits = bits or max(1, int(values.max(initial=0)).bit_length())
        kind = np.uint16 if bits <= 16 else np.uint32
        values, planes, size = values.astype(kind), [], len(values)
        for level in range(bits - 1, -1, -1):
            ones = (values & kind(1 << level)).astype(bool)
            planes.append(BitPlane.of(ones))
            values = np.concatenate([values[~ones], values[ones]])
        return cls(planes, size)

    def _bit(self, values: np.ndarray, level: int) -> np.ndarray:
        return (values >> (len(self.planes) - 1 - level)) & 1

    def down(self, values: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where a place goes in the last order if it is followed along the bits of a value."""
        for level, plane in enumerate(self.planes):
            ones = plane.rank(at)
            at = np.where(self._bit(values, level) == 1, self.zeros[level] + ones, at - ones)
        return at

    def rank(self, values: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each value occurs before a place."""
        values, at = np.asarray(values, np.int64), np.asarray(at, np.int64)
        known = (values >> len(self.planes)) == 0
        values = np.where(known, values, 0)
        return np.where(known, self.down(values, at) - self.down(values, np.zeros_like(at)), 0)

    def access(self, at: np.ndarray) -> np.ndarray:
        at = np.asarray(at, np.int64)
        out = np.zeros(len(at), np.int64)
        for level, plane in enumerate(self.planes):
            bit, ones = plane.get(at).astype(np.int64), plane.rank(at)
            out = out << 1 | bit
            at = np.where(bit == 1, self.zeros[level] + ones, at - ones)
        return out

    def select(self, values: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Place of the n-th occurrence, counted from 0; it must exist."""
        values, n = np.asarray(values, np.int64), np.asarray(n, np.int64)
        at = self.down(values, np.zeros_like(n)) + n
        for level in range(len(self.planes) - 1, -1, -1):
            plane, one = self.planes[level], self._bit(values, level) == 1
            up = np.empty_like(at)
            up[one] = plane.select(at[one] - self.zeros[level])
            up[~one] = plane.select_zero(at[~one])
            at = up
        return at

    def less(self, low: np.ndarray, high: np.ndarray, values: np.ndarray) -> np.ndarray:
        """How many numbers of a range are smaller than a value of as many bits."""
        count = np.zeros(len(low), np.int64)
        for level, plane in enumerate(self.planes):
            one = self._bit(values, level) == 1
            a, b = plane.rank(low), plane.rank(high)
            count += np.where(one, (high - b) - (low - a), 0)
            low, high = np.where(one, self.zeros[level] + a, low - a), np.where(one, self.zeros[level] + b, high - b)
        return count

    def nth_of(self, low: np.ndarray, high: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The n-th smallest number of a range, counted from 0; it must exist."""
        out = np.zeros(len(low), np.int64)
        for level, plane in enumerate(self.planes):
            a, b = plane.rank(low), plane.rank(high)
            none = (high - b) - (low - a)
            one = n >= none
            n = np.where(one, n - none, n)
            low, high = np.where(one, self.zeros[level] + a, low - a), np.where(one, self.zeros[level] + b, high - b)
            out = out << 1 | one
        return out

    def successor(self, low: np.ndarray, high: np.ndarray, values: np.ndarray) -> np.ndarray:
        """The smallest number of a range that is not smaller than a value, -1 if there is none."""
        low, high, values = (np.asarray(x, np.int64) for x in (low, high, values))
        fits = (values >> len(self.planes)) == 0
        n = np.where(fits, self.less(low, high, np.where(fits, values, 0)), high - low)
        out = np.full(len(low), -1, np.int64)
        some = n < high - low
        out[some] = self.nth_of(low[some], high[some], n[some])
        return out

    def all(self) -> np.ndarray:
        """The whole sequence: from the last plane up, each level's order is undone."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        values = np.zeros(self.size, kind)
        for level in range(len(self.planes) - 1, -1, -1):
            plane, zeros = self.planes[level], self.zeros[level]
            ones = np.unpackbits(plane.words.view(np.uint8), count=self.size, bitorder="little").astype(bool)
            above = np.empty(self.size, kind)
            above[~ones] = values[:zeros]
            above[ones] = values[zeros:] | kind(1 << (len(self.planes) - 1 - level))
            values = above
        return values
