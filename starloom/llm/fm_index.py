"""FM-index of one shard: a sequence of symbols searched backwards through a wavelet matrix."""

from __future__ import annotations

import numpy as np

from starloom.llm.wavelet import BitPlane, WaveletMatrix
from starloom.llm.words import ranges

#: Every so many-th place of the sequence keeps its suffix position.
SAMPLE = 16


def suffix_array(symbols: np.ndarray, bits: int) -> np.ndarray:
    """Order of all suffixes. The last symbol must be 0 and occur once.

    Prefix doubling that only sorts what is still tied: first by as many
    symbols as fit a 64-bit number, then by the rank of what follows.
    """
    size, width = len(symbols), max(1, 63 // bits)
    padded = np.zeros(size + width, np.uint64)
    padded[:size] = symbols
    key = np.zeros(size, np.uint64)
    for j in range(width):
        key <<= np.uint64(bits)
        key |= padded[j : j + size]
    order = np.argsort(key)
    sorted_keys = key[order]
    begins = np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])
    rank = np.empty(size, np.int64)
    rank[order] = np.maximum.accumulate(np.where(begins, np.arange(size), 0))
    reach = width
    tied = np.flatnonzero(~(begins & np.concatenate([begins[1:], [True]])))
    while len(tied):
        at = order[tied]
        follow = rank[np.minimum(at + reach, size - 1)]
        group = rank[at]
        key = group.astype(np.uint64) << np.uint64(32) | follow.astype(np.uint64)
        by = np.argsort(key)
        at, key = at[by], key[by]
        order[tied] = at
        begins = np.concatenate([[True], key[1:] != key[:-1]])
        rank[at] = np.maximum.accumulate(np.where(begins, tied, 0))
        tied = tied[~(begins & np.concatenate([begins[1:], [True]]))]
        reach *= 2
    return order


class FMIndex:
    """Index of ``symbols``: numbers from 1 on; 0 is added as the end."""

    def __init__(self, symbols: np.ndarray, keep_order: bool = False):
        text = np.append(symbols, 0).astype(np.int64)
        self.size = len(text)
        bits = max(1, int(text.max()).bit_length())
        order = suffix_array(text, bits)
        self.turned = WaveletMatrix.of(text[order - 1], bits)
        every = np.arange(1 << bits, dtype=np.int64)
        self.least = np.searchsorted(text[order], every)
        self.base = self.turned.down(every, np.zeros_like(every))
        self.order = order if keep_order else None
        sampled = order % SAMPLE == 0
        self.marks, self.samples = BitPlane.of(sampled), order[sampled]

    def step(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Bound of the suffixes that begin with a symbol and go on like those before ``at``."""
        return self.least[symbols] + self.turned.down(symbols, at) - self.base[symbols]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search for all patterns at once.

        A row holds a pattern flush right; a symbol of -1 occurs nowhere.
        Returns the range of suffixes of each; an empty one if it does not occur.
        """
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size, np.int64)
        alive = np.flatnonzero(lengths > 0)
        high[lengths <= 0] = 0
        for j in range(1, patterns.shape[1] + 1):
            alive = alive[lengths[alive] >= j]
            symbols = patterns[alive, -j]
            known = (symbols >= 0) & (symbols < len(self.least))
            high[alive[~known]] = low[alive[~known]] = 0
            alive, symbols = alive[known], symbols[known]
            if not len(alive):
                break
            low[alive], high[alive] = self.step(symbols, low[alive]), self.step(symbols, high[alive])
            alive = alive[low[alive] < high[alive]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffixes: steps back until one is sampled."""
        at, steps = rows.astype(np.int64), np.zeros(len(rows), np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            now = at[open_]
            open_ = open_[self.marks.get(now) == 0]
            symbols = self.turned.access(at[open_])
            at[open_] = self.step(symbols, at[open_])
            steps[open_] += 1
        return self.samples[self.marks.rank(at)] + steps

    def occurrences(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the pattern and position of every occurrence."""
        counts = high - low
        return np.repeat(np.arange(len(low)), counts), self.locate(ranges(low, counts))
