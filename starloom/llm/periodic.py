"""Periodic runs: stretches of words that repeat with a period at least three times.

Words of a chunk of texts are symbols, other ones in each text, so that a block
recurs in its own text only. Suffixes whose first words recur are put in order by the
names of their dyadic blocks (2^k words, and the half steps of three blocks of
2^(k-1)); the suffixes that begin with a block are a range of that order at
every level. For each block on a dyadic grid a wavelet matrix over the ordered
positions gives its next occurrence in the window behind it (range successor).

A block of B words inside a run of period q <= B next occurs exactly q words
later (else the run had a smaller period), so the distance is the candidate,
and in a run of 3 q words some block of the level of q lies on the grid. The
progression of blocks with one distance is one stretch; it is extended by
comparing words, and is then maximal with that smallest period.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm import words as W
from starloom.llm.wavelet import WaveletMatrix

#: Least words and repetitions of a run; the grid of blocks is made for these.
LEAST_WORDS, LEAST_TIMES = 24, 3
#: Words of the smallest block.
SMALLEST = 8

#: Order of the words of texts: (ids, first word of each text) to word numbers.
Order = Callable[[pa.Array, np.ndarray], np.ndarray]


def _blocks(symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Recurring suffixes in order, and the blocks of all levels that recur.

    ``starts`` are places with ``SMALLEST`` words of one text behind them. A
    block is (place, first and behind last suffix, words, longest distance of the level below).
    """
    places = starts[W.twins(W.sequence_hashes(symbols, SMALLEST)[starts])[0]]
    order = places[np.lexsort([symbols[places + j] for j in range(SMALLEST - 1, -1, -1)])]
    found: list[np.ndarray] = []
    # A place that recurs nowhere has a name of its own.
    name = len(order) + np.arange(len(symbols))

    def level(at: np.ndarray, tied: np.ndarray, new: np.ndarray, size: int, step: int, below: int) -> tuple[np.ndarray, np.ndarray]:
        """Groups of equal blocks: name of each and whether it has others; collects those on the grid."""
        first = np.flatnonzero(new)
        counts = np.diff(np.append(first, len(at)))
        low, many = np.repeat(tied[first], counts), np.repeat(counts, counts)
        grid = (many > 1) & (at % step == 0)
        found.append(np.stack([at[grid], low[grid], (low + many)[grid], np.full(grid.sum(), size), np.full(grid.sum(), below)]))
        return low, many > 1

    at, tied, size = order, np.arange(len(order)), SMALLEST
    new = np.ones(len(at), bool)
    if len(at):
        new[1:] = np.any([symbols[at[1:] + j] != symbols[at[:-1] + j] for j in range(SMALLEST)], axis=0)
    below, step = 0, SMALLEST
    while len(at):
        low, more = level(at, tied, new, size, step, below)
        name[at] = np.where(more, low, len(order) + at)
        at, tied, low = at[more], tied[more], low[more]

        def behind(words: int) -> np.ndarray:
            place = at + words
            return np.where(place < len(symbols), name[np.minimum(place, len(symbols) - 1)], len(order) + place)

        half, whole = behind(size // 2), behind(size)
        by = np.lexsort([whole, half, low])
        at, half, whole, low = at[by], half[by], whole[by], low[by]
        order[tied] = at
        new = np.ones(len(at), bool)
        new[1:] = (low[1:] != low[:-1]) | (half[1:] != half[:-1])
        level(at, tied, new, size * 3 // 2, size // 2, size)
        new[1:] |= whole[1:] != whole[:-1]
        below, step, size = size * 3 // 2, size, size * 2
    return order, found


def _extend(symbols: np.ndarray, from_: int, to: int, period: int, first: int, last: int, step: int) -> tuple[int, int]:
    """The longest stretch with a period around one, within [first, last)."""
    while from_ > first:
        n = min(step, from_ - first)
        differ = np.flatnonzero(symbols[from_ - n : from_] != symbols[from_ - n + period : from_ + period])
        if len(differ):
            from_ -= n - 1 - int(differ[-1])
            break
        from_ -= n
    while to < last:
        n = min(step, last - to)
        differ = np.flatnonzero(symbols[to : to + n] != symbols[to - period : to + n - period])
        if len(differ):
            to += int(differ[0])
            break
        to += n
    return from_, to


def find_runs(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, by text, start and period.

    ``symbols`` are the words of all texts as 64-bit numbers, ``first`` the
    number of the first word of each text, and the total.
    """
    home = np.repeat(np.arange(len(first) - 1), np.diff(first))
    symbols = W.mix(symbols ^ W.mix(home.astype(np.uint64) + np.uint64(1)))
    starts = np.flatnonzero(np.arange(len(symbols)) + SMALLEST <= first[1:][home])
    order, found = _blocks(symbols, starts)
    if not len(order):
        return np.zeros((0, 4), np.int64)
    at, low, high, size, below = np.concatenate(found, axis=1)
    follow = WaveletMatrix.of(order, len(symbols).bit_length()).successor(low, high, at + 1)
    period = follow - at
    good = (follow >= 0) & (period > below) & (period <= size)
    at, size, period = at[good], size[good], period[good]
    by = np.lexsort([at, period])
    at, size, period = at[by], size[by], period[by]
    # Blocks of one distance that overlap make one stretch.
    new = np.ones(len(at), bool)
    new[1:] = (period[1:] != period[:-1]) | (at[1:] > at[:-1] + size[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(at))[: len(begin)] - 1
    runs = set()
    for a, b in zip(begin.tolist(), end.tolist()):
        p, n, text = int(period[a]), int(size[a]), int(home[at[a]])
        i, j = _extend(symbols, int(at[a]), int(at[b]) + n + p, p, int(first[text]), int(first[text + 1]), n)
        if j - i >= max(LEAST_WORDS, LEAST_TIMES * p):
            runs.add((text, i - int(first[text]), j - i, p))
    return np.array(sorted(runs, key=lambda r: (r[0], r[1], r[3])), np.int64).reshape(-1, 4)


_RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])
FIELDS = [
    T.StructField("n_words", T.LongType(), False),
    T.StructField("runs", T.ArrayType(_RUN, False), False),
    T.StructField("collapsed_text", T.StringType(), False),
]


def _kernel(ids: str, text: str, order: Order | None) -> Callable[[pa.RecordBatch], list[pa.Array]]:
    def run(chunk: pa.RecordBatch) -> list[pa.Array]:
        data, offsets = W.text_bytes(chunk.column(text))
        words = W.find_words(data, offsets)
        starts, ends, hashes = words.starts, words.ends, words.hashes()
        if order is not None:
            taken = order(chunk.column(ids), words.first)
            starts, ends, hashes = starts[taken], ends[taken], hashes[taken]
        runs = find_runs(hashes, words.first)
        begin = words.first[runs[:, 0]] + runs[:, 1]
        gone = W.covered(len(starts), begin + runs[:, 3], runs[:, 2] - runs[:, 3])
        kept = np.flatnonzero(~gone)
        # All kept words with a space after each; a text ends before its last space.
        sizes = ends[kept] - starts[kept] + 1
        cuts = np.zeros(len(kept) + 1, np.int64)
        np.cumsum(sizes, out=cuts[1:])
        taken = W.ranges(starts[kept], sizes)
        taken[cuts[1:] - 1] = len(data)
        plain = np.append(data, np.uint8(0x20))[taken].tobytes()
        edge = cuts[np.searchsorted(kept, words.first)]
        texts = [plain[a : max(a, b - 1)] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
        per_text = np.bincount(runs[:, 0], minlength=chunk.num_rows)
        rows = pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in (1, 2, 3)], fields=[pa.field(c, pa.int64(), False) for c in _RUN.names])
        return [pa.array(words.counts), W.lists(rows, per_text), pa.array(texts, pa.binary()).cast(pa.string())]

    return run


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: Order | None = None) -> DataFrame:
    """Adds n_words, runs (start, length, period) and collapsed_text to each row; no shuffle.

    A run is a longest stretch of at least 24 words and three times its
    smallest period. The collapsed text has, of every run, only the first period's words,
    one space between words. ``order`` may rearrange each text's words before (tests
    plant runs so). Null and empty texts have no words; rows are judged one by
    one, so equal rows get equal results; a text of any length is taken whole
    and is the most that a task holds. Columns of the results' names are replaced.
    """
    return W.map_texts(docs, text, FIELDS, _kernel(doc_id, text, order))


def strongest(runs: Column) -> Column:
    """The run of the largest length/period, the first of equal ones; null without a run."""
    none = F.lit(None).cast(_RUN)

    def better(best: Column, run: Column) -> Column:
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    return F.reduce(runs, none, better)
