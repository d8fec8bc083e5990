"""Words of whole texts as numpy arrays, read from Arrow's buffers.

A batch of texts is one array of bytes. Word borders, 64-bit word hashes and
hashes of word sequences come from array operations over it; no Python object
is made per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Bytes of text that are worked on at a time; a longer text is worked on alone.
CHUNK_BYTES = 3 << 20
#: Bytes hashed at a time, whatever the length of a text or word.
BLOCK = 1 << 19

_BYTES = np.arange(256)
#: Bytes of words for the two word patterns of the contracts.
SPACED = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
LETTERS = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x41) & (_BYTES <= 0x5A)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)

_RNG = np.random.default_rng(20240229)
_BYTE_CODES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    up = np.full(BLOCK, _BASE, np.uint64)
    up[0] = 1
    down = np.full(BLOCK, pow(_BASE, -1, 1 << 64), np.uint64)
    down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range; ranges are ascending and do not overlap.

    Differences of running polynomial sums, block by block, so that memory
    follows the number of ranges and not the number of bytes.
    """
    up, down = _powers()
    low, high = np.empty(len(starts), np.uint64), np.empty(len(starts), np.uint64)
    carry, blocks = np.uint64(0), -(-len(data) // BLOCK)
    s_cut = np.searchsorted(starts, np.arange(blocks + 1) * BLOCK)
    e_cut = np.searchsorted(ends, np.arange(blocks + 1) * BLOCK)
    e_cut[-1:] = len(ends)
    for b in range(blocks):
        part = data[b * BLOCK : (b + 1) * BLOCK]
        scale = np.uint64(pow(_BASE, b * BLOCK, 1 << 64))
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE_CODES[part] * up[: len(part)], out=sums[1:])
        sums = sums * scale + carry
        i, j = s_cut[b], s_cut[b + 1]
        low[i:j] = sums[starts[i:j] - b * BLOCK]
        i, j = e_cut[b], e_cut[b + 1]
        high[i:j] = sums[ends[i:j] - b * BLOCK]
        carry = sums[-1]
    out = (high - low) * down[starts % BLOCK]
    for b in range(1, blocks):
        i, j = s_cut[b], s_cut[b + 1]
        out[i:j] *= np.uint64(pow(_BASE, -b * BLOCK, 1 << 64))
    return mix(out)


@dataclass
class Words:
    """Words of the texts of one chunk; ``first[d]:first[d + 1]`` are those of text d."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def docs(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its texts; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if buffers[2] is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def borders(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and behind last byte of every run of marked bytes within a text."""
    wide = np.zeros(len(inside) + 2, bool)
    wide[1:-1] = inside
    cuts = offsets[(offsets > 0) & (offsets < len(inside))]
    begins = inside & ~wide[:-2]
    stops = inside & ~wide[2:]
    begins[cuts] = inside[cuts]
    stops[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def find_words(data: np.ndarray, offsets: np.ndarray, pattern: np.ndarray = SPACED, lower: bool = False) -> Words:
    """Borders of the words: runs of the pattern's bytes within a text."""
    if lower:
        data = LOWER[data]
    starts, ends = borders(pattern[data], offsets)
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def sequence_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n consecutive words, text borders not minded."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    size = len(hashes) - n + 1
    out = np.zeros(size, np.uint64)
    for j in range(n):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += hashes[j : j + size]
    return mix(out ^ np.uint64(n))


def windows(words: Words, n: int) -> np.ndarray:
    """Index of the first word of every window of n words that lies in one text."""
    total = int(words.first[-1])
    left = np.repeat(words.first[1:], words.counts)
    return np.flatnonzero(np.arange(total) + n <= left)


def twins(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur more than once, and which occurred before.

    A table of counts by leading bits finds the few that may; only those are sorted.
    """
    bits = max(8, min(21, len(keys).bit_length() + 2))
    slot = (keys >> np.uint64(64 - bits)).astype(np.int64)
    maybe = np.flatnonzero(np.bincount(slot, minlength=1 << bits)[slot] > 1)
    some = keys[maybe]
    order = np.argsort(some, kind="stable")
    same = np.zeros(len(some) + 1, bool)
    same[1:-1] = some[order][1:] == some[order][:-1]
    often, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    often[maybe[order]] = same[1:] | same[:-1]
    later[maybe[order]] = same[:-1]
    return often, later


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the values between borders."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return np.diff(sums[first])


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after the other."""
    counts = np.asarray(counts, np.int64)
    total = int(counts.sum())
    out = np.arange(total)
    return out + np.repeat(np.asarray(starts, np.int64) - (np.cumsum(counts) - counts), counts)


def covered(size: int, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
    """Which of ``size`` places lie in a range."""
    if not len(starts):
        return np.zeros(size, bool)
    change = np.bincount(starts, minlength=size + 1) - np.bincount(starts + lengths, minlength=size + 1)
    return np.cumsum(change[:size]) > 0


def chunks(batch: pa.RecordBatch, text: str, limit: int | None = None) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of bounded text size."""
    limit = limit or CHUNK_BYTES
    _, offsets = text_bytes(batch.column(text))
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield batch.slice(i, j - i)
        i = j


def give_back() -> None:
    """Hands freed memory of a finished task back: idle workers are many, and each keeps what it once used."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_texts(
    df: DataFrame,
    text: str,
    fields: list[T.StructField],
    kernel: Callable[[pa.RecordBatch], list[pa.Array]],
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """Adds to each row the columns that ``kernel`` makes from a chunk of rows.

    Columns of the same names are replaced; ``drop`` names columns that are
    read but not returned. No shuffle; a chunk is the most that is in memory.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    new = {f.name.lower() for f in fields} | {c.lower() for c in drop}
    keep = [c for c in df.columns if c.lower() not in new]
    types = [to_arrow_type(f.dataType) for f in fields]
    schema = T.StructType([df.schema[c] for c in keep] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch, text):
                made = [a if a.type == t else a.cast(t) for a, t in zip(kernel(chunk), types, strict=True)]
                yield pa.RecordBatch.from_arrays([chunk.column(c) for c in keep] + made, keep + [f.name for f in fields])
        give_back()

    return df.mapInArrow(run, schema)


def private(columns: list[str]) -> str:
    """A beginning of names that none of the columns has, for columns of one's own."""
    prefix = "_"
    while any(c.lower().startswith(prefix) for c in columns):
        prefix += "_"
    return prefix


def lists(values: pa.Array | np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """A list column from its values one after the other."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values if isinstance(values, pa.Array) else pa.array(values))
