"""Spelling variants: words one edit apart, grouped under their frequent form.

Words are counted over all texts first. Two words are near if one inserted,
deleted or replaced code point makes them equal. If the shorter one has N code
points and its places are dealt into segments, the edit touches one segment, so
both words begin alike up to it and end alike behind it: a word goes to one
block per segment and length class, named by those two parts. Blocks are tiles
of padded code-point matrices; the lengths of the common prefix and suffix of
all pairs of a tile are found at once, and a pair is near if together they
reach the longer length minus one. A pair counts in the segment where its
common prefix ends, hence once.

A block of more than ``block`` words is dealt again by finer segments; one that
stays as large is cut into parts, and every two parts are a block of their own.
So no task holds an unbounded block, no pair leaves a task, and none is left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import words as W
from starloom.session import materialise

#: First byte of the letters U+00C0 to U+00FF; the other bytes of words are ASCII letters.
_LEAD = 0xC3
_LETTER = ((W.LOWER >= 0x61) & (W.LOWER <= 0x7A)) | (np.arange(256) == _LEAD)


@dataclass(frozen=True)
class Settings:
    """``segments`` per length at first, as many again in each of ``refinements``.

    ``ratio``: how much more frequent a form is than its variant. ``task_rows``: rows of blocks per task, on average.
    """

    least_length: int = 7
    least_count: int = 2
    ratio: int = 10
    segments: int = 3
    refinements: int = 2
    block: int = 1024
    task_rows: int = 150_000


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & np.uint32(1), table >> np.uint32(1) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


_CRC = _crc_table()


def crc32(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """CRC-32 of byte ranges that go on from the CRCs ``before``; all ranges advance by a byte at a time."""
    out = before.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    sizes = ends - starts
    by = np.argsort(-sizes, kind="stable")
    state, at = out[by], starts[by]
    left = np.searchsorted(-sizes[by], -np.arange(1, min(64, int(sizes.max(initial=0))) + 1), "right")
    for j, n in enumerate(left.tolist()):
        state[:n] = _CRC[(state[:n] ^ data[at[:n] + j]) & np.uint32(0xFF)] ^ (state[:n] >> np.uint32(8))
    out[by] = state ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(sizes > 64).tolist():
        out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(before[i]))
    return out.astype(np.int64)


def _count(chunk: pa.RecordBatch, s: Settings, slip: int) -> pa.RecordBatch:
    """Distinct words of a chunk of texts and how often they occur."""
    data, offsets = W.text_bytes(chunk.column("text"))
    data = W.LOWER[data]
    lead = data == _LEAD
    second = np.zeros(len(data), bool)
    second[1:] = lead[:-1]
    inside = _LETTER[data] | second
    starts, ends = W.borders(inside, offsets)
    heads = inside & ~second
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(heads, out=before[1:])
    long = before[ends] - before[starts] >= s.least_length
    starts, ends = starts[long], ends[long]
    sizes = before[ends] - before[starts]
    gone = np.zeros(len(data), bool)
    if slip and len(starts):
        docs = np.searchsorted(offsets, starts, "right") - 1
        named = [zlib.crc32(f"{'' if i is None else i}:".encode()) for i in chunk.column("doc_id").to_pylist()]
        h = crc32(data, starts, ends, np.array(named, np.uint32)[docs])
        hit = np.flatnonzero(h % slip == 0)
        place = np.flatnonzero(heads)[before[starts[hit]] + h[hit] % sizes[hit]]
        gone[place] = True
        gone[place[lead[place]] + 1] = True
        sizes[hit] -= 1
        starts, ends = starts[sizes >= s.least_length], ends[sizes >= s.least_length]
    taken = W.ranges(starts, ends - starts)
    lost = np.zeros(len(data) + 1, np.int64)
    np.cumsum(gone, out=lost[1:])
    cuts = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts - (lost[ends] - lost[starts]), out=cuts[1:])
    flat = data[taken[~gone[taken]]]
    found = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(flat)]).value_counts()
    return pa.RecordBatch.from_arrays([found.field(0), found.field(1)], ["word", "n"])


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings(), slip: int = 0) -> DataFrame:
    """Words (word, n) of all texts: runs of letters up to U+00FF, A to Z as a to z.

    With ``slip`` a run loses a code point where that number divides the CRC-32
    of ``<doc_id>:<run>``, which plants misspellings in known places.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter("text is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in W.chunks(batch, "text"):
                yield _count(chunk, settings, slip)

    found = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return found.filter(F.col("n") >= settings.least_count)


def _codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, a byte each, and where words begin; two-byte letters are U+00C0 to U+00FF."""
    data, offsets = W.text_bytes(column)
    lead = data == _LEAD
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(lead, out=before[1:])
    codes = data[~lead]
    return np.where(codes >= 0x80, codes | 0x40, codes).astype(np.uint8), offsets - before[offsets]


def _place(batch: pa.RecordBatch, s: Settings, finer: bool) -> pa.RecordBatch:
    """A row per word and block: its class (length of the shorter word), segment (from, to) and key."""
    codes, cuts = _codes(batch.column("word"))
    sizes = np.diff(cuts)
    if finer:
        row = np.arange(batch.num_rows)
        shorter, from_, to = (np.asarray(batch.column(c)) for c in ("shorter", "from", "to"))
    else:
        row = np.concatenate([np.arange(len(sizes)), np.flatnonzero(sizes > s.least_length)])
        shorter = sizes[row] - (np.arange(len(row)) >= len(sizes))
        from_, to = np.zeros(len(row), np.int64), shorter
    out = []
    for j in range(s.segments):
        a, b = from_ + (to - from_) * j // s.segments, from_ + (to - from_) * (j + 1) // s.segments
        some = np.flatnonzero(a < b)
        by = some[np.argsort(row[some], kind="stable")]
        out += [(row[by[turn]], shorter[by[turn]], a[by[turn]], b[by[turn]]) for turn in _turns(row[by])]
    parts = []
    for r, n, a, b in out:
        head = W.span_hashes(codes, cuts[r], cuts[r] + a)
        tail = W.span_hashes(codes, cuts[r + 1] - (n - b), cuts[r + 1])
        parts.append(W.mix(W.mix(head + n.astype(np.uint64)) + W.mix(tail ^ a.astype(np.uint64)) * np.uint64(3)))
    row, shorter, from_, to = (np.concatenate(x) for x in zip(*out))
    keys = np.concatenate(parts).view(np.int64)
    at = pa.array(row)
    arrays = [pa.array(keys), pa.array(shorter), pa.array(from_), pa.array(to), batch.column("word").take(at), batch.column("n").take(at)]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(np.zeros(len(row), np.int32))], [c.split()[0] for c in _BLOCK_ROWS.split(", ")])


def _turns(rows: np.ndarray) -> list[np.ndarray]:
    """Places of sorted row numbers, dealt so that no turn has a row twice (ranges to hash must ascend)."""
    first = np.searchsorted(rows, rows)
    nth = np.arange(len(rows)) - first
    return [np.flatnonzero(nth == k) for k in range(int(nth.max(initial=-1)) + 1)]


#: ``side`` is 0, or 1 and 2 for the two parts of a large block, whose words meet those of the other part only.
_BLOCK_ROWS = "key long, shorter long, from long, to long, word string, n long, side int"
#: Words of one side of a tile, and pairs that are compared at once.
SIDE, AT_ONCE = 32, 1 << 18


def _tiles(group: np.ndarray, side: int) -> np.ndarray:
    """Tiles (first row, rows, first row, rows) over sorted groups: all pairs of a group lie in one tile each.

    Small groups share a tile of up to twice ``side`` rows.
    """
    firsts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.append(firsts, len(group)))
    out = []
    small = sizes <= side
    if small.any():
        f, n = firsts[small], sizes[small]
        # Neighbouring small groups with no large one between them.
        run = np.cumsum(np.concatenate([[0], (f[1:] != f[:-1] + n[:-1]).astype(np.int64)]))
        home = np.stack([run, (np.cumsum(n) - n) // side])
        begin = np.flatnonzero(np.concatenate([[True], (home[:, 1:] != home[:, :-1]).any(0)]))
        rows = np.add.reduceat(n, begin)
        out.append(np.stack([f[begin], rows, f[begin], rows], axis=1))
    for f, n in zip(firsts[~small].tolist(), sizes[~small].tolist()):
        at = np.arange(0, n, side)
        x, y = np.triu_indices(len(at))
        size = np.minimum(side, n - at)
        out.append(np.stack([f + at[x], size[x], f + at[y], size[y]], axis=1))
    return np.concatenate(out)


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of all pairs of each tile; tiles x rows x places."""
    count = np.zeros((a.shape[0], a.shape[1], b.shape[1]), np.int32 if a.shape[2] > 255 else np.uint8)
    alive = np.ones(count.shape, bool)
    for j in range(a.shape[2]):
        alive &= a[:, :, None, j] == b[:, None, :, j]
        if not alive.any():
            break
        count += alive
    return count


def _near_pairs(codes, cuts, group, shorter, from_, to, part_of) -> tuple[np.ndarray, np.ndarray]:
    """Rows of near words of one group. Rows are sorted by length class and group."""
    sizes = np.diff(cuts)
    found = []
    classes = np.ceil(np.log2(np.maximum(shorter + 1, 32))).astype(np.int64)
    edges = np.flatnonzero(np.concatenate([[True], classes[1:] != classes[:-1]]))
    for lo, hi in zip(edges.tolist(), np.append(edges[1:], len(group)).tolist()):
        width = int(shorter[lo:hi].max()) + 1
        side = max(1, min(SIDE, AT_ONCE // width))
        tiles = _tiles(group[lo:hi], side)
        tiles[:, [0, 2]] += lo
        step = max(1, AT_ONCE // (4 * side * side * max(1, width // 64)))
        for i in range(0, len(tiles), step):
            part = tiles[i : i + step]
            most = int(part[:, [1, 3]].max())
            here = np.arange(most)
            x, y = part[:, 0, None] + here, part[:, 2, None] + here
            x_ok, y_ok = here < part[:, 1, None], here < part[:, 3, None]
            x, y = np.where(x_ok, x, lo), np.where(y_ok, y, lo)
            sides = []
            for rows in (x, y):
                place = np.arange(width)
                have = place < sizes[rows][..., None]
                head = cuts[rows][..., None] + place
                tail = cuts[rows + 1][..., None] - 1 - place
                sides.append([np.where(have, codes[np.where(have, at, 0)], 0).astype(np.uint8) for at in (head, tail)])
            prefix, suffix = (_shared(a, b) for a, b in zip(*sides))
            longer = np.maximum(sizes[x][:, :, None], sizes[y][:, None, :])
            near = prefix.astype(np.int64) + suffix >= longer - 1
            near &= (x[:, :, None] < y[:, None, :]) & x_ok[:, :, None] & y_ok[:, None, :]
            near &= group[x][:, :, None] == group[y][:, None, :]
            t, r, c = np.nonzero(near)
            p, q, cp = x[t, r], y[t, c], prefix[t, r, c].astype(np.int64)
            # Of two longer words the class above decides; the common prefix must end in this segment.
            own = (part_of[p] == 0) | (part_of[p] != part_of[q])
            own &= (np.minimum(sizes[p], sizes[q]) == shorter[p]) & (cp >= from_[p]) & ((cp < to[p]) | (to[p] == shorter[p]))
            found.append((p[own], q[own]))
    return tuple(np.concatenate(f) for f in zip(*found)) if found else (np.zeros(0, np.int64),) * 2


def _judge(rows: pa.Table) -> pa.Table:
    """For every word of a task's blocks: number of near words and the most frequent one."""
    key, shorter = np.asarray(rows["key"]), np.asarray(rows["shorter"])
    by = np.lexsort([key, shorter])
    key = key[by]
    often = np.concatenate([[False], key[1:] == key[:-1], [False]])
    by = by[often[1:] | often[:-1]]
    words = rows["word"].combine_chunks().take(pa.array(by))
    shorter, from_, to, n, side = (np.asarray(rows[c])[by] for c in ("shorter", "from", "to", "n", "side"))
    new = np.ones(len(by), bool)
    key = np.asarray(rows["key"])[by]
    new[1:] = (key[1:] != key[:-1]) | (shorter[1:] != shorter[:-1])
    if not len(by):
        x = y = np.zeros(0, np.int64)
    else:
        codes, cuts = _codes(words)
        x, y = _near_pairs(codes, cuts, np.cumsum(new), shorter, from_, to, side)
    this, other = np.concatenate([x, y]), np.concatenate([y, x])
    involved = np.unique(other)
    alphabetical = np.zeros(len(by), np.int64)
    alphabetical[involved[np.asarray(pc.array_sort_indices(words.take(pa.array(involved))))]] = np.arange(len(involved))
    order = np.lexsort([alphabetical[other], -n[other], this])
    this, other = this[order], other[order]
    first = np.flatnonzero(np.concatenate([[True], this[1:] != this[:-1]])) if len(this) else this
    counts = np.diff(np.append(first, len(this)))
    return pa.table({
        "word": words.take(pa.array(this[first])), "n_near": pa.array(counts, pa.int64()),
        "near": words.take(pa.array(other[first])), "near_n": pa.array(n[other[first]], pa.int64()),
    })


def _blocks(words: DataFrame, s: Settings) -> Iterator[DataFrame]:
    """Rows of blocks of about ``block`` words."""

    def deal(finer: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    yield _place(batch, s, finer)

        return run

    rows = words
    for turn in range(s.refinements + 1):
        placed = materialise(rows.mapInArrow(deal(turn > 0), _BLOCK_ROWS))
        # A block for a single place of the shorter words is bounded by the alphabet.
        sizes = placed.filter("to - from > 1").groupBy("key").agg(F.count("*").alias("size"))
        large = materialise(sizes.filter(F.col("size") > s.block))
        if large.isEmpty():
            yield placed
            return
        yield placed.join(large, "key", "left_anti")
        rows = placed.join(large, "key")
        if turn < s.refinements:
            rows = rows.drop("size")
    parts = F.ceil(F.col("size") / s.block).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    cut = rows.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")).withColumn("other", other)
    low, high = F.least("part", "other"), F.greatest("part", "other")
    side = F.when(low == high, F.lit(0)).when(F.col("part") == low, F.lit(1)).otherwise(F.lit(2))
    yield cut.select(F.xxhash64("key", low, high).alias("key"), "shorter", "from", "to", "word", "n", side.alias("side"))


def near_words(words: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """For each word with near ones: word, n_near, and the most frequent near word (near, near_n).

    Ties go to the smallest in code-point order. ``words`` has distinct words
    of letters up to U+00FF with their counts (word, n).
    """
    s, found = settings, None
    for placed in _blocks(words, s):
        tasks = max(1, placed.count() // s.task_rows)
        bucket = F.pmod(F.xxhash64("key"), F.lit(tasks)).alias("bucket")
        dealt = placed.select(bucket, "key", "shorter", "from", "to", "word", "n", "side").repartition(tasks, "bucket")
        near = dealt.groupBy("bucket").applyInArrow(_judge, "word string, n_near long, near string, near_n long")
        found = near if found is None else found.unionByName(near)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return merged.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """The last form of each word (word, root). A form is so much more frequent that chains are short."""
    steps = materialise(forms)
    roots = steps.select("word", F.col("form").alias("root"))
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = materialise(roots.join(further, "root", "left"))
        roots = joined.select("word", F.coalesce("next", "root").alias("root"))
        if joined.filter("next is not null").isEmpty():
            return roots


def spelling_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings(), slip: int = 0
) -> DataFrame:
    """Words with their forms: word, form, root, n, n_near, form_n.

    ``form`` is the most frequent near word if it is ``ratio`` times as
    frequent, else null; ``root`` the last form of the chain, the word itself
    without one. Null and empty texts have no words; repeated rows count
    as often as they occur; a null id counts as an empty one. Texts and words
    of any length are taken whole.
    """
    s = settings
    words = materialise(word_counts(docs, doc_id, text, s, slip))
    judged = materialise(words.join(near_words(words, s), "word", "left"))
    has_form = F.col("near_n") >= s.ratio * F.col("n")
    formed = judged.select(
        "word", F.when(has_form, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(has_form, F.col("near_n")).alias("form_n"),
    )
    roots = _roots(formed.filter("form is not null").select("word", "form"))
    joined = formed.join(roots, "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
