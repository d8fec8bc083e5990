"""Substring dedup: word windows that an earlier document holds too are removed.

Windows are dealt to shards by their smallest word sequence of ``anchor``
words: all copies of a window have the same one, so they meet in one shard,
and neighbouring windows with the same one travel as one segment of text.
Every shard indexes its distinct segments in an FM-index and streams them
through it: the backward search gives each window's matches, the documents of
the matched suffixes the smallest owner.

Equal segments are merged before the shuffle (per chunk of rows) and again in
the shard; only the smallest document of a segment still has to be judged. The
others are known to be copies, whose ranges go through shards of their documents.
So a passage that a third of all documents share is one segment per chunk, not
one per document. Word sequences whose segments could exceed a shard, such as
those of a header inside different texts, are counted before and are no anchors;
a window of such sequences alone goes by its own hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm import words as W
from starloom.llm.fm_index import FMIndex
from starloom.session import materialise


@dataclass(frozen=True)
class Settings:
    """``shard_bytes``: text per shard, on average, before neighbouring words are added."""

    window: int = 13
    anchor: int = 4
    shard_bytes: int = 6 << 20
    chunk_bytes: int = 6 << 20


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbours."""
    span = 1
    while span * 2 <= width:
        values, span = np.minimum(values[: len(values) - span], values[span:]), span * 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _pack(*arrays: np.ndarray | bytes) -> bytes:
    parts = [a if isinstance(a, bytes) else np.ascontiguousarray(a, np.int64).tobytes() for a in arrays]
    sizes = np.array([len(p) for p in parts], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(sizes + b"".join(parts))


def _unpack(blob: bytes, n: int) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes = np.frombuffer(raw[: 8 * n], np.int64)
    ends = 8 * n + np.cumsum(sizes)
    return [raw[e - s : e] for s, e in zip(sizes.tolist(), ends.tolist())]


def _numbers(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.int64)


#: What a hot word sequence counts as when the smallest is looked for.
LAST = np.uint64(0xFFFFFFFFFFFFFFFF)


def _without(values: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """The hashes with hot ones last."""
    if not len(hot):
        return values
    return np.where(hot[np.minimum(np.searchsorted(hot, values), len(hot) - 1)] == values, LAST, values)


def _hot(rows: DataFrame, s: Settings, total: int) -> np.ndarray:
    """Hashes of word sequences that could be anchors of more text than ``shard_bytes``; no other one is of twice that.

    An occurrence counts as the longest segment around it. A chunk leaves out
    what is below its part of the bound. At most 22 sequences for each shard
    can be hot.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in W.chunks(batch, "text", s.chunk_bytes):
                words = W.find_words(*W.text_bytes(chunk.column("text")))
                values = W.sequence_hashes(words.hashes(), s.anchor)[W.windows(words, s.anchor)] if len(words.starts) else np.zeros(0, np.uint64)
                each = (2 * s.window - s.anchor) * len(words.data) / max(1, len(words.starts))
                least = s.shard_bytes * len(words.data) / total
                if least > each:
                    values = values[W.twins(values)[0]]
                keys, counts = np.unique(values, return_counts=True)
                some = counts * each >= least
                yield pa.RecordBatch.from_arrays([pa.array(keys[some].view(np.int64)), pa.array(counts[some] * each)], ["hash", "bytes"])

    counted = rows.select("text").mapInArrow(count, "hash long, bytes double").groupBy("hash").agg(F.sum("bytes").alias("bytes"))
    found = counted.filter(F.col("bytes") > s.shard_bytes).select("hash").collect()
    return np.sort(np.array([r[0] for r in found], np.int64).view(np.uint64))


def _deal(batch: pa.RecordBatch, s: Settings, shards: int, hot: np.ndarray = np.zeros(0, np.uint64)) -> Iterator[tuple[int, bytes]]:
    """Segments of one chunk by shard, equal ones merged."""
    ids, keys = np.asarray(batch.column("doc_id")), np.asarray(batch.column("key"))
    data, offsets = W.text_bytes(batch.column("text"))
    words = W.find_words(data, offsets)
    starts = W.windows(words, s.window)
    if not len(starts):
        return
    docs = words.docs()
    # An anchor sequence of one text only: windows lie in one text.
    hashes = words.hashes()
    anchors = _least(_without(W.sequence_hashes(hashes, s.anchor), hot), s.window - s.anchor + 1)[starts]
    lone = anchors == LAST
    if lone.any():
        anchors[lone] = W.sequence_hashes(hashes, s.window)[starts[lone]]
    new = np.ones(len(starts), bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (starts[1:] != starts[:-1] + 1)
    begin = np.flatnonzero(new)
    first, last = starts[begin], starts[np.append(begin[1:], len(starts)) - 1] + s.window
    # The words of all texts, one space or line end after each.
    kept = W.ranges(words.starts, words.ends - words.starts + 1)
    kept[np.cumsum(words.ends - words.starts + 1) - 1] = len(data)
    plain = np.append(data, np.uint8(0x20))[kept].tobytes()
    place = np.zeros(len(words.starts) + 1, np.int64)
    np.cumsum(words.ends - words.starts + 1, out=place[1:])
    texts = [plain[a:b] for a, b in zip(place[first].tolist(), (place[last] - 1).tolist())]
    owners, at = ids[docs[first]], first - words.first[docs[first]]
    number: dict[bytes, int] = {}
    which = np.array([number.setdefault(t, len(number)) for t in texts], np.int64)
    least = np.full(len(number), np.iinfo(np.int64).max)
    np.minimum.at(least, which, owners)
    shard = np.zeros(len(number), np.int64)
    shard[which] = (anchors[begin] % np.uint64(shards)).astype(np.int64)
    mine = owners == least[which]
    names = list(number)
    by = np.argsort(shard, kind="stable")
    renumber = np.empty(len(by), np.int64)
    cuts = np.searchsorted(shard[by], np.arange(shards + 1))
    renumber[by] = np.arange(len(by)) - cuts[shard[by]]
    lengths = last - first
    judged = np.flatnonzero(mine)
    use = judged[np.argsort(shard[which[judged]], kind="stable")]
    use_cuts = np.searchsorted(shard[which[use]], np.arange(shards + 1))
    # Known copies need no shard of their segment: neighbouring ranges become one and go by document.
    copy = np.flatnonzero(~mine)
    text_of, from_, to = docs[first[copy]], at[copy], at[copy] + lengths[copy]
    opens = np.ones(len(copy), bool)
    opens[1:] = (text_of[1:] != text_of[:-1]) | (from_[1:] > to[:-1])
    heads = np.flatnonzero(opens)
    text_of, from_, to = text_of[heads], from_[heads], to[np.append(heads[1:], len(copy))[: len(heads)] - 1]
    dealt = (W.mix(ids[text_of].astype(np.int64).view(np.uint64)) % np.uint64(shards)).astype(np.int64)
    order = np.argsort(dealt, kind="stable")
    copy_cuts = np.searchsorted(dealt[order], np.arange(shards + 1))
    for k in np.flatnonzero(np.diff(cuts) + np.diff(copy_cuts)).tolist():
        segments = by[cuts[k] : cuts[k + 1]]
        own, copies = use[use_cuts[k] : use_cuts[k + 1]], order[copy_cuts[k] : copy_cuts[k + 1]]
        yield k, _pack(
            b"\n".join([names[i] for i in segments.tolist()]), least[segments],
            renumber[which[own]], at[own], keys[docs[first[own]]], ids[text_of[copies]], keys[text_of[copies]], from_[copies], to[copies],
        )


def _judge(blobs: list[bytes], s: Settings, hot: np.ndarray = np.zeros(0, np.uint64)) -> tuple[np.ndarray, ...]:
    """Removed word ranges (document, key of its text, first, behind last) that one shard finds."""
    number: dict[bytes, int] = {}
    owners, segments, uses, out = [], [], [], []
    for blob in blobs:
        text, least, use, at, key, *copies = _unpack(blob, 9)
        out.append(tuple(map(_numbers, copies)))
        if not text:
            continue
        here = np.array([number.setdefault(t, len(number)) for t in text.split(b"\n")], np.int64)
        least = _numbers(least)
        owners.append(least), segments.append(here)
        uses.append((here[_numbers(use)], least[_numbers(use)], _numbers(key), _numbers(at)))
    names = list(number)
    if not names:
        return tuple(np.concatenate(x) for x in zip(*out))
    first_owner = np.full(len(names), np.iinfo(np.int64).max)
    np.minimum.at(first_owner, np.concatenate(segments), np.concatenate(owners))
    which, doc, key, at = (np.concatenate(x) for x in zip(*uses))
    joined = np.frombuffer(b"\n".join(names) + b"\n", np.uint8)
    ends = np.flatnonzero(joined == 0x0A) + 1
    words = W.find_words(joined, np.concatenate([[0], ends]))
    counts, hashes = words.counts, words.hashes()
    later = doc > first_owner[which]
    out.append((doc[later], key[later], at[later], at[later] + counts[which[later]]))
    which, doc, key, at = which[~later], doc[~later], key[~later], at[~later]

    # Segments whose anchor no other segment has hold no window of another one.
    anchor = np.minimum.reduceat(
        np.where(
            np.arange(len(hashes)) + s.anchor <= np.repeat(words.first[1:], counts),
            np.append(_without(W.sequence_hashes(hashes, s.anchor), hot), np.zeros(s.anchor - 1, np.uint64))[: len(hashes)],
            LAST,
        ),
        words.first[:-1],
    )
    _, group, sizes = np.unique(anchor, return_inverse=True, return_counts=True)
    some = np.flatnonzero(sizes[group] > 1)
    if len(some):
        parts = W.ranges(words.first[some], counts[some])
        _, symbols = np.unique(hashes[parts], return_inverse=True)
        home = np.repeat(np.arange(len(some)), counts[some])
        text = np.ones(len(parts) + len(some), np.int64)
        text[np.arange(len(parts)) + home] = symbols.ravel() + 2
        segment_of = np.append(np.repeat(np.arange(len(some)), counts[some] + 1), 0)
        index = FMIndex(text, keep_order=True)
        owner_of = first_owner[some][segment_of[index.order]]
        # Matching statistics up to the threshold, for every distinct window.
        starts = np.cumsum(counts[some] + 1) - counts[some] - 1
        in_segment = counts[some] - s.window + 1
        windows = W.ranges(starts, in_segment)
        _, one, same = np.unique(
            W.sequence_hashes(hashes[parts], s.window)[windows - np.repeat(np.arange(len(some)), in_segment)],
            return_index=True, return_inverse=True,
        )
        patterns = text[windows[one][:, None] + np.arange(s.window)]
        low, high = index.search(patterns, np.full(len(one), s.window))
        # Ranges of different windows do not overlap: one pass over the owners finds each minimum.
        by = np.argsort(low)
        edges = np.stack([low[by], high[by]], axis=1).ravel()
        smallest = np.empty(len(one), np.int64)
        smallest[by] = np.minimum.reduceat(np.append(owner_of, 0), edges)[::2]
        copied = smallest[same.ravel()] < np.repeat(first_owner[some], in_segment)
        # Runs of copied windows within a segment, for each use of the segment.
        firsts = np.cumsum(in_segment) - in_segment
        edge = np.zeros(len(copied) + 1, bool)
        edge[firsts] = True
        edge[-1] = True
        wide = np.concatenate([[False], copied, [False]])
        begin = np.flatnonzero(copied & (~wide[:-2] | edge[:-1]))
        stop = np.flatnonzero(copied & (~wide[2:] | edge[1:]))
        run_home = np.searchsorted(firsts, begin, "right") - 1
        from_, to = begin - firsts[run_home], stop - firsts[run_home] + s.window
        run_first = np.searchsorted(run_home, np.arange(len(some) + 1))
        place = np.full(len(names), -1)
        place[some] = np.arange(len(some))
        used = place[which]
        which, doc, key, at = used[used >= 0], doc[used >= 0], key[used >= 0], at[used >= 0]
        per_use = np.diff(run_first)[which]
        runs = W.ranges(run_first[which], per_use)
        out.append((np.repeat(doc, per_use), np.repeat(key, per_use), np.repeat(at, per_use) + from_[runs], np.repeat(at, per_use) + to[runs]))
    return tuple(np.concatenate(x) for x in zip(*out))


FIELDS = [
    T.StructField("n_words", T.LongType(), False),
    T.StructField("n_removed", T.LongType(), False),
    T.StructField("kept_text", T.StringType(), False),
]


def _cut(batch: pa.RecordBatch) -> list[pa.Array]:
    data, offsets = W.text_bytes(batch.column("text"))
    words = W.find_words(data, offsets)
    removed = batch.column("removed")
    docs = np.repeat(np.arange(batch.num_rows), np.asarray(removed.value_lengths().fill_null(0)))
    flat = removed.flatten()
    # Ranges never reach past the text they were found in.
    start = words.first[docs] + np.asarray(flat.field(0), np.int64)
    end = np.minimum(words.first[docs] + np.asarray(flat.field(1), np.int64), words.first[docs + 1])
    gone = W.covered(int(words.first[-1]), np.minimum(start, end), end - np.minimum(start, end))
    raw, begins, ends = data.tobytes(), words.starts, words.ends
    texts = []
    for d in range(batch.num_rows):
        i, j = words.first[d], words.first[d + 1]
        keep = np.flatnonzero(~gone[i:j]) + i
        texts.append(b" ".join([raw[a:b] for a, b in zip(begins[keep].tolist(), ends[keep].tolist())]))
    lost = np.bincount(words.docs()[gone], minlength=batch.num_rows)
    return [pa.array(words.counts), pa.array(lost), pa.array(texts, pa.binary()).cast(pa.string())]


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows (doc_id, key, text); the key tells texts of one id apart and is 0 for ids that occur once.

    Only ids that occur more than once are joined, so texts are not moved where there are none.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    again = materialise(rows.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id", F.lit(True).alias("again")))
    if again.isEmpty():
        return rows.select("doc_id", F.lit(0).cast("long").alias("key"), "text")
    marked = rows.join(again, "doc_id", "left")
    return marked.select("doc_id", F.when(F.col("again"), F.xxhash64("text")).otherwise(F.lit(0)).alias("key"), "text")


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Word ranges (doc_id, key, start, end) that an earlier document holds too. They may overlap.

    ``key`` is 0, or for an id with several rows the 64-bit hash of the text.
    """
    return _spans(_keyed(docs, doc_id, text), settings)


def _spans(keyed: DataFrame, s: Settings) -> DataFrame:
    rows = keyed.filter("doc_id is not null and text is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = -(-total // s.shard_bytes) or 1
    hot = rows.sparkSession.sparkContext.broadcast(_hot(rows, s, total) if shards > 1 else np.zeros(0, np.uint64))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in W.chunks(batch, "text", s.chunk_bytes):
                for k, blob in _deal(chunk, s, shards, hot.value):
                    yield pa.RecordBatch.from_pydict({"shard": pa.array([k], pa.int64()), "segments": pa.array([blob], pa.binary())})

    def judge(group: pa.Table) -> pa.Table:
        doc, key, start, end = _judge([b.as_py() for b in group.column("segments")], s, hot.value)
        return pa.table({"doc_id": pa.array(doc), "key": pa.array(key), "start": pa.array(start, pa.int64()), "end": pa.array(end, pa.int64())})

    dealt = rows.mapInArrow(deal, "shard long, segments binary")
    return dealt.repartition(shards, "shard").groupBy("shard").applyInArrow(judge, "doc_id long, key long, start long, end long")


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_text.

    A null text has no words; a text shorter than a window stays as it is. A
    row without an id is nobody's earlier document and loses nothing. Rows of
    one id are judged each by its own text; equal rows get equal results.
    """
    keyed = _keyed(docs, doc_id, text)
    removed = _spans(keyed, settings).groupBy("doc_id", "key").agg(F.collect_list(F.struct("start", "end")).alias("removed"))
    joined = keyed.join(removed, ["doc_id", "key"], "left").drop("key").withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))
    return W.map_texts(joined, "text", FIELDS, _cut, drop=("text", "removed"))
