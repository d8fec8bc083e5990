"""Benchmark decontamination: every shard of documents is indexed, test phrases are searched in it.

A shard is a bounded chunk of rows. Its words become an FM-index; all phrases
go through one backward search over wavelet ranks, their occurrences are
located by sampled suffix positions, and the covered words merge to spans.
Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm import words as W
from starloom.llm.fm_index import FMIndex
from starloom.session import scratch_path

WINDOW = 10
#: Bytes of benchmark text that are held at a time; more makes further passes.
BLOCK_BYTES = 8 << 20

_SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
FIELDS = [
    T.StructField("n_words", T.LongType(), False),
    T.StructField("n_hit", T.LongType(), False),
    T.StructField("items", T.ArrayType(T.StringType()), False),
    T.StructField("spans", T.ArrayType(_SPAN), False),
    T.StructField("word_spans", T.ArrayType(_SPAN), False),
]
_LETTER_START = (np.arange(256) & 0xC0) != 0x80


@dataclass
class Phrases:
    """Distinct windows of some items, flush right as word hashes, and the items of each."""

    names: list[str]
    words: np.ndarray
    lengths: np.ndarray
    first: np.ndarray
    items: np.ndarray


def phrases(rows: list[tuple[str, str]], window: int) -> Phrases:
    names = sorted({name for name, _ in rows})
    number = {name: i for i, name in enumerate(names)}
    data, offsets = W.text_bytes(pa.array([text for _, text in rows], pa.string()))
    words = W.find_words(data, offsets, W.LETTERS, lower=True)
    hashes, counts = words.hashes(), words.counts
    starts = W.windows(words, window)
    short = np.flatnonzero((counts > 0) & (counts < window))
    starts = np.concatenate([starts, words.first[short]]).astype(np.int64)
    lengths = np.concatenate([np.full(len(starts) - len(short), window), counts[short]]).astype(np.int64)
    owner = np.array([number[name] for name, _ in rows], np.int64)
    items = owner[np.searchsorted(words.first, starts, "right") - 1] if len(starts) else np.zeros(0, np.int64)
    table = np.zeros((len(starts), window), np.uint64)
    for j in range(1, window + 1):
        some = lengths >= j
        table[some, -j] = hashes[(starts + lengths - j)[some]]
    keyed = np.concatenate([lengths[:, None].astype(np.uint64), table], axis=1)
    distinct, which = np.unique(keyed, axis=0, return_inverse=True)
    pairs = np.unique(np.stack([which.ravel(), items], axis=1), axis=0) if len(starts) else np.zeros((0, 2), np.int64)
    first = np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1))
    return Phrases(names, distinct[:, 1:], distinct[:, 0].astype(np.int64), first, pairs[:, 1])


def _runs(hit: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first and behind-last place of each run of hits within a text."""
    edge = np.zeros(len(hit) + 1, bool)
    edge[first] = True
    padded = np.concatenate([[False], hit, [False]])
    starts = np.flatnonzero(padded[1:-1] & (~padded[:-2] | edge[:-1]))
    ends = np.flatnonzero(padded[1:-1] & (~padded[2:] | edge[1:])) + 1
    return np.searchsorted(first, starts, "right") - 1, starts, ends


def _spans(docs: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: int) -> pa.Array:
    counts = np.bincount(docs, minlength=rows)
    return W.lists(pa.StructArray.from_arrays([pa.array(starts), pa.array(ends)], ["start", "end"]), counts)


def search(column: pa.Array, wanted: Phrases, earlier: tuple[pa.Array, pa.Array] | None = None) -> list[pa.Array]:
    """Index one shard and look up all phrases; ``earlier`` are word spans and items of earlier passes."""
    data, offsets = W.text_bytes(column)
    words = W.find_words(data, offsets, W.LETTERS, lower=True)
    rows, docs = len(offsets) - 1, words.docs()
    vocabulary, symbols = np.unique(words.hashes(), return_inverse=True)
    # Symbol 1 ends a text, so that no window goes from one to the next.
    text = np.ones(len(docs) + rows, np.int64)
    text[np.arange(len(docs)) + docs] = symbols.ravel() + 2
    at = np.searchsorted(vocabulary, wanted.words)
    known = np.zeros(wanted.words.shape, bool)
    if len(vocabulary):
        known = vocabulary[np.minimum(at, len(vocabulary) - 1)] == wanted.words
    index = FMIndex(text)
    low, high = index.search(np.where(known, at + 2, -1), wanted.lengths)
    which, places = index.occurrences(low, high)
    home = np.searchsorted(words.first + np.arange(rows + 1), places, "right") - 1
    hit = W.covered(len(docs), places - home, wanted.lengths[which])
    found = np.unique(home * (len(wanted.lengths) + 1) + which)
    home, which = found // (len(wanted.lengths) + 1), found % (len(wanted.lengths) + 1)
    counts = np.diff(wanted.first)[which]
    pairs = np.unique(np.repeat(home, counts) * max(1, len(wanted.names)) + wanted.items[W.ranges(wanted.first[which], counts)])
    owners = pairs // max(1, len(wanted.names))
    names = [wanted.names[i] for i in (pairs % max(1, len(wanted.names))).tolist()]
    if earlier:
        spans, items = earlier
        flat = spans.flatten()
        begin = np.asarray(flat.field(0)) + words.first[np.repeat(np.arange(rows), np.diff(np.asarray(spans.offsets)))]
        size = np.asarray(flat.field(1)) - np.asarray(flat.field(0))
        hit |= W.covered(len(docs), begin, size)
        both = {(d, n) for d, n in zip(owners.tolist(), names)}
        both |= {(d, n) for d, row in enumerate(items.to_pylist()) for n in row}
        merged = sorted(both)
        owners, names = np.array([d for d, _ in merged], np.int64), [n for _, n in merged]
    text_of, starts, ends = _runs(hit, words.first)
    letters = np.zeros(len(data) + 1, np.int64)
    if len(starts):
        np.cumsum(_LETTER_START[data], out=letters[1:])
    origin = letters[offsets[text_of]]
    hits = np.bincount(docs[hit], minlength=rows)
    return [
        pa.array(words.counts),
        pa.array(hits),
        W.lists(pa.array(names, pa.string()), np.bincount(owners, minlength=rows)),
        _spans(text_of, letters[words.starts[starts]] - origin, letters[words.ends[ends - 1]] - origin, rows),
        _spans(text_of, starts - words.first[text_of], ends - words.first[text_of], rows),
    ]


def _blocks(benchmark: DataFrame, item_id: str, text: str, limit: int) -> Iterator[list[tuple[str, str]]]:
    """The items in blocks of bounded size, so that the driver and a task hold one at a time."""
    items = benchmark.select(F.col(item_id).cast("string").alias("name"), F.col(text).alias("text")).filter(
        "name is not null and text is not null"
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // limit) or 1
    for b in range(blocks):
        yield [tuple(r) for r in items.filter(F.pmod(F.xxhash64("name", "text"), F.lit(blocks)) == b).collect()]


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Adds to each row what of the benchmark it holds.

    ``n_words``, ``n_hit`` (words inside an occurrence of a window), ``items``
    (sorted ids), ``spans`` (merged, in characters, end excluded), and
    ``word_spans``. Words are lower-cased runs of letters and digits; an item
    shorter than a window is one window. A null or empty text holds nothing;
    items without an id or text are skipped, items of one id are one item, an
    empty benchmark hits nothing. Columns named like a result are replaced.
    A benchmark of several blocks takes a written pass for each, so that no more
    than one block is broadcast or held by a task; at most two passes' rows are stored.
    """
    context = docs.sparkSession.sparkContext
    names = {f.name for f in FIELDS}
    out = docs.drop(*[c for c in docs.columns if c.lower() in names])
    wanted, path = None, None
    for i, rows in enumerate(_blocks(benchmark, item_id, item_text, block_bytes)):
        if wanted is not None:
            before, path = path, scratch_path(docs.sparkSession)
            out.write.parquet(path)
            out = docs.sparkSession.read.schema(out.schema).parquet(path)
            wanted.destroy()
            if before:
                _delete(docs.sparkSession, before)
        wanted = context.broadcast(phrases(rows, window))

        def kernel(batch: pa.RecordBatch, wanted=wanted, more: bool = i > 0) -> list[pa.Array]:
            earlier = (batch.column("word_spans"), batch.column("items")) if more else None
            return search(batch.column(text), wanted.value, earlier)

        out = W.map_texts(out, text, FIELDS, kernel)
    return out


def without_spans(text: str = "text", spans: str = "spans") -> Column:
    """The text without the characters of its spans."""
    edge = F.expr(
        f"""transform(sequence(0, size({spans})), i -> substring({text},
            if(i = 0, 0, {spans}[greatest(i - 1, 0)].end) + 1,
            if(i = size({spans}), length({text}), {spans}[least(i, size({spans}) - 1)].start)
              - if(i = 0, 0, {spans}[greatest(i - 1, 0)].end)))"""
    )
    return F.when(F.size(spans) > 0, F.array_join(edge, "")).otherwise(F.col(text))
