"""Cross-entropy difference by word bigrams over the corpus' own vocabulary.

Every word and every pair of neighbouring words of all texts is counted. Texts
are dealt into blocks, written once. A block sends its distinct n-grams, sorted,
to shards of the n-grams' hashes; a shard adds up the blocks and answers each
of them in the order of its question, so that totals return without a key per
n-gram. A hot n-gram is one entry per block. Nothing is collected or broadcast;
a task holds a block or a shard, whatever the size of the vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm import words as W
from starloom.session import materialise

FIELDS = [
    T.StructField("n_tokens", T.LongType(), False),
    T.StructField("target_loss", T.DoubleType(), True),
    T.StructField("background_loss", T.DoubleType(), True),
    T.StructField("score", T.DoubleType(), True),
]

#: Stands before the first and behind the last word of a text.
BORDER = np.uint64(0x5851F42D4C957F2D)
#: Counts and hashes are packed plane by plane.
PLANES = 8


@dataclass(frozen=True)
class Settings:
    """Bytes of text in a block, and those for which there is one shard; pseudo-counts of the two smoothings."""

    block_bytes: int = 8 << 20
    shard_bytes: int = 24 << 20
    word_prior: float = 0.1
    pair_prior: float = 200.0


def _pack(*columns: np.ndarray) -> bytes:
    """Arrays of one length, byte planes compressed; the length stands before."""
    n = len(columns[0])
    planes = b"".join(np.ascontiguousarray(c.astype("<u8").view(np.uint8).reshape(n, PLANES).T).tobytes() for c in columns)
    return n.to_bytes(8, "little") + (pa.compress(planes, codec="zstd", asbytes=True) if n else b"")


def _unpack(data: bytes, columns: int) -> list[np.ndarray]:
    n = int.from_bytes(data[:8], "little")
    if not n:
        return [np.zeros(0, np.uint64)] * columns
    planes = np.frombuffer(pa.decompress(data[8:], n * columns * PLANES, codec="zstd", asbytes=True), np.uint8)
    return [np.ascontiguousarray(p.T).view("<u8").ravel() for p in planes.reshape(columns, PLANES, n)]


def _blocks(docs: DataFrame, doc_id: str, text: str, limit: int) -> DataFrame:
    """Rows (block, bytes, ids, rows): whole rows of ``docs`` as compressed Arrow data, about ``limit`` bytes of text each."""

    def row(number: int, parts: list[pa.RecordBatch], size: int) -> pa.RecordBatch:
        table, sink = pa.Table.from_batches(parts).combine_chunks(), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_table(table)
        ids = W.lists(pa.concat_arrays(table.column(doc_id).chunks) if table.num_rows else pa.array([], table.schema.field(doc_id).type), np.array([table.num_rows]))
        block = (TaskContext.get().partitionId() << 32) + number
        return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([size]), ids, pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "bytes", "ids", "rows"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, number = [], 0, 0
        for batch in batches:
            for chunk in W.chunks(batch, text, min(limit, W.CHUNK_BYTES)):
                own = int(W.text_bytes(chunk.column(text))[1][-1])
                if parts and size + own > limit:
                    yield row(number, parts, size)
                    parts, size, number = [], 0, number + 1
                parts.append(chunk)
                size += own
        if parts:
            yield row(number, parts, size)

    ids = T.StructField("ids", T.ArrayType(docs.schema[doc_id].dataType))
    fields = [T.StructField("block", T.LongType()), T.StructField("bytes", T.LongType()), ids, T.StructField("rows", T.BinaryType())]
    return docs.mapInArrow(deal, T.StructType(fields))


def _rows(block: pa.Table) -> pa.Table:
    """The rows of ``docs`` in a block."""
    return pa.ipc.open_stream(block.column("rows")[0].as_buffer()).read_all().combine_chunks()


def _text(rows: pa.Table, text: str) -> pa.Array:
    return pa.concat_arrays(rows.column(text).chunks)


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words and pairs of the texts in turn: hashes of both, the text of each, and which are not the end of a text.

    A text's words are followed by a border; the pair at a place is the one that
    ends there, the first word's begins with a border. A border is counted as a
    word, so that every word occurs as often as it begins a pair. Hashes of
    words are odd, those of pairs even.
    """
    words = W.find_words(*W.text_bytes(column))
    some = np.flatnonzero(words.counts)
    ends = words.first[some + 1]
    hashes = np.insert(words.hashes(), ends, BORDER)
    docs = np.insert(words.docs(), ends, some)
    inner = np.ones(len(hashes), bool)
    inner[ends + np.arange(len(ends))] = False
    before = np.concatenate([[BORDER], hashes[:-1]]) if len(hashes) else hashes
    pairs = W.mix((before * np.uint64(0xD6E8FEB86659FD93) + hashes) ^ np.uint64(2))
    return hashes | np.uint64(1), pairs & ~np.uint64(1), docs, inner


def _cuts(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's part of the sorted hashes begins; an end follows."""
    borders = np.array([(i << 64) // shards for i in range(1, shards)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, borders), [len(keys)]])


def _ask(shards: int, text: str):
    """A block's distinct n-grams with their counts in the target and in all texts, a row per shard."""

    def ask(block: pa.Table, marks: pa.Table) -> pa.Table:
        rows = _rows(block)
        single, pairs, docs, _ = grams(_text(rows, text))
        marked = np.zeros(rows.num_rows, bool)
        marked[marks.column("pos").to_numpy()] = True
        keys, where = np.unique(np.concatenate([single, pairs]), return_inverse=True)
        counts = np.bincount(where, minlength=len(keys))
        target = np.bincount(where[np.tile(marked[docs], 2)], minlength=len(keys))
        cuts = _cuts(keys, shards)
        packs = []
        for i, j in zip(cuts[:-1], cuts[1:]):
            packs.append(_pack(np.diff(keys[i:j], prepend=np.uint64(0)), target[i:j], counts[i:j]))
        number = block.column("block")[0].as_py()
        W.give_back()
        return pa.table({"shard": pa.array(range(shards), pa.int32()), "block": pa.array([number] * shards, pa.int64()), "grams": pa.array(packs, pa.binary())})

    return ask


def _answer(shard: pa.Table) -> pa.Table:
    """For every block the totals of its n-grams, and the shard's part of the models' sizes and vocabulary."""
    asked = [_unpack(x.as_py(), 3) for x in shard.column("grams")]
    sizes = np.array([len(a[0]) for a in asked])
    keys, where = np.unique(np.concatenate([np.cumsum(a[0], dtype=np.uint64) for a in asked]), return_inverse=True)
    sums = np.zeros((2, len(keys)), np.int64)
    for k in (0, 1):
        np.add.at(sums[k], where, np.concatenate([a[k + 1] for a in asked]).astype(np.int64))
    words = (keys & np.uint64(1)) == 1
    ends = np.cumsum(sizes)
    packs = [_pack(sums[0, where[i:j]], sums[1, where[i:j]]) for i, j in zip(ends - sizes, ends)]
    n = len(asked)
    W.give_back()
    made = {k: pa.array([int(v)] * n, pa.int64()) for k, v in (("target", sums[0, words].sum()), ("background", sums[1, words].sum()), ("vocabulary", words.sum()))}
    return pa.table({"block": shard.column("block"), "shard": shard.column("shard"), "totals": pa.array(packs, pa.binary()), **made})


def losses(count: np.ndarray, pair: np.ndarray, context: np.ndarray, size: float, vocabulary: int, s: Settings) -> np.ndarray:
    """Negative log probability of words: pairs smoothed by words, words by equal chances of the vocabulary."""
    single = (count + s.word_prior) / (size + s.word_prior * vocabulary)
    return -np.log((pair + s.pair_prior * single) / (context + s.pair_prior))


def _judge(text: str, keep: list[str], s: Settings):
    def judge(block: pa.Table, answers: pa.Table) -> pa.Table:
        rows = _rows(block)
        single, pairs, docs, inner = grams(_text(rows, text))
        keys, where = np.unique(np.concatenate([single, pairs]), return_inverse=True)
        totals = np.zeros((2, len(keys)))
        order = np.argsort(answers.column("shard").to_numpy())
        parts = [_unpack(answers.column("totals")[int(i)].as_py(), 2) for i in order]
        for k in (0, 1):
            totals[k] = np.concatenate([p[k] for p in parts])
        sizes = [float(answers.column(c).to_numpy().sum()) for c in ("target", "background")]
        vocabulary = int(answers.column("vocabulary").to_numpy().sum())
        single_at, pair_at = where[: len(single)], where[len(single) :]
        border = np.searchsorted(keys, BORDER | np.uint64(1))
        # The word before: the last place of a text is its border, so the place before a first word is one too.
        before = np.concatenate([[border], single_at[:-1]]) if len(single) else single_at
        least = min(sizes)
        n = np.bincount(docs[inner], minlength=rows.num_rows)
        means = []
        for k in (0, 1):
            scale = least / sizes[k] if least else 1.0
            own = totals[k] * scale
            loss = losses(own[single_at[inner]], own[pair_at[inner]], own[before[inner]], sizes[k] * scale, max(vocabulary, 1), s)
            means.append(np.bincount(docs[inner], weights=loss, minlength=rows.num_rows) / np.maximum(n, 1))
        none = n == 0
        made = [pa.array(n.astype(np.int64)), *(pa.array(x, mask=none) for x in (means[0], means[1], means[0] - means[1]))]
        return pa.table([*(rows.column(c) for c in keep), *made], names=[*keep, *(f.name for f in FIELDS)])

    return judge


def cross_entropy_difference(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", settings: Settings = Settings(),
) -> DataFrame:
    """Adds ``n_tokens`` words, the mean loss per word under both models and their difference; below 0 is nearer to the target.

    The target are the documents whose labels are all 1, the background all
    documents. Words are what white space parts, as they are written. Both models have the vocabulary
    of all texts; the larger is scaled down to the size of the smaller, so that
    both are smoothed alike. Without a target its model is uniform. Texts
    without words, and nulls, have null losses. Columns named like a result are replaced.
    """
    s = settings
    blocks = materialise(_blocks(docs, doc_id, text, s.block_bytes))
    size = blocks.agg(F.sum("bytes")).first()[0] or 0
    shards = -(-size // s.shard_bytes) or 1
    good = labels.groupBy(F.col(doc_id).alias("__id")).agg((F.min(label) == 1).alias("good")).filter("good").select("__id")
    marks = blocks.select(F.col("block").alias("of"), F.posexplode("ids").alias("pos", "__id")).join(good.hint("merge"), "__id").select("of", "pos")
    whole = blocks.select("block", "rows").groupBy("block")
    asked = whole.cogroup(marks.groupBy("of")).applyInArrow(_ask(shards, text), "shard int, block long, grams binary")
    answered = asked.groupBy("shard").applyInArrow(_answer, "block long, shard int, totals binary, target long, background long, vocabulary long")
    new = {f.name.lower() for f in FIELDS}
    keep = [c for c in docs.columns if c.lower() not in new]
    schema = T.StructType([docs.schema[c] for c in keep] + FIELDS)
    return whole.cogroup(answered.groupBy("block")).applyInArrow(_judge(text, keep, s), schema)
