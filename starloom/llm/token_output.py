"""Token ids of a corpus as wavelet matrices, one compressed file per shard.

Documents are range-partitioned by id; every partition writes shards of
bounded size. A shard holds the ids of its documents one after the other as
bit-planes. Planes are cut into blocks that are compressed on their own, with
the number of ones before each, so access, counting and occurrence lookup
decompress only the blocks they touch.

Layout of a shard (numbers little-endian, 64-bit unless said otherwise):
magic ``WMX1``, then eight numbers: documents, tokens, planes, block size in
bits, length of the document table, blocks per plane, length of the
directories, 0. Then the compressed document table (ids, null flags, token
counts), the compressed directories (per plane and block: place in the data,
ones before it), and the blocks. Every compressed part is a zstd frame.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm import words as W
from starloom.llm.tokens import encoder
from starloom.llm.wavelet import BitPlane, WaveletMatrix

MAGIC = b"WMX1"
BLOCK_BITS = 1 << 17


@dataclass(frozen=True)
class Settings:
    """``end_id`` is appended to every document; ``shard_tokens`` bounds a shard (one document may exceed it)."""

    end_id: int = 1
    shard_tokens: int = 2_000_000
    partition_bytes: int = 16 << 20


def pack(ids: np.ndarray, doc_ids: np.ndarray, nulls: np.ndarray, counts: np.ndarray, block_bits: int = BLOCK_BITS) -> bytes:
    """One shard's file."""
    matrix = WaveletMatrix.of(ids)
    squeeze = zstandard.ZstdCompressor(level=1).compress
    table = squeeze(doc_ids.astype("<i8").tobytes() + nulls.astype("u1").tobytes() + counts.astype("<i8").tobytes())
    places, before, data, at = [], [], [], 0
    per_block = block_bits // 64
    for plane in matrix.planes:
        for i in range(0, len(plane.words), per_block):
            part = squeeze(plane.words[i : i + per_block].astype("<u8").tobytes())
            places.append(at), before.append(int(plane.before[i])), data.append(part)
            at += len(part)
        places.append(at), before.append(plane.ones)
    blocks = -(-(len(ids) // 64 + 1) // per_block)
    directory = squeeze(np.array([places, before], "<i8").tobytes())
    head = np.array([len(counts), len(ids), len(matrix.planes), block_bits, len(table), blocks, len(directory), 0], "<i8")
    return b"".join([MAGIC, head.tobytes(), table, directory, *data])


class Shard:
    """A shard's file opened: nothing but tables is decompressed until asked for."""

    def __init__(self, blob: bytes):
        if blob[:4] != MAGIC:
            raise ValueError("not a token shard")
        docs, self.size, planes, self.block_bits, table, blocks, directory, _ = np.frombuffer(blob[4:68], "<i8").tolist()
        grow = zstandard.ZstdDecompressor().decompress
        raw = grow(blob[68 : 68 + table])
        self.doc_ids = np.frombuffer(raw[: 8 * docs], "<i8")
        self.nulls = np.frombuffer(raw[8 * docs : 9 * docs], "u1").astype(bool)
        self.counts = np.frombuffer(raw[9 * docs :], "<i8")
        numbers = np.frombuffer(grow(blob[68 + table : 68 + table + directory]), "<i8").reshape(2, planes, blocks + 1)
        self.places, self.before = numbers
        self.blob, self.data = blob, 68 + table + directory
        self.zeros = self.size - self.before[:, -1]
        self._open: dict[tuple[int, int], BitPlane] = {}

    def block(self, plane: int, number: int) -> BitPlane:
        if (plane, number) not in self._open:
            a, b = self.places[plane, number], self.places[plane, number + 1]
            raw = zstandard.ZstdDecompressor().decompress(self.blob[self.data + a : self.data + b])
            words = np.frombuffer(raw, "<u8")
            self._open[plane, number] = BitPlane(words, 64 * len(words))
        return self._open[plane, number]

    def _rank(self, plane: int, at: int) -> int:
        number = min(at // self.block_bits, self.places.shape[1] - 2)
        inside = self.block(plane, number).rank(np.array([at - number * self.block_bits]))
        return int(self.before[plane, number]) + int(inside[0])

    def access(self, at: int) -> int:
        """The token at a place."""
        value = 0
        for plane in range(len(self.zeros)):
            number = at // self.block_bits
            bit = int(self.block(plane, number).get(np.array([at - number * self.block_bits]))[0])
            ones = self._rank(plane, at)
            at, value = (int(self.zeros[plane]) + ones, value << 1 | 1) if bit else (at - ones, value << 1)
        return value

    def _down(self, token: int, at: int) -> int:
        for plane in range(len(self.zeros)):
            ones = self._rank(plane, at)
            at = int(self.zeros[plane]) + ones if token >> (len(self.zeros) - 1 - plane) & 1 else at - ones
        return at

    def count(self, token: int, begin: int = 0, end: int | None = None) -> int:
        """Occurrences of a token between two places."""
        if token < 0 or token >> len(self.zeros):
            return 0
        return self._down(token, self.size if end is None else end) - self._down(token, begin)

    def _select(self, plane: int, n: int, one: bool) -> int:
        before = self.before[plane] if one else np.minimum(np.arange(self.before.shape[1]) * self.block_bits, self.size) - self.before[plane]
        number = int(np.searchsorted(before, n, "right")) - 1
        block = self.block(plane, number)
        inside = (block.select if one else block.select_zero)(np.array([n - int(before[number])]))
        return number * self.block_bits + int(inside[0])

    def find(self, token: int, n: int) -> int:
        """Place of the n-th occurrence, counted from 0; -1 if there are fewer."""
        if n < 0 or n >= self.count(token):
            return -1
        at = self._down(token, 0) + n
        for plane in range(len(self.zeros) - 1, -1, -1):
            one = bool(token >> (len(self.zeros) - 1 - plane) & 1)
            at = self._select(plane, at - int(self.zeros[plane]) if one else at, one)
        return at

    def all(self) -> np.ndarray:
        """All tokens."""
        planes = []
        for plane in range(len(self.zeros)):
            words = [self.block(plane, b).words for b in range(self.places.shape[1] - 1)]
            planes.append(BitPlane(np.concatenate(words), self.size))
            planes[-1].ones = int(self.before[plane, -1])
        self._open.clear()
        return WaveletMatrix(planes, self.size).all()


SHARDS = "part int, number int, n_docs long, n_tokens long, file binary"


def write_tokens(
    docs: DataFrame, to: str, path: str, spaces: str = "dropped", doc_id: str = "doc_id", text: str = "text",
    settings: Settings = Settings(),
) -> None:
    """Encode whole texts and write them in ascending order of ids, one shard per file, under ``to``.

    Null texts are empty, documents without an id come first, rows of one id
    are ordered by text. Spark's writer puts the files in place only when
    their task has ended, so lost executors leave no half files.
    """
    s = settings
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-total // s.partition_bytes) or 1

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, number, held, size = encoder(path, spaces), TaskContext.get().partitionId(), 0, [], 0

        def shard() -> pa.RecordBatch:
            ids, doc_ids, nulls, counts = (np.concatenate(x) for x in zip(*held))
            values = [part, number, len(counts), len(ids), pack(ids, doc_ids, nulls, counts)]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            names = ["part", "number", "n_docs", "n_tokens", "file"]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)

        for batch in batches:
            for chunk in W.chunks(batch, "text"):
                ids, counts = coder.encode(chunk.column("text"))
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, s.end_id)
                doc_ids = chunk.column("doc_id")
                held.append((ids, np.asarray(doc_ids.fill_null(0)), np.asarray(doc_ids.is_null()), counts + 1))
                size += len(ids)
                if size >= s.shard_tokens:
                    yield shard()
                    number, held, size = number + 1, [], 0
        if held:
            yield shard()

    ordered = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(encode, SHARDS).write.option("maxRecordsPerFile", 1).option("compression", "none").mode("overwrite").parquet(to)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document from the shards' files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before. Only the sizes of the
    shards pass through one task, a row for each file.
    """
    shards = spark.read.schema(SHARDS).parquet(path)
    order = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("part", "number", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)).alias("base"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, file in zip(batch.column("base").to_pylist(), batch.column("file"), strict=True):
                shard = Shard(file.as_py())
                raw = shard.all().astype("<u4").tobytes()
                ends = np.cumsum(shard.counts)
                begins = ends - shard.counts
                crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(shard.doc_ids, mask=shard.nulls), "start": pa.array(begins + base),
                    "n_tokens": pa.array(shard.counts), "ids_crc32": pa.array(crcs, pa.int64()),
                })

    joined = shards.select("part", "number", "file").join(starts, ["part", "number"]).select("base", "file")
    return joined.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")
