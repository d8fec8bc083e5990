"""One pass over a wide matrix: what every column needs, as arrays and by number.

A task turns its rows into a matrix of doubles and gives off arrays, so what
moves does not have a row per cell. Names are attached at the end. Null, NaN
and infinite values count as missing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns of one side of a tile, and partial results that one task adds up.
TILE, FAN = 256, 16


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    values = batch.column("x").flatten()
    x = values.to_numpy(zero_copy_only=False).astype("float64").reshape(-1, width)
    return np.where(np.isfinite(x), x, np.nan)


def _wide(df: DataFrame, names: list[str], *others) -> DataFrame:
    return df.select(F.array(*[F.col(n).cast("double") for n in names]).alias("x"), *others)


def centres(df: DataFrame, names: list[str], rows: int = 1000) -> np.ndarray:
    """A value near those of each column: sums around it do not lose digits. Any finite numbers are right."""
    head = _wide(df.limit(rows), names).toArrow().combine_chunks()
    if not head.num_rows:
        return np.zeros(len(names))
    x = _matrix(head.to_batches()[0], len(names))
    n = np.isfinite(x).sum(axis=0)
    return np.nansum(x, axis=0) / np.maximum(n, 1)


def named(df: DataFrame, names: list[str], number: str = "i", name: str = "feature") -> DataFrame:
    return df.withColumn(name, F.get(F.array(*[F.lit(n) for n in names]), F.col(number)))


# sums per class


def class_moments(df: DataFrame, names: list[str]) -> DataFrame:
    """Per feature and label: count ``n``, mean ``m`` and variance ``v`` of the values."""
    centre, width = centres(df, names), len(names)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, total = None, {}
        for batch in batches:
            x = _matrix(batch, width) - centre
            kind = batch.column("label").type
            codes = batch.column("label").dictionary_encode()
            number = codes.indices.fill_null(len(codes.dictionary)).to_numpy()
            for k, label in enumerate([*codes.dictionary.to_pylist(), None]):
                part = x[number == k]
                if len(part):
                    there = np.isfinite(part)
                    part = np.where(there, part, 0.0)
                    found = np.stack([there.sum(axis=0), part.sum(axis=0), np.square(part).sum(axis=0)])
                    total[label] = total.get(label, 0.0) + found
        for label, (n, s, q) in total.items():
            arrays = [pa.array(np.arange(width, dtype="int32")), pa.array([label] * width, kind), pa.array(n), pa.array(s), pa.array(q)]
            yield pa.RecordBatch.from_arrays(arrays, ["i", "label", "n", "s", "q"])

    kind = df.schema["label"].dataType.simpleString()
    parts = _wide(df, names, "label").mapInArrow(sums, f"i int, label {kind}, n double, s double, q double")
    added = parts.groupBy("i", "label").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).filter("n > 0")
    shift = F.get(F.array(*[F.lit(float(c)) for c in centre]), F.col("i"))
    mean = F.col("s") / F.col("n")
    return named(added, names).select(
        "feature", "label", F.col("n").cast("long").alias("n"), (mean + shift).alias("m"), F.greatest(F.lit(0.0), F.col("q") / F.col("n") - mean * mean).alias("v")
    )


# products of pairs of columns

_PARTS = ("xy", "n", "sx", "sy", "xx", "yy")


def _products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For all pairs of a column of x and one of y, over the rows that have both: sums of ``_PARTS``."""
    m, w = np.isfinite(x).astype("float64"), np.isfinite(y).astype("float64")
    x, y = np.where(m > 0, x, 0.0), np.where(w > 0, y, 0.0)
    return np.stack([x.T @ y, m.T @ w, x.T @ w, m.T @ y, (x * x).T @ w, m.T @ (y * y)])


def pair_tiles(width: int) -> list[tuple[int, int]]:
    count = -(-width // TILE)
    return [(a, b) for a in range(count) for b in range(a, count)]


def correlated_pairs(df: DataFrame, names: list[str], above: float | None = None) -> DataFrame:
    """Pearson correlation (i, j, corr) of pairs of columns, i < j; with ``above`` only those that are stronger.

    Each task adds up one block of sums per tile of columns; the blocks of a
    tile are merged ``FAN`` at a time, and the last one compares its pairs.
    """
    centre, width = centres(df, names), len(names)
    tiles = pair_tiles(width)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list = [0.0] * len(tiles)
        seen = False
        for batch in batches:
            seen = seen or batch.num_rows > 0
            x = _matrix(batch, width) - centre
            for k, (a, b) in enumerate(tiles):
                total[k] = total[k] + _products(x[:, a * TILE : (a + 1) * TILE], x[:, b * TILE : (b + 1) * TILE])
        if seen:
            for k, block in enumerate(total):
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([block.tobytes()], pa.binary())], ["tile", "block"])

    def merged(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b.as_py()) for b in group["block"])
        return pa.table({"tile": group["tile"][:1], "block": pa.array([total.tobytes()], pa.binary())})

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, block in zip(batch.column("tile").to_pylist(), batch.column("block")):
                a, b = tiles[k]
                rows, columns = min(TILE, width - a * TILE), min(TILE, width - b * TILE)
                xy, n, sx, sy, xx, yy = np.frombuffer(block.as_py()).reshape(len(_PARTS), rows, columns)
                with np.errstate(all="ignore"):
                    vx, vy = np.maximum(0, xx - sx * sx / n), np.maximum(0, yy - sy * sy / n)
                    # What rounding leaves of the spread of a constant is none.
                    some = (n > 1) & (vx > xx * 1e-14) & (vy > yy * 1e-14)
                    corr = np.where(some, (xy - sx * sy / n) / np.sqrt(vx * vy), np.nan)
                i, j = np.indices(corr.shape)
                i, j = i + a * TILE, j + b * TILE
                wanted = (i < j) & (np.abs(corr) > above if above is not None else True)
                out = [pa.array(i[wanted].astype("int32")), pa.array(j[wanted].astype("int32")), pa.array(corr[wanted], from_pandas=True)]
                yield pa.RecordBatch.from_arrays(out, ["i", "j", "corr"])

    wide = _wide(df, names)
    blocks, parts = wide.mapInArrow(sums, "tile int, block binary"), wide.rdd.getNumPartitions()
    while parts > 1:
        # Blocks of one task and turn are at most FAN on average; the last turn has one group per tile.
        parts = -(-parts // FAN)
        group = F.pmod(F.monotonically_increasing_id(), F.lit(parts)) if parts > 1 else F.lit(0)
        dealt = blocks.withColumn("group", group.cast("int")).repartition(max(1, min(len(tiles) * parts, 2000)), "tile", "group")
        blocks = dealt.groupBy("tile", "group").applyInArrow(lambda g: merged(g.select(["tile", "block"])), "tile int, block binary")
    return blocks.mapInArrow(compared, "i int, j int, corr double")


# whole columns


def column_values(df: DataFrame, names: list[str]) -> DataFrame:
    """Per task and feature one row: ``i``, the finite values as bytes, and the hashes of their labels as bytes."""
    width = len(names)

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, label = _matrix(batch, width), batch.column("label").to_numpy()
            there = np.isfinite(x)
            values = [x[there[:, i], i].tobytes() for i in range(width)]
            labels = [label[there[:, i]].tobytes() for i in range(width)]
            arrays = [pa.array(np.arange(width, dtype="int32")), pa.array(values, pa.binary()), pa.array(labels, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["i", "x", "label"])

    return _wide(df, names, F.xxhash64("label").alias("label")).mapInArrow(turn, "i int, x binary, label binary")
