"""How often a series resembles a given subsequence.

All products of the query with the windows of a block come from one fast
transform; means and spreads of the windows from running sums. A block is a
series, or a part of a hot one with the rows behind it that its windows need.
Many short blocks share a call in Python.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.names import feature
from starloom.operators.series import Series

#: Rows of the series that a call in Python gets on average; a longer block is not cut.
CALL_ROWS = 65_536


def distances(x: np.ndarray, query: np.ndarray, normalize: bool = True) -> np.ndarray:
    """Euclidean distance of the query to every window of its length; normalised ones to mean 0 and deviation 1 each.

    Without a spread a normalised window is 0 everywhere, so its distance to a
    query that has one is the root of the length, and 0 to one that has none.
    """
    m, n = len(query), len(x) - len(query) + 1
    if n < 1:
        return np.zeros(0)
    shift = x.mean()
    x, q = x - shift, query - (query.mean() if normalize else shift)
    size = 1 << int(np.ceil(np.log2(len(x) + m)))
    products = np.fft.irfft(np.fft.rfft(x, size) * np.fft.rfft(q[::-1], size), size)[m - 1 : m - 1 + n]
    sums, squares = (np.concatenate([[0.0], np.cumsum(v)]) for v in (x, x * x))
    total, square = sums[m:] - sums[:n], squares[m:] - squares[:n]
    if not normalize:
        return np.sqrt(np.maximum(square - 2 * products + (q * q).sum(), 0.0))
    spread, own = np.sqrt(np.maximum(square / m - (total / m) ** 2, 0.0)), float(np.sqrt((q * q).mean()))
    # A window without a change has no spread, whatever rounding leaves of it.
    changes = np.concatenate([[0], np.cumsum(x[1:] != x[:-1])])
    flat = (changes[m - 1 :] == changes[:n]) | (spread == 0)
    if own == 0.0:
        return np.where(flat, 0.0, np.sqrt(m))
    corr = np.divide(products, m * own * spread, out=np.full(n, 0.5), where=~flat)
    return np.sqrt(np.maximum(2 * m * (1 - corr), 0.0))


def close_windows(rows: pa.Table, query: np.ndarray, threshold: float, normalize: bool = True) -> pa.Table:
    """Per block in ``rows`` its id and the number of windows from a row of its own that are close to the query."""
    ids = pc.rank(rows["id"], tiebreaker="dense").to_numpy()
    blocks, pos = rows["_block"].to_numpy(), rows["pos"].to_numpy()
    order = np.lexsort((pos, blocks, ids))
    ids, blocks = ids[order], blocks[order]
    flux, own = rows["flux"].to_numpy()[order], rows["_own"].to_numpy()[order]
    first = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (blocks[1:] != blocks[:-1])]))
    counts = np.zeros(len(first), dtype="int64")
    for i, (start, stop) in enumerate(zip(first, [*first[1:], len(order)])):
        close = distances(flux[start:stop], query, normalize) <= threshold
        counts[i] = (close & own[start : start + len(close)]).sum()
    return pa.table([rows["id"].take(pa.array(order[first])), pa.array(counts)], names=["id", "c"])


def _blocks(s: Series, reach: int) -> DataFrame:
    """Rows of all blocks with the ``reach`` rows behind each, and the call that a block falls to."""
    key, flux = F.col(s.keys[0]).alias("id"), F.col("flux").cast("double").alias("flux")
    rows = s.cold.select(key, F.lit(0).cast("long").alias("_block"), "pos", flux, F.lit(True).alias("_own"))
    if s.hot is not None:
        # Copies in front of a block start no window of its own, and a block may have no other rows.
        behind = F.col("pos") - (F.col("_block") + 1) * max(s.block, s.halo)
        hot = s.hot.filter(F.col("_own") | behind.between(0, reach - 1))
        rows = rows.unionByName(hot.select(key, F.col("_block").cast("long").alias("_block"), "pos", flux, "_own"))
    calls = max(1, -(-s.size // CALL_ROWS))
    return rows.withColumn("_call", F.pmod(F.xxhash64("id", "_block"), F.lit(calls)))


def query_similarity(s: Series, query: list[float], threshold: float, normalize: bool = True) -> DataFrame:
    """Per id the number of windows no farther than ``threshold`` from the query; 0 for series shorter than it."""
    key, wanted = s.keys[0], np.asarray(query, dtype="float64")
    name = feature("query_similarity_count", normalize=normalize, threshold=threshold)
    kind = s.cold.schema[key].dataType.simpleString()

    def count(rows: pa.Table) -> pa.Table:
        return close_windows(rows, wanted, threshold, normalize)

    if "pos" not in s.cold.columns or s.halo < len(wanted) - 1:
        s = s.located(halo=len(wanted) - 1)
    found = _blocks(s, len(wanted) - 1).groupBy("_call").applyInArrow(count, f"id {kind}, c long")
    return found.groupBy(F.col("id").alias(key)).agg(F.sum("c").alias(name))
