"""Periodograms of many even frequencies from one transform per series.

Samples are spread onto an even grid of phases with Gaussian weights, a fast
transform turns the grid into all sums of waves at once, and dividing by the
transform of the weights undoes the spreading (Greengard and Lee, SIAM Review
46, 2004). The error is about 1e-10 of the summed weights. The grid's size
follows the number of frequencies, not of samples.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from starloom.operators.series import Series

#: Grid points on either side of a sample.
SPREAD = 12
#: Samples spread at once, samples of a hot series in a piece, and pieces added up by a task.
SPREAD_ROWS = 16_384
PIECE_ROWS = 250_000
MERGED = 16


def _smooth(least: int) -> int:
    """The smallest length from ``least`` on that has no prime factor but 2, 3 and 5."""
    odd = [3**b * 5**c for b in range(least.bit_length()) for c in range(least.bit_length())]
    return min(v << max(0, math.ceil(math.log2(least / v))) for v in odd if v <= 2 * least)


class Grid:
    """Phases 0..2 pi for waves of up to ``top`` turns per unit."""

    def __init__(self, top: int):
        self.top = top
        modes = 2 * (top + 1)
        self.size = _smooth(max(64, 2 * modes))
        ratio = self.size / modes
        self.tau = math.pi * SPREAD / (modes**2 * ratio * (ratio - 0.5))
        k = np.arange(top + 1)
        self.undo = np.sqrt(math.pi / self.tau) * np.exp(k * k * self.tau)

    def spread(self, phase: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Rows of sums at the grid points; a row for each row of weights. Phases are in turns, 0 to 1."""
        out, reach = np.zeros((len(weights), self.size)), np.arange(-SPREAD + 1, SPREAD + 1)
        for first in range(0, len(phase), SPREAD_ROWS):
            part = phase[first : first + SPREAD_ROWS, None]
            at = np.floor(part * self.size).astype(np.int64) + reach
            gap = (part - at / self.size) * 2 * math.pi
            kernel = np.exp(-gap * gap / (4 * self.tau))
            at = (at % self.size).ravel()
            for i, w in enumerate(weights):
                added = np.bincount(at, (w[first : first + SPREAD_ROWS, None] * kernel).ravel(), minlength=self.size)
                out[i] = out[i] + added if first else added
        return out

    def waves(self, grid: np.ndarray) -> np.ndarray:
        """Sums of weight times exp(i k phase) for k from 0 to ``top``."""
        return np.fft.rfft(grid)[..., : self.top + 1].conj() / self.size * self.undo


def power(grid: Grid, sums: np.ndarray, n: float, mean: float, square: float, count: int) -> np.ndarray:
    """Power at 1..count steps from the grids of values and of ones; ``square`` is the mean of the squared values."""
    values, ones = grid.waves(sums) / n
    k = np.arange(1, count + 1)
    first, second, y = ones[k], ones[2 * k], values[k]
    mc, ms = first.real, first.imag
    yy, yc, ys = square - mean * mean, y.real - mean * mc, y.imag - mean * ms
    cc, ss, cs = (1 + second.real) / 2 - mc * mc, (1 - second.real) / 2 - ms * ms, second.imag / 2 - mc * ms
    bottom = yy * (cc * ss - cs * cs)
    with np.errstate(all="ignore"):
        return np.where(bottom > 1e-12 * yy, (ss * yc * yc + cc * ys * ys - 2 * cs * yc * ys) / bottom, np.nan)


def strongest_of(power: np.ndarray, n: int) -> np.ndarray:
    """Places of the n largest powers, the largest first; of equal ones the first, those without a value last."""
    if n < len(power):
        least = np.partition(-power, n - 1)[n - 1]
        if not np.isnan(least):
            near = np.flatnonzero(-power <= least)
            return near[np.argsort(-power[near], kind="stable")][:n]
    return np.argsort(-power, kind="stable")[:n]


def fast_periodogram(s: Series, step: float, count: int, strongest: int | None = None) -> DataFrame:
    """Generalised Lomb-Scargle power with a floating mean at ``step``, 2 ``step``, ... per id.

    A series is transformed in one task. Samples of a hot one are spread by
    tasks that hold a piece of it each, and only its grids come together, some
    at a time. Where the waves of a frequency cannot be told apart at the samples
    there is no power (null). Every power is worked out in the task of its id;
    with ``strongest`` only that many of an id leave it, for those who rank them.
    """
    grid, key = Grid(2 * count), s.keys[0]
    s = s.with_stats(_t0=F.min("time"), _mean=F.avg("flux"), _n=F.count(F.lit(1)))
    turns = (F.col("time") - F.col("_t0")) * F.lit(step)
    s = s.with_columns(_phase=turns - F.floor(turns), _y=F.col("flux") - F.col("_mean"))
    kind = to_arrow_type(s.cold.schema[key].dataType)
    schema = T.StructType([s.cold.schema[key], T.StructField("frequency", T.DoubleType()), T.StructField("power", T.DoubleType())])
    frequencies = np.arange(1, count + 1) * step

    def table(value: pa.Scalar, sums: np.ndarray, n: float, mean: float, square: float) -> pa.Table:
        found, at = power(grid, sums, n, mean, square, count), slice(None)
        if strongest is not None:
            at = strongest_of(found, strongest)
        found = pa.array(found[at], from_pandas=True)
        return pa.table([pa.array([value.as_py()] * len(found), kind), pa.array(frequencies[at]), found], names=[key, "frequency", "power"])

    def spread(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        y = np.asarray(rows["_y"])
        return y, grid.spread(np.asarray(rows["_phase"]), np.stack([y, np.ones(len(y))]))

    def whole(rows: pa.Table) -> pa.Table:
        y, sums = spread(rows)
        return table(rows[key][0], sums, len(y), float(y.mean()), float(np.square(y).mean()))

    found = s.cold.select(key, "_phase", "_y").groupBy(key).applyInArrow(whole, schema)
    if s.hot is None:
        return found

    fields = ["n", "first", "second", "cells", "gy", "g1"]
    types = [pa.float64(), pa.float64(), pa.float64(), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.list_(pa.float64())]

    def packed(rows: pa.Table, totals: list[float], sums: np.ndarray) -> pa.Table:
        """A row of a piece: its rows, sums of values and squares, and the cells of its grids that hold something."""
        cells = np.flatnonzero(sums[1])
        values = [*totals, cells.astype(np.int32), sums[0][cells], sums[1][cells]]
        arrays = [pa.array([rows[c][0].as_py()], rows.schema.field(c).type) for c in (key, "piece")]
        return pa.table([*arrays, *[pa.array([v], t) for v, t in zip(values, types)]], names=[key, "piece", *fields])

    def piece(rows: pa.Table) -> pa.Table:
        y, sums = spread(rows)
        return packed(rows, [float(len(y)), float(y.sum()), float(np.square(y).sum())], sums)

    def added(rows: pa.Table) -> tuple[list[float], np.ndarray]:
        sums = np.zeros((2, grid.size))
        for cells, gy, g1 in zip(rows["cells"], rows["gy"], rows["g1"]):
            at = cells.values.to_numpy()
            sums[0][at] += gy.values.to_numpy()
            sums[1][at] += g1.values.to_numpy()
        return [float(np.asarray(rows[c]).sum()) for c in ("n", "first", "second")], sums

    def merged(rows: pa.Table) -> pa.Table:
        return packed(rows, *added(rows))

    def gathered(rows: pa.Table) -> pa.Table:
        (n, first, second), sums = added(rows)
        return table(rows[key][0], sums, n, first / n, second / n)

    kinds = "n double, first double, second double, cells array<int>, gy array<double>, g1 array<double>"
    parts = f"{key} {s.cold.schema[key].dataType.simpleString()}, piece long, {kinds}"
    hot = s.hot.filter("_own") if "_own" in s.hot.columns else s.hot
    pieces = F.ceil(F.col("_n") / F.lit(PIECE_ROWS))
    rows = hot.select(key, "_phase", "_y", F.pmod(F.monotonically_increasing_id(), pieces).alias("piece"))
    grids = rows.groupBy(key, "piece").applyInArrow(piece, parts)
    left = hot.agg(F.max(pieces)).first()[0] or 1
    while left > MERGED:
        grids = grids.withColumn("piece", F.expr(f"piece div {MERGED}")).groupBy(key, "piece").applyInArrow(merged, parts)
        left = -(-left // MERGED)
    return found.unionByName(grids.groupBy(key).applyInArrow(gathered, schema))
