"""Mutual information of a continuous feature and a label from distances to nearest neighbours.

For a sample of class c the distance r to its k-th neighbour in its class is
found among sorted values; m values of the whole feature lie closer than r.
With digamma function psi the information is the mean of
psi(N) + psi(k) - psi(n_c) - psi(m), at least 0 (Ross, PLoS ONE 9, 2014).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators import columns
from starloom.operators.series import BLOCK_ROWS, open_series, running_totals

NEIGHBOURS = 3
_GAMMA = 0.5772156649015329


def edges(value: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest number whose computed distance from a value is below the radius; the value itself at radius 0.

    Distances are rounded, so each bound is found by halving a short bracket around value -+ radius.
    """
    out = []
    for sign in (-1.0, 1.0):
        slack = 4 * np.spacing(np.maximum(np.abs(value), radius))
        inner, outer = value + sign * np.maximum(radius - slack, 0.0), value + sign * (radius + slack)
        inner = np.where(np.abs(inner - value) < radius, inner, value)
        while True:
            middle = inner + (outer - inner) / 2
            open_ = (middle != inner) & (middle != outer)
            if not open_.any():
                break
            close = open_ & (np.abs(middle - value) < radius)
            inner, outer = np.where(close, middle, inner), np.where(open_ & ~close, middle, outer)
        out.append(np.where(radius > 0, inner, value))
    return out[0], out[1]


def _radius(sorted_values: np.ndarray, k: int) -> np.ndarray:
    """Distance to the k-th nearest of the other values: the two sides are sorted, so it is the least of k + 1 maxima."""
    n = len(sorted_values)
    side = np.full((2, k + 1, n), np.inf)
    side[:, 0] = 0.0
    for j in range(1, min(k, n - 1) + 1):
        step = sorted_values[j:] - sorted_values[:-j]
        side[0, j, j:], side[1, j, : n - j] = step, step
    return np.min([np.maximum(side[0, j], side[1, k - j]) for j in range(k + 1)], axis=0)


def information(values: np.ndarray, labels: np.ndarray, k: int = NEIGHBOURS) -> float | None:
    """The estimate for one feature; classes of one sample are left out."""
    _, classes, sizes = np.unique(labels, return_inverse=True, return_counts=True)
    keep = sizes[classes] > 1
    values, classes = values[keep], classes[keep]
    if not len(values):
        return None
    radius, near = np.empty(len(values)), np.empty(len(values), np.int64)
    for c in np.unique(classes):
        at = np.flatnonzero(classes == c)
        at = at[np.argsort(values[at], kind="stable")]
        near[at] = min(k, len(at) - 1)
        radius[at] = _radius(values[at], int(near[at[0]]))
    ordered = np.sort(values)
    low, high = edges(values, radius)
    m = np.searchsorted(ordered, high, "right") - np.searchsorted(ordered, low, "left")
    psi = np.concatenate([[0.0, 0.0], np.cumsum(1.0 / np.arange(1, len(values)))]) - _GAMMA
    return max(0.0, float(psi[len(values)] + (psi[near] - psi[sizes[classes]] - psi[m]).mean()))


def _psi(x: Column) -> Column:
    """Digamma of whole numbers from 1 on: the series far out, and steps down to the number."""
    far = x + F.lit(10.0)
    series = F.ln(far) - F.lit(0.5) / far - F.lit(1.0) / (12 * far * far) + F.lit(1.0) / (120 * far**4) - F.lit(1.0) / (252 * far**6)
    return series - sum([F.lit(1.0) / (x + j) for j in range(1, 10)], F.lit(1.0) / x)


def _by_sorting(long: DataFrame, k: int, block_rows: int | None) -> DataFrame:
    """The same for features of any length: neighbours by position, counts by running totals in value order."""
    finite = F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") < float("inf"))
    rows = long.filter(finite).select("feature", "label", "id", "value").withColumn("id", F.struct("id", F.monotonically_increasing_id()))
    s = open_series(rows, ["feature", "label"], ["value", "id"], block_rows).located(k).windowed(
        lambda w: {f"_b{j}": F.col("value") - w.back("value", j) for j in range(1, k + 1)} | {f"_a{j}": w.ahead("value", j) - F.col("value") for j in range(1, k + 1)}
    ).with_stats(_n=F.count(F.lit(1)))

    def side(letter: str, j: int) -> Column:
        return F.coalesce(F.col(f"_{letter}{j}"), F.lit(float("inf"))) if j else F.lit(0.0)

    near = F.least(F.lit(k), F.col("_n") - 1)
    radius = F.coalesce(*[F.when(near == n, F.least(*[F.greatest(side("b", j), side("a", n - j)) for j in range(n + 1)])) for n in range(1, k + 1)])

    @F.pandas_udf("low double, high double")
    def bounds(value: pd.Series, far: pd.Series) -> pd.DataFrame:
        low, high = edges(value.to_numpy(), far.to_numpy())
        return pd.DataFrame({"low": low, "high": high})

    found = s.where(F.col("_n") > 1).with_columns(_k=near, _r=radius).rows()
    found = found.select("feature", "id", "value", (_psi(F.col("_k")) - _psi(F.col("_n"))).alias("part"), bounds("value", "_r").alias("e"))
    # Below the lower bound, at it and up to the upper one: bounds go before and behind equal values.
    point = lambda x, turn, one: F.struct(F.col(x).alias("x"), F.lit(turn).alias("turn"), F.lit(one).cast("long").alias("one"))
    points = found.select("feature", "id", "part", F.explode(F.array(point("e.low", -1, 0), point("value", 0, 1), point("e.high", 1, 0))).alias("p"))
    points = points.select("feature", "id", "part", "p.x", "p.turn", "p.one")
    counted = running_totals(points, ["feature"], ["x", "turn", "id"], upto="one")
    m = counted.filter("turn <> 0").groupBy("feature", "id").agg(F.sum(F.col("turn") * F.col("upto")).alias("m"), F.max("part").alias("part"))
    means = m.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("part") - _psi(F.col("m"))).alias("mean"))
    return means.select("feature", F.greatest(F.lit(0.0), _psi(F.col("n")) + F.col("mean")).alias("mutual_info"))


def neighbour_information(df: DataFrame, names: list[str], k: int = NEIGHBOURS, block_rows: int | None = None) -> DataFrame:
    """Information (feature, mutual_info) of every column about ``label``.

    Up to a block of rows a feature is an array in one task; with more, its
    values are sorted over many tasks. Both give the same numbers. A column
    without two samples of a class has none (null).
    """
    from starloom.operators.selection import long_form

    block = block_rows or int(df.sparkSession.conf.get("spark.starloom.blockRows", str(BLOCK_ROWS)))
    if df.count() > block:
        every = df.sparkSession.createDataFrame([(n,) for n in names], "feature string")
        return every.join(_by_sorting(long_form(df, names), k, block), "feature", "left")

    def judge(group: pa.Table) -> pa.Table:
        values = np.concatenate([np.frombuffer(b.as_py()) for b in group["x"]])
        labels = np.concatenate([np.frombuffer(b.as_py(), np.int64) for b in group["label"]])
        return pa.table({"i": group["i"][:1], "mutual_info": pa.array([information(values, labels, k)], pa.float64())})

    found = columns.column_values(df, names).groupBy("i").applyInArrow(judge, "i int, mutual_info double")
    return columns.named(found, names).select("feature", "mutual_info")
