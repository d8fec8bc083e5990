"""Trends, corridor changes and the drift of the values."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.basic import Pass, with_next
from starloom.functions.names import feature, flux
from starloom.functions.tails import t_pvalue
from starloom.operators.series import Series


# The published parameter grids of the calculators.
CHUNK_LENGTHS = (5, 10, 50)
CORRIDOR_LOW = (0.0, 0.2, 0.4, 0.6, 0.8)
CORRIDOR_HIGH = (0.2, 0.4, 0.6, 0.8, 1.0)
DRIFT_BINS = 30
DRIFT_DEGREE = 3


def _line(y: Column, t: Column) -> dict[str, Column]:
    n = F.count(y).cast("double")
    sxx, syy, sxy = F.regr_sxx(y, t), F.regr_syy(y, t), F.regr_sxy(y, t)
    slope = F.try_divide(sxy, sxx)
    rest = F.greatest(syy - F.try_divide(sxy * sxy, sxx), F.lit(0.0))
    return {
        "slope": slope,
        "intercept": F.avg(y) - slope * F.avg(t),
        "rvalue": F.coalesce(F.try_divide(sxy, F.sqrt(sxx * syy)), F.when(sxx > 0, F.lit(0.0))),
        "stderr": F.when(n > 2, F.sqrt(F.try_divide(rest, (n - 2) * sxx))),
        "n": n,
    }


def linear_trend(s: Series) -> DataFrame:
    line = _line(flux(), F.col("pos").cast("double"))
    found = s.per_key(*[v.alias(k) for k, v in line.items()])
    t = F.try_divide(F.col("slope"), F.col("stderr"))
    p = F.when(F.col("n") > 2, t_pvalue(t, F.col("n") - 2))
    return found.select(
        *s.keys,
        *[F.col(a).alias(feature("linear_trend", a)) for a in ("slope", "intercept", "rvalue", "stderr")],
        p.alias(feature("linear_trend", "pvalue")),
    )


def chunk_trend(s: Series) -> DataFrame:
    """Lines through the max, min, mean and variance of consecutive chunks.

    The smallest chunks are grouped once; the longer ones are sums of them.
    """
    base = min(CHUNK_LENGTHS)
    s = s.with_stats(_mean=F.avg(flux())).with_columns(_c=flux() - F.col("_mean"))
    rows = s.rows().withColumn("_k", F.expr(f"pos div {base}"))
    small = rows.groupBy(*s.keys, "_k").agg(
        F.count(F.lit(1)).alias("c"), F.max("_mean").alias("m"), F.max(flux()).alias("hi"), F.min(flux()).alias("lo"),
        F.sum("_c").alias("s1"), F.sum(F.col("_c") * F.col("_c")).alias("s2"),
    )
    lengths = F.array(*[F.lit(c) for c in CHUNK_LENGTHS])
    sized = small.withColumn("len", F.explode(lengths)).withColumn("k", F.expr(f"_k * {base} div len"))
    chunks = sized.groupBy(*s.keys, "len", "k").agg(
        F.max("hi").alias("max"),
        F.min("lo").alias("min"),
        (F.max("m") + F.sum("s1") / F.sum("c")).alias("mean"),
        F.greatest(F.sum("s2") / F.sum("c") - F.pow(F.sum("s1") / F.sum("c"), F.lit(2.0)), F.lit(0.0)).alias("var"),
    )
    t = F.col("k").cast("double")
    lines = chunks.groupBy(*s.keys, "len").agg(
        *[v.alias(f"{agg}__{a}") for agg in ("max", "min", "mean", "var") for a, v in _line(F.col(agg), t).items()]
    )
    attributes = [(agg, a) for agg in ("max", "min", "mean", "var") for a in ("slope", "intercept", "rvalue", "stderr")]
    wide = lines.groupBy(*s.keys).agg(
        *[
            F.max(F.when(F.col("len") == c, F.col(f"{agg}__{a}"))).alias(
                feature("agg_linear_trend", attr=a, chunk_len=c, f_agg=agg)
            )
            for c in CHUNK_LENGTHS
            for agg, a in attributes
        ]
    )
    return wide


EDGES = sorted({*CORRIDOR_LOW, *CORRIDOR_HIGH})


def prepare_corridors(s: Series) -> Series:
    return with_next(s.with_quantiles("flux", **{f"_edge{i}": q for i, q in enumerate(EDGES)}))


def corridor_columns() -> list[Column]:
    """Mean and variance of steps that start and end inside a quantile corridor."""
    lower, upper = F.least(flux(), F.col("_next")), F.greatest(flux(), F.col("_next"))
    out = []
    for low in CORRIDOR_LOW:
        for high in CORRIDOR_HIGH:
            if low >= high:
                continue
            a, b = F.col(f"_edge{EDGES.index(low)}"), F.col(f"_edge{EDGES.index(high)}")
            inside = F.col("_next").isNotNull() & (lower >= a) & (upper <= b)
            for isabs in (False, True):
                step = F.when(inside, F.abs("_d") if isabs else F.col("_d"))
                for name, value in (("mean", F.avg(step)), ("var", F.var_pop(step))):
                    column = feature("change_quantiles", f_agg=name, isabs=isabs, qh=high, ql=low)
                    out.append(F.coalesce(value, F.lit(0.0)).alias(column))
    return out


corridor_changes = Pass(prepare_corridors, corridor_columns)


def drift(s: Series) -> DataFrame:
    """Cubic fit of the mean step per quantile bin of the value, and its largest root."""
    s = s.windowed(lambda w: {"_next": w.ahead("flux")})
    s = s.with_columns(_from=F.when(F.col("_next").isNotNull(), flux()), _d=F.col("_next") - flux())
    s = s.with_quantiles("_from", **{f"_e{i}": i / DRIFT_BINS for i in range(1, DRIFT_BINS)})
    above = [F.when(flux() > F.col(f"_e{i}"), 1).otherwise(0) for i in range(1, DRIFT_BINS)]
    bins = s.where(F.col("_next").isNotNull()).with_columns(_bin=sum(above[1:], above[0])).rows()
    means = bins.groupBy(*s.keys, "_bin").agg(F.avg(flux()).alias("x"), F.avg("_d").alias("d"))
    packed = means.groupBy(*s.keys).agg(F.array_sort(F.collect_list(F.struct("_bin", "x", "d"))).alias("p"))
    names = [f"c{i}" for i in range(DRIFT_DEGREE + 1)]

    @F.pandas_udf(", ".join(f"{n} double" for n in [*names, "root"]))
    def fit(points: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_cubic(p) for p in points], columns=[*names, "root"], dtype="float64")

    found = packed.select(*s.keys, fit("p").alias("f"))
    ids = s.rows().select(*s.keys).distinct()
    return ids.join(found, list(s.keys), "left").select(
        *s.keys,
        *[
            F.col(f"f.c{i}").alias(feature("friedrich_coefficients", coeff=i, m=DRIFT_DEGREE, r=DRIFT_BINS))
            for i in range(DRIFT_DEGREE + 1)
        ],
        F.col("f.root").alias(feature("max_langevin_fixed_point", m=DRIFT_DEGREE, r=DRIFT_BINS)),
    )


def _cubic(points: list) -> list:
    x = np.array([p["x"] for p in points], dtype=float)
    d = np.array([p["d"] for p in points], dtype=float)
    if len(x) <= DRIFT_DEGREE:
        return [None] * (DRIFT_DEGREE + 2)
    c = np.polyfit(x, d, DRIFT_DEGREE)
    roots = np.roots(c)
    return [*c, float(np.max(np.real(roots))) if len(roots) else None]
