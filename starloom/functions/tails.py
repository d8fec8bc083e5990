"""Tail probabilities for one row per feature: normal, Student t and F."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def normal_cdf(z):
    return 0.5 * np.vectorize(math.erfc)(-np.asarray(z, dtype=float) / math.sqrt(2.0))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Lentz evaluation of the continued fraction of the incomplete beta."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 400):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return h


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    log_front = (
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1) / (a + b + 2):
        return math.exp(log_front) * _beta_fraction(a, b, x) / a
    return 1.0 - math.exp(log_front) * _beta_fraction(b, a, 1 - x) / b


def f_tail(f: float, d1: float, d2: float) -> float:
    if any(v is None or v != v for v in (f, d1, d2)) or d1 <= 0 or d2 <= 0:
        return math.nan
    return beta_inc(d2 / 2, d1 / 2, d2 / (d2 + d1 * max(f, 0.0)))


def t_tail(t: float, df: float) -> float:
    """Two-sided."""
    if t is None or t != t or df is None or df <= 0:
        return math.nan
    return beta_inc(df / 2, 0.5, df / (df + t * t))


@F.pandas_udf(DoubleType())
def f_pvalue(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series([f_tail(*row) for row in zip(f, d1, d2)], dtype="float64")


@F.pandas_udf(DoubleType())
def t_pvalue(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([t_tail(*row) for row in zip(t, df)], dtype="float64")


@F.pandas_udf(DoubleType())
def z_pvalue(z: pd.Series) -> pd.Series:
    """Two-sided normal tail."""
    return pd.Series([math.erfc(abs(v) / math.sqrt(2.0)) if v == v else math.nan for v in z.astype(float)])
