"""Serial dependence: autocorrelation, partial autocorrelation, lagged products, regressions."""

from __future__ import annotations

import math
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.basic import Pass
from starloom.functions.names import feature, flux
from starloom.functions.tails import normal_cdf
from starloom.operators.series import Series

MAX_LAG = 40
ACF_LAGS = 9
AR_ORDER = 10
#: Design rows of the unit-root test that are in memory at once.
DESIGN_ROWS = 16_384


def _acf(s: Series, max_lag: int) -> DataFrame:
    """One row per id with ``_n``, ``_var`` and ``_rho``, an array over lags 1..max_lag.

    Lags the series is too short for are null.
    """
    s = s.with_stats(_n=F.count(F.lit(1)), _mean=F.avg(flux()), _var=F.var_pop(flux()))
    s = s.with_columns(_c=flux() - F.col("_mean"))
    s = s.windowed(lambda w: {f"_l{k}": w.ahead("_c", k) for k in range(1, max_lag + 1)})
    sums = s.per_key(
        F.max("_n").alias("_n"),
        F.max("_var").alias("_var"),
        *[F.sum(F.col("_c") * F.col(f"_l{k}")).alias(f"_s{k}") for k in range(1, max_lag + 1)],
    )
    flat = F.col("_var") <= 1e-15
    rho = [
        F.when(~flat & (F.col("_n") > k), F.try_divide(F.col(f"_s{k}"), (F.col("_n") - k) * F.col("_var")))
        for k in range(1, max_lag + 1)
    ]
    return sums.select(*s.keys, "_n", "_var", F.array(*rho).alias("_rho"))


def _partial(rho: Column, max_lag: int) -> Column:
    """Durbin-Levinson recursion: partial autocorrelations of lags 1..max_lag."""

    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda u, v: u * v), F.lit(0.0), lambda u, v: u + v)

    def step(state: Column, k: Column) -> Column:
        phi = state["phi"]
        past = F.slice(rho, F.lit(1), F.size(phi))
        top = F.get(rho, k - 1) - dot(phi, F.reverse(past))
        last = F.try_divide(top, F.lit(1.0) - dot(phi, past))
        return F.transform(F.array(last), lambda a: F.struct(
            F.concat(F.zip_with(phi, F.reverse(phi), lambda u, v: u - a * v), F.array(a)).alias("phi"),
            F.concat(state["out"], F.array(a)).alias("out"),
        ))[0]

    none = F.array().cast("array<double>")
    start = F.struct(none.alias("phi"), none.alias("out"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(max_lag)), start, step, lambda state: state["out"])


def autocorrelation(s: Series, lags: int = ACF_LAGS, max_lag: int = MAX_LAG) -> DataFrame:
    """Autocorrelation, its aggregates over lags and partial autocorrelation."""
    acf = _acf(s, max(max_lag, lags)).withColumn("_pacf", _partial(F.col("_rho"), lags))
    known = F.filter("_rho", lambda v: v.isNotNull())
    size = F.size(known)
    mean = F.try_divide(F.aggregate(known, F.lit(0.0), lambda a, v: a + v), size)
    acf = acf.withColumns({"_known": known, "_mean": mean}).withColumn("_sorted", F.array_sort("_known"))
    spread = F.aggregate(
        F.transform("_known", lambda v: (v - F.col("_mean")) * (v - F.col("_mean"))), F.lit(0.0), lambda a, v: a + v
    )
    middle = (
        F.get("_sorted", F.floor((F.size("_sorted") - 1) / 2).cast("int"))
        + F.get("_sorted", F.floor(F.size("_sorted") / 2).cast("int"))
    ) / 2
    zero = F.lit(0.0)
    flat = F.col("_var") <= 1e-15
    out = [F.when(~flat, F.lit(1.0)).alias(feature("autocorrelation", lag=0))]
    out += [F.get("_rho", F.lit(k - 1)).alias(feature("autocorrelation", lag=k)) for k in range(1, lags + 1)]
    for name, value in (("mean", F.col("_mean")), ("median", middle), ("var", F.try_divide(spread, F.size("_known")))):
        out.append(F.coalesce(value, zero).alias(feature("agg_autocorrelation", f_agg=name, maxlag=max_lag)))
    out.append(F.lit(1.0).alias(feature("partial_autocorrelation", lag=0)))
    for k in range(1, lags + 1):
        partial = F.when(F.col("_n") / 2 > k, F.get("_pacf", F.lit(k - 1)))
        out.append(partial.alias(feature("partial_autocorrelation", lag=k)))
    return acf.select(*s.keys, *out)


PRODUCT_LAGS = (1, 2, 3)


def prepare_lagged_products(s: Series) -> Series:
    steps = sorted({k for l in PRODUCT_LAGS for k in (l, 2 * l)})
    return s.windowed(lambda w: {f"_lead{k}": w.ahead("flux", k) for k in steps})


def lagged_product_columns() -> list[Column]:
    """Third-order statistics of values one and two lags apart."""
    out = []
    for l in PRODUCT_LAGS:
        a, b = F.col(f"_lead{l}"), F.col(f"_lead{2 * l}")
        out.append(F.coalesce(F.avg(b * a * flux()), F.lit(0.0)).alias(feature("c3", lag=l)))
        turned = F.avg(b * b * a - a * flux() * flux())
        out.append(F.coalesce(turned, F.lit(0.0)).alias(feature("time_reversal_asymmetry_statistic", lag=l)))
    return out


lagged_products = Pass(prepare_lagged_products, lagged_product_columns)


def _solve(gram: np.ndarray, moment: np.ndarray) -> np.ndarray:
    """Least squares from normal equations; singular systems take the shortest solution."""
    return np.linalg.lstsq(gram, moment, rcond=1e-12)[0]


def ar_coefficients(s: Series, order: int = AR_ORDER) -> DataFrame:
    """Least-squares autoregression with an intercept.

    Only the products of centred lags leave the rows; one small solve per id
    remains.
    """
    s = s.with_stats(_mean=F.avg(flux())).with_columns(_c=flux() - F.col("_mean"))
    s = s.windowed(lambda w: {f"_g{k}": w.back("_c", k) for k in range(1, order + 1)})
    s = s.where(F.col(f"_g{order}").isNotNull())
    names = ["_one", *[f"_g{k}" for k in range(1, order + 1)], "_c"]
    s = s.with_columns(_one=F.lit(1.0))
    upper = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    sums = s.per_key(
        F.max("_mean").alias("_mean"),
        F.array(*[F.sum(F.col(names[i]) * F.col(names[j])) for i, j in upper]).alias("_gram"),
    )
    fields = [feature("ar_coefficient", coeff=c, k=order) for c in range(order + 1)]
    width = len(names)

    @F.pandas_udf("array<double>")
    def solve(grams: pd.Series, means: pd.Series) -> pd.Series:
        out = []
        for flat, mean in zip(grams, means):
            m = np.zeros((width, width))
            m[np.triu_indices(width)] = flat
            m = m + np.triu(m, 1).T
            if m[0, 0] <= order:
                out.append(None)
                continue
            beta = _solve(m[:-1, :-1], m[:-1, -1])
            beta[0] += mean * (1 - beta[1:].sum())
            out.append(beta)
        return pd.Series(out)

    solved = sums.select(*s.keys, solve("_gram", "_mean").alias("_beta"))
    return solved.select(*s.keys, *[F.get("_beta", F.lit(c)).alias(n) for c, n in enumerate(fields)])


# Response-surface coefficients for the unit-root test with a
# constant (MacKinnon 1994), small and large statistics, and their limits.
TAU_MAX, TAU_MIN, TAU_STAR = 2.74, -18.83, -1.61
TAU_SMALL = (2.1659, 1.4412, 0.038269)
TAU_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)


def unit_root_pvalue(stat: float) -> float:
    if stat > TAU_MAX:
        return 1.0
    if stat < TAU_MIN:
        return 0.0
    coefficients = TAU_SMALL if stat <= TAU_STAR else TAU_LARGE
    return float(normal_cdf(sum(c * stat**i for i, c in enumerate(coefficients))))


def _max_lag(n: int) -> int:
    return max(0, min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2))


def _design(x: np.ndarray, start: int, stop: int, lag: int) -> np.ndarray:
    """Rows ``start <= t < stop`` of (1, level, lagged differences, difference)."""
    d = np.diff(x[start - lag : stop + 1])
    t = np.arange(lag, lag + stop - start)
    columns = [np.ones(len(t)), x[start:stop], *[d[t - k] for k in range(1, lag + 1)], d[t]]
    return np.column_stack(columns)


def unit_root(s: Series) -> DataFrame:
    """Augmented Dickey-Fuller test, lag chosen by AIC.

    A block of consecutive rows gives the products of its own design rows; the
    sums over blocks and the first few samples are all the fit needs.
    """
    sized = s.with_stats(_n=F.count(F.lit(1)), _mean=F.avg(flux()), _scale=F.stddev_pop(flux()))
    widest = sized.rows().agg(F.max("_n")).first()[0] or 0
    sized = _reblock(sized, _max_lag(int(widest)) + 2)
    keys = list(s.keys)
    id_type = s.cold.schema[keys[0]].dataType.simpleString()

    def products(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        n, scale = int(rows["_n"].iloc[0]), float(rows["_scale"].iloc[0])
        lag = _max_lag(n)
        if n < 8 or not scale > 0:
            return pd.DataFrame({"id": [], "_n": [], "i": [], "v": []})
        x = ((rows["flux"] - rows["_mean"]) / scale).to_numpy()
        own, pos = rows["_own"].to_numpy(), rows["pos"].to_numpy()
        usable = np.flatnonzero(own & (pos >= lag) & (pos < n - 1))
        width = lag + 3
        gram = np.zeros((width, width))
        if len(usable):
            for first in range(usable[0], usable[-1] + 1, DESIGN_ROWS):
                m = _design(x, first, min(first + DESIGN_ROWS, usable[-1] + 1), lag)
                gram += m.T @ m
        values = gram.ravel()
        index = np.arange(len(values))
        if pos[0] == 0:  # the first samples, for fits that may start earlier
            head = x[: 2 * lag + 2]
            values = np.concatenate([values, head])
            index = np.concatenate([index, -1 - np.arange(len(head))])
        return pd.DataFrame({"id": key[0], "_n": n, "i": index, "v": values})

    groups = sized.cold.withColumns({"_own": F.lit(True), "_block": F.lit(0).cast("long")})
    if sized.hot is not None:
        groups = groups.unionByName(sized.hot)
    groups = groups.withColumnRenamed(keys[0], "id").select(
        "id", "_block", "pos", "flux", "_n", "_mean", "_scale", "_own"
    )
    parts = groups.groupBy("id", "_block").applyInPandas(products, f"id {id_type}, _n long, i long, v double")
    summed = parts.groupBy("id", "_n", "i").agg(F.sum("v").alias("v"))
    packed = summed.groupBy("id", "_n").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("p"))
    # plain numbers in order of their index: structs would become an object each in Python
    packed = packed.select("id", "_n", F.transform("p", lambda p: p["v"]).alias("p"))

    @F.pandas_udf("teststat double, pvalue double, usedlag double")
    def fit(n_rows: pd.Series, sums: pd.Series) -> pd.DataFrame:
        out = []
        for n, value in zip(n_rows, sums):
            lag = _max_lag(int(n))
            width = lag + 3
            gram = value[-width * width :].reshape(width, width)
            head = value[: -width * width][::-1]
            out.append(_dickey_fuller(gram, head, lag))
        return pd.DataFrame(out, columns=["teststat", "pvalue", "usedlag"])

    fitted = packed.select(F.col("id").alias(keys[0]), fit("_n", "p").alias("r"))
    ids = s.rows().select(*keys).distinct()  # ids too short or constant keep nulls
    return ids.join(fitted, keys, "left").select(
        *keys,
        *[
            F.col(f"r.{a}").alias(feature("augmented_dickey_fuller", attr=a, autolag="AIC"))
            for a in ("teststat", "pvalue", "usedlag")
        ],
    )


def _dickey_fuller(gram: np.ndarray, head: np.ndarray, lag: int) -> tuple[float, float, float]:
    def fit(g: np.ndarray, p: int) -> tuple[np.ndarray, float, np.ndarray]:
        keep = np.arange(p + 2)
        a, b = g[np.ix_(keep, keep)], g[keep, -1]
        beta = _solve(a, b)
        return beta, max(float(g[-1, -1] - beta @ b), 1e-300), a

    nobs = gram[0, 0]
    aic = []
    for p in range(lag + 1):
        _, rss, _ = fit(gram, p)
        aic.append(nobs * (math.log(2 * math.pi * rss / nobs) + 1) + 2 * (p + 2))
    best = int(np.argmin(aic))
    full = gram[np.ix_([*range(best + 2), -1], [*range(best + 2), -1])].copy()
    if best < lag:
        early = _design(head, best, lag, best)
        full += early.T @ early
    beta, rss, a = fit(full, best)
    sigma2 = rss / (full[0, 0] - best - 2)
    se = math.sqrt(sigma2 * np.linalg.pinv(a)[1, 1])
    stat = float(beta[1] / se)
    return stat, unit_root_pvalue(stat), float(best)


def _reblock(s: Series, halo: int) -> Series:
    """Hot blocks again with a wider halo, if the series have any."""
    return s if s.hot is None else s.drop("pos").located(halo)
