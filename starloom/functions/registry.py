"""Calculator families and the named feature sets.

A family maps a located ``Series`` to one row per id. Users may register more.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from starloom.functions import basic, complexity, dependence, spectral, trend
from starloom.functions.names import feature
from starloom.operators.series import Series, open_series
from starloom.session import materialise, materialise_bucketed

HALO = 200
REACH: dict[str, int] = {}  # of families that look further than HALO
FAMILIES_AT_ONCE = 4

FAMILIES: dict[str, Callable[[Series], DataFrame]] = {
    "moments": basic.moments,
    "quantiles": basic.quantiles,
    "changes": basic.changes,
    "counts": basic.counts,
    "locations": basic.locations,
    "recurrence": basic.recurrence,
    "strikes": basic.strikes,
    "peaks": basic.peaks,
    "largest_magnitudes": basic.largest_magnitudes,
    "mass": basic.mass,
    "autocorrelation": dependence.autocorrelation,
    "lagged_products": dependence.lagged_products,
    "ar_coefficients": dependence.ar_coefficients,
    "unit_root": dependence.unit_root,
    "fft_coefficients": spectral.fft_coefficients,
    "fft_moments": spectral.fft_moments,
    "welch": spectral.welch,
    "cwt_coefficients": spectral.cwt_coefficients,
    "cwt_peaks": spectral.cwt_peaks,
    "binned_entropy": complexity.binned_entropy,
    "benford": complexity.benford,
    "permutation_entropy": complexity.permutation_entropy,
    "lempel_ziv": complexity.lempel_ziv,
    "template_entropies": complexity.template_entropies,
    "linear_trend": trend.linear_trend,
    "chunk_trend": trend.chunk_trend,
    "corridor_changes": trend.corridor_changes,
    "drift": trend.drift,
}

# Families of plain aggregates that run in one pass; small enough to compile well.
SHARED = (
    ("moments", "quantiles", "changes", "locations", "strikes", "lagged_products"),
    ("counts", "peaks", "mass"),
)

# Template matching compares all pairs of samples of a series.
EXPENSIVE = ("template_entropies",)

MINIMAL = {
    "moments": [
        feature(c) for c in (
            "mean", "median", "standard_deviation", "variance", "minimum", "maximum", "length", "sum_values", "abs_energy",
        )
    ],
    "changes": [
        feature("mean_abs_change"), feature("mean_change"), feature("mean_second_derivative_central"),
        feature("cid_ce", normalize=True),
    ],
    "quantiles": [feature("quantile", q=q) for q in (0.1, 0.9)],
    "autocorrelation": [
        *[feature("autocorrelation", lag=k) for k in (1, 2, 3)],
        feature("agg_autocorrelation", f_agg="mean", maxlag=40),
        *[feature("partial_autocorrelation", lag=k) for k in (1, 2, 3)],
    ],
    "first_fft": [feature("fft_coefficient", "abs", coeff=k) for k in (0, 1, 2)],
    "fft_moments": [feature("fft_aggregated", aggtype=a) for a in ("centroid", "variance")],
    "ar_coefficients": [feature("ar_coefficient", coeff=c, k=10) for c in (0, 1)],
    "counts": [feature("count_above_mean"), feature("count_below_mean"), feature("symmetry_looking", r=0.2)],
    "template_entropies": [feature("sample_entropy"), feature("approximate_entropy", m=2, r=0.2)],
}

_EXTRA: dict[str, Callable[[Series], DataFrame]] = {"first_fft": lambda s: spectral.fft_coefficients(s, 3)}

FEATURE_SETS = {
    "minimal": MINIMAL,
    "efficient": {name: None for name in FAMILIES if name not in EXPENSIVE},
    "comprehensive": {name: None for name in FAMILIES},
}


def register(name: str, family: Callable[[Series], DataFrame], halo: int = HALO) -> None:
    """Add a family of your own; it joins the efficient and comprehensive sets.

    ``halo`` is how many rows its ordered windows look back or ahead.
    """
    if name in FAMILIES or name in _EXTRA:
        raise ValueError(f"family {name!r} exists")
    FAMILIES[name] = family
    REACH[name] = halo
    FEATURE_SETS["efficient"][name] = None
    FEATURE_SETS["comprehensive"][name] = None


def numeric(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Feature columns as doubles, so that sets of features form one matrix."""
    return df.select(
        *keys,
        *[
            (F.col(f.name).cast("int") if isinstance(f.dataType, BooleanType) else F.col(f.name)).cast("double").alias(f.name)
            for f in df.schema.fields
            if f.name not in keys
        ],
    )


def extract(s: Series, feature_set: str | dict = "comprehensive") -> DataFrame:
    """One row per id with all features of the set.

    The located series are written once, bucketed by id, so no family shuffles
    them again. Families of plain aggregates share a pass, every other one is a
    job of its own. Results lie in the same buckets and join without a shuffle.
    """
    wanted = FEATURE_SETS[feature_set] if isinstance(feature_set, str) else feature_set
    spark, keys = s.cold.sparkSession, list(s.keys)
    buckets = bucket_number(s)
    located = replace(s, cold=s.cold.repartition(buckets, *keys)).located(max([HALO, *(REACH.get(n, 0) for n in wanted)]))
    cold, name = materialise_bucketed(located.cold, keys, buckets, [*keys, "pos"])
    located = replace(located, cold=cold)

    def write(bundle: list[tuple[str, list[str] | None]]) -> tuple[DataFrame, str]:
        families = [FAMILIES.get(n) or _EXTRA[n] for n, _ in bundle]
        found = families[0](located) if len(families) == 1 else basic.one_pass(located, families)
        if all(columns is not None for _, columns in bundle):
            found = found.select(*keys, *[c for _, columns in bundle for c in columns])
        return materialise_bucketed(numeric(found, s.keys), keys, buckets)

    # independent jobs; while one is planned another one runs
    with ThreadPoolExecutor(FAMILIES_AT_ONCE) as pool:
        written = [job.result() for job in [pool.submit(copy_context().run, write, b) for b in _bundles(wanted)]]
    parts, tables = [part for part, _ in written], [name, *[table for _, table in written]]
    joined = materialise(reduce(lambda a, b: a.join(b, keys, "left"), parts))
    for name in tables:
        spark.sql(f"DROP TABLE {name}")
    return joined


def _bundles(wanted: dict) -> list[list[tuple[str, list[str] | None]]]:
    """Families that share a pass over the data; the others alone."""
    out: list[list] = [[] for _ in SHARED]
    for name, columns in wanted.items():
        group = next((i for i, names in enumerate(SHARED) if name in names), None)
        if group is None:
            out.append([(name, columns)])
        else:
            out[group].append((name, columns))
    return [bundle for bundle in out if bundle]


def bucket_number(s: Series) -> int:
    """About two million rows per bucket, within what Spark allows."""
    least = int(s.cold.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(max(least, s.size // 2_000_000), 50_000)


def impute(features: DataFrame, keys: list[str], written: bool = False) -> DataFrame:
    """Replace infinities by the column's finite extremes and gaps by its median.

    One aggregate over the whole table gives one row of statistics. The table
    is read several times and so written first, unless it is ``written`` already.
    """
    features = features if written else materialise(features)
    names = [c for c in features.columns if c not in keys]
    inf = float("inf")

    def finite(c: str):
        v = F.col(c)
        return F.when(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < inf), v)

    stats = features.select(*[finite(c).alias(c) for c in names]).agg(
        *[F.min(c).alias(f"_lo{i}") for i, c in enumerate(names)],
        *[F.max(c).alias(f"_hi{i}") for i, c in enumerate(names)],
    )
    stats = stats.join(F.broadcast(column_medians(features, names)))
    joined = features.join(F.broadcast(stats))
    out = []
    for i, c in enumerate(names):
        v, zero = F.col(c), F.lit(0.0)
        out.append(
            F.when(v.isNull() | F.isnan(v), F.coalesce(F.col(f"_m{i}"), zero))
            .when(v == inf, F.coalesce(F.col(f"_hi{i}"), zero))
            .when(v == -inf, F.coalesce(F.col(f"_lo{i}"), zero))
            .otherwise(v)
            .alias(c)
        )
    return joined.select(*keys, *out)


def column_medians(features: DataFrame, names: list[str]) -> DataFrame:
    """Exact medians of the finite values, one row; columns named ``_m<i>``."""
    pairs = F.array(*[F.struct(F.lit(i).alias("c"), F.col(n).alias("flux")) for i, n in enumerate(names)])
    long = features.select(F.explode(pairs).alias("p")).select("p.c", "p.flux")
    long = long.filter("flux is not null and not isnan(flux) and abs(flux) < double('infinity')")
    s = open_series(long, ["c"], ["flux"]).with_quantiles("flux", m=0.5)
    per = s.per_key(F.max("m").alias("m"))
    return per.agg(*[F.max(F.when(F.col("c") == i, F.col("m"))).alias(f"_m{i}") for i in range(len(names))])
