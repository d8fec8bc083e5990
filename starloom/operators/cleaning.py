"""Cleaning of series: validity, gate, clip, normalise, resample, detrend, quality.

Rows are ``(id, time, flux, flux_err)`` plus any columns that break ties in
the order. Every step takes and returns a ``Series``.
"""

from __future__ import annotations

import math
from dataclasses import replace

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.series import Series, open_series
from starloom.session import materialise

# Fixed value: scale from the median absolute deviation to a standard deviation.
MAD_SCALE = 1.4826

CHUNK_POINTS = 100_000
NORMALISATIONS = ("median", "mean", "minmax")


def finite(name: str) -> Column:
    """Neither null, NaN nor infinite. NaN sorts above all numbers, so test it."""
    c = F.col(name).cast("double")
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def is_valid() -> Column:
    return finite("time") & finite("flux") & finite("flux_err") & (F.col("flux") > 0)


def valid_samples(df: DataFrame) -> DataFrame:
    return df.filter(is_valid())


def admission(df: DataFrame) -> DataFrame:
    """One row per id: does the raw series hold any usable time and flux?

    A source without the two columns admits nothing.
    """
    if not {"time", "flux"} <= set(df.columns):
        return df.select("id").distinct().withColumn("admitted", F.lit(False))
    return df.groupBy("id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        (
            F.coalesce(F.bool_or(F.col("time").isNotNull() & ~F.isnan(F.col("time").cast("double"))), F.lit(False))
            & F.coalesce(F.bool_or(F.col("flux").isNotNull() & ~F.isnan(F.col("flux").cast("double"))), F.lit(False))
        ).alias("admitted"),
    )


def minimum_points(s: Series, min_valid_points: int = 100) -> Series:
    gated = s.with_stats(_n=F.count(F.lit(1)))
    return gated.where(F.col("_n") >= min_valid_points).drop("_n")


def _deviations(s: Series) -> Series:
    s = s.with_quantiles("flux", _med=0.5)
    s = s.with_columns(_dev=F.abs(F.col("flux") - F.col("_med")))
    return s.with_quantiles("_dev", _mad=0.5)


def sigma_clip(s: Series, k: float = 5.0, on_zero_mad: str = "drop") -> Series:
    """One pass of ``abs(flux - median) < k * scale * MAD``, strictly below.

    A constant series has MAD 0 and loses every row unless ``on_zero_mad`` is
    ``"keep"``.
    """
    if on_zero_mad not in ("drop", "keep"):
        raise ValueError("on_zero_mad must be 'drop' or 'keep'")
    inside = F.col("_dev") < k * MAD_SCALE * F.col("_mad")
    if on_zero_mad == "keep":
        inside = inside | (F.col("_mad") == 0)
    return _deviations(s).where(inside).drop("_med", "_dev", "_mad")


def normalize(s: Series, method: str = "median") -> Series:
    if method == "median":
        s, shift, scale = s.with_quantiles("flux", _scale=0.5), F.lit(0.0), F.col("_scale")
    elif method == "mean":
        s, shift, scale = s.with_stats(_scale=F.avg("flux")), F.lit(0.0), F.col("_scale")
    elif method == "minmax":
        s = s.with_stats(_low=F.min("flux"), _high=F.max("flux"))
        shift, scale = F.col("_low"), F.col("_high") - F.col("_low")
    else:
        raise ValueError(f"unknown normalisation {method!r}; choose from {NORMALISATIONS}")
    s = s.with_columns(
        flux=F.try_divide(F.col("flux") - shift, scale), flux_err=F.try_divide(F.col("flux_err"), scale)
    )
    return s.drop("_scale", "_low", "_high")


def interpolate_gaps(s: Series, max_gap: float = 0.5) -> Series:
    """Resample series that have a gap onto an even grid of their median step.

    Samples that share a time count as one, their mean. Each interval between
    neighbours emits the grid points that fall into it, so even a hot series
    is resampled by many tasks. A long interval is cut into chunks of points
    that are dealt out before they are emitted; no row holds more than a chunk.
    The series are written first: what made them runs once.
    """
    s = s.map(materialise)
    ties = [c for c in s.order if c != "time"]
    blank = {c: F.lit(None).cast(s.cold.schema[c].dataType) for c in ties}

    def merged(df: DataFrame) -> DataFrame:
        return df.groupBy(*s.keys, "time").agg(F.avg("flux").alias("flux"), F.avg("flux_err").alias("flux_err"))

    spaced = replace(s.map(merged), order=("time",)).located(halo=1)
    spaced = spaced.windowed(
        lambda w: {
            "_t1": w.ahead("time"),
            "_f1": w.ahead("flux"),
            "_e1": w.ahead("flux_err"),
        }
    ).with_columns(_dt=F.col("_t1") - F.col("time"))
    spaced = spaced.with_stats(_t0=F.min("time"), _gap=F.max("_dt")).with_quantiles("_dt", _step=0.5)
    gaps = spaced.where((F.col("_gap") > max_gap) & F.col("_t1").isNotNull())

    def index(t: Column) -> Column:
        return F.ceil((t - F.col("_t0")) / F.col("_step"))

    first, last = index(F.col("time")), index(F.col("_t1")) - 1
    ranged = gaps.with_columns(_first=first, _last=last).where(F.col("_last") >= F.col("_first"))
    points = ranged.map(lambda df: _grid_points(df, s.keys))
    at = F.col("_t0") + F.col("_g") * F.col("_step")
    share = (F.col("_at") - F.col("time")) / F.col("_dt")
    points = points.with_columns(_at=at).with_columns(
        flux=F.col("flux") + (F.col("_f1") - F.col("flux")) * share,
        flux_err=F.col("flux_err") + (F.col("_e1") - F.col("flux_err")) * share,
    )
    points = points.with_columns(time=F.col("_at")).map(
        lambda df: _own_rows(df).select(*s.keys, "time", "flux", "flux_err").withColumns(blank)
    )
    # whole series without a gap stay as they were, ties included
    flagged = _with_gap_flag(s, max_gap).where(~F.col("_has_gap")).drop("_has_gap")

    def both(a: DataFrame, b: DataFrame) -> DataFrame:
        names = [*s.keys, "time", "flux", "flux_err", *ties]
        return a.select(*names).unionByName(b.select(*names))

    hot = None if s.hot is None else both(flagged.hot, points.hot)
    return replace(s, cold=both(flagged.cold, points.cold), hot=hot)


def _grid_points(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """A row for each number from ``_first`` to ``_last``."""
    df = _own_rows(df)
    chunk = F.explode(F.sequence(F.col("_first"), F.col("_last"), F.lit(CHUNK_POINTS).cast("long")))
    few = df.filter(F.col("_last") - F.col("_first") < CHUNK_POINTS)
    many = df.filter(F.col("_last") - F.col("_first") >= CHUNK_POINTS).withColumn("_first", chunk)
    many = many.withColumn("_last", F.least("_last", F.col("_first") + CHUNK_POINTS - 1)).repartition(*keys, "_first")
    return few.unionByName(many).withColumn("_g", F.explode(F.sequence("_first", "_last"))).drop("_first", "_last")


def _own_rows(df: DataFrame) -> DataFrame:
    return df.filter("_own") if "_own" in df.columns else df


def _with_gap_flag(s: Series, max_gap: float) -> Series:
    steps = s.located(halo=1).windowed(lambda w: {"_dt": w.ahead("time") - F.col("time")})
    flagged = steps.with_stats(_widest=F.max("_dt"))
    flagged = flagged.with_columns(_has_gap=F.coalesce(F.col("_widest") > max_gap, F.lit(False)))
    return flagged.map(lambda df: _own_rows(df).drop("_dt", "_widest", "pos", "_own", "_block"))


def smoothing_basis(window_length: int, polyorder: int) -> np.ndarray:
    """Orthonormal polynomials on the window; a fit is two small products."""
    t = np.linspace(-1.0, 1.0, window_length)
    q, _ = np.linalg.qr(np.vander(t, polyorder + 1, increasing=True))
    return q


def centre_fit(s: Series, half: int, weights: list[float], name: str) -> Series:
    """Adds the sum over the rows at most ``half`` away of flux times an even polynomial in the distance.

    ``weights`` are its coefficients of distance^0, ^2, ... The powers are
    expanded around centres of blocks of positions, so that every frame is a
    few differences of running sums, whatever its width: a frame meets at most
    two neighbouring blocks, one of even and one of odd number, and small
    distances to a centre cost few digits. Rows less than ``half`` from an end
    have no full frame (null). Needs ``located(half + 1)``.
    """
    block = 4 * half + 4
    number = F.floor(F.col("pos") / block)
    top = 2 * (len(weights) - 1)
    q = (F.col("pos") - number * block - block // 2).cast("double")
    parity = F.pmod(number, F.lit(2))
    moments = {f"_q{k}{e}": F.when(parity == e, F.col("flux") * F.pow(q, F.lit(float(k)))) for k in range(top + 1) for e in (0, 1)}
    s = s.with_running(**{m: F.coalesce(c, F.lit(0.0)) for m, c in moments.items()})
    s = s.windowed(lambda w: {m: w.ahead(m, half) - F.coalesce(w.back(m, half + 1), F.lit(0.0)) for m in moments})
    # Distance of the row from its own centre, and from that of the block the frame reaches into.
    other = q - F.when(q >= 0, F.lit(float(block))).otherwise(F.lit(float(-block)))
    terms = []
    for e in (0, 1):
        at = F.when(parity == e, q).otherwise(other)
        for power, weight in zip(range(0, top + 1, 2), weights):
            for k in range(power + 1):
                terms.append(F.col(f"_q{k}{e}") * F.pow(-at, F.lit(float(power - k))) * (weight * math.comb(power, k)))
    return s.with_columns(**{name: sum(terms[1:], terms[0])}).drop(*moments)


def even_weights(width: int, polyorder: int) -> list[float]:
    """Coefficients (distance^0, ^2, ...) of the weights that fit a polynomial at a window's middle."""
    basis = smoothing_basis(width, polyorder)
    centre, half = basis @ basis[width // 2], width // 2
    t = np.arange(-half, half + 1) / half
    powers = range(0, polyorder + 1, 2)
    found = np.linalg.lstsq(np.stack([t**k for k in powers], axis=1), centre, rcond=None)[0]
    return [float(c / half**k) for c, k in zip(found, powers)]


def detrend(s: Series, window_length: int = 101, polyorder: int = 3) -> Series:
    """Subtract a moving polynomial fit and add the median back.

    Inside, the trend is a fixed weighting of the window, an even polynomial in
    the distance. Near both ends it is
    the polynomial fitted to the first or last full window, which needs only
    one moment per basis polynomial and end. Shorter series stay unchanged.
    """
    width = window_length + 1 if window_length % 2 == 0 else window_length
    half = width // 2
    basis = smoothing_basis(width, polyorder)
    columns = [F.array(*[F.lit(float(v)) for v in basis[:, k]]) for k in range(polyorder + 1)]

    s = s.located(halo=half + 1).with_quantiles("flux", _med=0.5).with_stats(_n=F.count(F.lit(1)))
    from_end = F.col("pos") - F.col("_n") + width
    head = {
        f"_h{k}": F.sum(F.when(F.col("pos") < width, F.get(c, F.col("pos").cast("int")) * F.col("flux")))
        for k, c in enumerate(columns)
    }
    tail = {
        f"_t{k}": F.sum(F.when(from_end >= 0, F.get(c, from_end.cast("int")) * F.col("flux")))
        for k, c in enumerate(columns)
    }
    s = s.with_stats(**head, **tail)
    s = centre_fit(s, half, even_weights(width, polyorder), "_inside")

    def at_end(prefix: str, place: Column) -> Column:
        terms = [F.col(f"{prefix}{k}") * F.get(c, place.cast("int")) for k, c in enumerate(columns)]
        return sum(terms[1:], terms[0])

    trend = (
        F.when(F.col("pos") < half, at_end("_h", F.col("pos")))
        .when(F.col("pos") >= F.col("_n") - half, at_end("_t", from_end))
        .otherwise(F.col("_inside"))
    )
    flat = F.when(F.col("_n") >= width, F.col("flux") - trend + F.col("_med")).otherwise(F.col("flux"))
    s = s.with_columns(flux=flat)
    extra = ["pos", "_med", "_n", "_inside", *head, *tail]
    return s.map(lambda df: _own_rows(df).drop(*extra, "_own", "_block"))


def quality_metrics(s: Series) -> DataFrame:
    """One row per id. ``completeness`` is valid rows over all rows given."""
    valid = F.when(is_valid(), F.col("flux"))
    s = s.with_columns(_v=valid).with_quantiles("_v", _med=0.5)
    s = s.with_columns(_dev=F.abs(F.col("_v") - F.col("_med"))).with_quantiles("_dev", _mad=0.5)
    t = F.when(F.col("_v").isNotNull(), F.col("time"))
    return s.per_key(
        F.count("_v").alias("n_points"),
        (F.max(t) - F.min(t)).alias("time_span_days"),
        F.avg("_v").alias("mean_flux"),
        F.stddev_pop("_v").alias("std_flux"),
        F.max("_med").alias("median_flux"),
        F.max("_mad").alias("mad_flux"),
        F.coalesce(F.try_divide(F.max("_med"), F.stddev_pop("_v")), F.lit(0.0)).alias("snr"),
        (F.count("_v") / F.count(F.lit(1))).alias("completeness"),
    )


def preprocess(
    df: DataFrame,
    order: list[str] | None = None,
    *,
    min_valid_points: int = 100,
    outlier_sigma: float = 5.0,
    normalize_method: str = "median",
    fill_gaps: bool = False,
    max_gap: float = 0.5,
    detrend_flux: bool = True,
    window_length: int = 101,
    polyorder: int = 3,
    on_zero_mad: str = "drop",
    block_rows: int | None = None,
) -> Series:
    """Validity, gate, clip, normalise, then optional resampling and detrending."""
    s = open_series(valid_samples(df), ["id"], order or ["time"], block_rows)
    s = minimum_points(s, min_valid_points)
    s = normalize(sigma_clip(s, outlier_sigma, on_zero_mad), normalize_method)
    if fill_gaps:
        s = interpolate_gaps(s, max_gap)
    if detrend_flux:
        s = detrend(s, window_length, polyorder)
    return s


def rejected(df: DataFrame, min_valid_points: int = 100, block_rows: int | None = None) -> DataFrame:
    """Ids that give no cleaned series, with the reason."""
    s = open_series(df, ["id"], ["time"], block_rows)
    s = s.with_columns(flux=F.when(is_valid(), F.col("flux")))
    per_id = _deviations(s).per_key(F.count("flux").alias("n_valid"), F.max("_mad").alias("_mad"))
    reason = (
        F.when(F.col("n_valid") < min_valid_points, F.lit("too_few_points"))
        .when(F.col("_mad") == 0, F.lit("mad_zero"))
    )
    return per_id.withColumn("reason", reason).filter("reason is not null").select("id", "n_valid", "reason")
