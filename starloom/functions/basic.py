"""Moments, counts, changes, locations, recurrence, runs, peaks and mass.

Every calculator takes a ``Series`` that has been ``located`` with the halo of
the registry and gives one row per id.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.names import feature, flux
from starloom.operators.series import Series, even_chunk

# The published parameter grids of the calculators.
QUANTILES = (0.1, 0.2, 0.3, 0.4, 0.6, 0.7, 0.8, 0.9)
SYMMETRY_R = tuple(round(0.05 * i, 2) for i in range(20))
LARGE_STD_R = tuple(round(0.05 * i, 2) for i in range(1, 20))
BEYOND_R = (0.5, 1, 1.5, 2, 2.5, 3, 5, 6, 7, 10)
RANGES = ((-1, 1), (-1e12, 0), (0, 1e12))
RANGE_NAMES = (("-1", "1"), ("-1000000000000", "0"), ("0", "1000000000000"))
PEAK_SUPPORT = (1, 3, 5, 10, 50)
CHUNKS = 10



@dataclass(frozen=True)
class Pass:
    """A family that is one set of aggregates over prepared rows.

    Prepared columns have one meaning everywhere, so families can share a pass
    over the data: ``_n, _mean, _std, _var, _low, _high, _med, _next, _d``.
    """

    prepare: Callable[[Series], Series]
    columns: Callable[[], list[Column]]

    def __call__(self, s: Series) -> DataFrame:
        return one_pass(s, [self])


def one_pass(s: Series, families: list[Pass]) -> DataFrame:
    """Several families from one preparation and one aggregation."""
    for family in families:
        s = family.prepare(s)
    return s.per_key(*[c for family in families for c in family.columns()])


def with_median(s: Series) -> Series:
    return s if "_med" in s.cold.columns else s.with_quantiles("flux", _med=0.5)


def with_next(s: Series) -> Series:
    """The following value and the step to it."""
    if "_d" in s.cold.columns:
        return s
    return s.windowed(lambda w: {"_next": w.ahead("flux")}).with_columns(_d=F.col("_next") - flux())


def moment_columns() -> list[Column]:
    """Location, spread, shape and size of the values."""
    n = F.count(flux()).cast("double")
    mean, std, var = F.avg(flux()), F.stddev_pop(flux()), F.var_pop(flux())
    g1, g2 = F.skewness(flux()), F.kurtosis(flux())
    skew = F.when(n > 2, g1 * F.try_divide(F.sqrt(n * (n - 1)), n - 2))
    kurt = F.when(n > 3, F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * g2 + 6))
    return [
        mean.alias(feature("mean")),
        F.max("_med").alias(feature("median")),
        std.alias(feature("standard_deviation")),
        var.alias(feature("variance")),
        F.min(flux()).alias(feature("minimum")),
        F.max(flux()).alias(feature("maximum")),
        F.count(flux()).alias(feature("length")),
        F.sum(flux()).alias(feature("sum_values")),
        F.max(F.abs(flux())).alias(feature("absolute_maximum")),
        F.sqrt(F.avg(flux() * flux())).alias(feature("root_mean_square")),
        F.try_divide(std, mean).alias(feature("variation_coefficient")),
        F.sum(flux() * flux()).alias(feature("abs_energy")),
        F.when(var > 0, skew).alias(feature("skewness")),
        F.when(var > 0, kurt).alias(feature("kurtosis")),
        (var > std).alias(feature("variance_larger_than_standard_deviation")),
    ]


def quantile_pass(grid: tuple[float, ...] = QUANTILES) -> Pass:
    names = {feature("quantile", q=q): q for q in grid}
    inner = {f"_{n}": q for n, q in names.items()}
    return Pass(
        lambda s: s.with_quantiles("flux", **inner), lambda: [F.max(f"_{n}").alias(n) for n in names]
    )


def prepare_changes(s: Series) -> Series:
    return with_next(s).have(_n=F.count(F.lit(1)), _std=F.stddev_pop("flux"))


def change_columns() -> list[Column]:
    """Features of successive differences."""
    n = F.max("_n")

    def value_at(place: Column | int) -> Column:
        return F.max(F.when(F.col("pos") == place, flux()))

    first, second = value_at(0), value_at(1)
    last, before_last = value_at(F.col("_n") - 1), value_at(F.col("_n") - 2)
    total = F.coalesce(F.sum(F.abs("_d")), F.lit(0.0))
    size = F.sqrt(F.coalesce(F.sum(F.col("_d") * F.col("_d")), F.lit(0.0)))
    return [
        F.avg(F.abs("_d")).alias(feature("mean_abs_change")),
        F.try_divide(last - first, n - 1).alias(feature("mean_change")),
        F.when(n > 2, F.try_divide(last - before_last - second + first, 2 * (n - 2))).alias(
            feature("mean_second_derivative_central")
        ),
        total.alias(feature("absolute_sum_of_changes")),
        F.coalesce(F.try_divide(size, F.max("_std")), F.lit(0.0)).alias(feature("cid_ce", normalize=True)),
        size.alias(feature("cid_ce", normalize=False)),
    ]


def prepare_counts(s: Series) -> Series:
    return with_median(
        s.have(_mean=F.avg(flux()), _std=F.stddev_pop(flux()), _low=F.min(flux()), _high=F.max(flux()))
    )


def count_columns() -> list[Column]:
    """Counts and shares against the mean, fixed values and spread."""
    mean, std, spread = F.col("_mean"), F.col("_std"), F.col("_high") - F.col("_low")
    n, number = F.count(F.lit(1)), F.count_if
    out = [
        number(flux() > mean).alias(feature("count_above_mean")),
        number(flux() < mean).alias(feature("count_below_mean")),
        (number(flux() >= 0) / n).alias(feature("count_above", t=0)),
        (number(flux() <= 0) / n).alias(feature("count_below", t=0)),
    ]
    for (low, high), (low_name, high_name) in zip(RANGES, RANGE_NAMES):
        inside = (flux() >= low) & (flux() < high)
        out.append(number(inside).alias(feature("range_count", max=high_name, min=low_name)))
    out += [number(flux() == v).alias(feature("value_count", value=v)) for v in (0, 1, -1)]
    out += [
        (number(F.abs(flux() - mean) > r * std) / n).alias(feature("ratio_beyond_r_sigma", r=r)) for r in BEYOND_R
    ]
    out += [
        F.bool_and(std > r * spread).alias(feature("large_standard_deviation", r=r)) for r in LARGE_STD_R
    ]
    out += [
        F.bool_and(F.abs(mean - F.col("_med")) < r * spread).alias(feature("symmetry_looking", r=r))
        for r in SYMMETRY_R
    ]
    out.append(F.lit(0.0).alias(feature("query_similarity_count", query="None", threshold=0.0)))
    return out


def location_columns() -> list[Column]:
    """Relative places of the extremes."""
    n = F.count(F.lit(1))
    pos, back = F.col("pos"), (-F.col("pos")).alias("back")
    return [
        (F.min(F.struct((-flux()).alias("x"), pos))["pos"] / n).alias(feature("first_location_of_maximum")),
        (F.min(F.struct(flux(), pos))["pos"] / n).alias(feature("first_location_of_minimum")),
        ((F.max(F.struct(flux(), pos))["pos"] + 1) / n).alias(feature("last_location_of_maximum")),
        ((1 - F.min(F.struct(flux(), back))["back"]) / n).alias(feature("last_location_of_minimum")),
    ]


def recurrence(s: Series) -> DataFrame:
    """Multiplicities of values; counted per value before per id."""
    per_value = s.rows().groupBy(*s.keys, "flux").agg(F.count(F.lit(1)).alias("c"))
    c, many = F.col("c"), F.col("c") > 1
    distinct, total = F.count(F.lit(1)), F.sum("c")
    zero = F.lit(0)
    return per_value.groupBy(*s.keys).agg(
        F.bool_or(many).alias(feature("has_duplicate")),
        (F.max(F.struct(flux(), c))["c"] > 1).alias(feature("has_duplicate_max")),
        (F.max(F.struct(-flux(), c))["c"] > 1).alias(feature("has_duplicate_min")),
        (F.count_if(many) / distinct).alias(feature("percentage_of_reoccurring_values_to_all_values")),
        (F.sum(F.when(many, c).otherwise(zero)) / total).alias(
            feature("percentage_of_reoccurring_datapoints_to_all_datapoints")
        ),
        F.sum(F.when(many, flux()).otherwise(0.0)).alias(feature("sum_of_reoccurring_values")),
        F.sum(F.when(many, flux() * c).otherwise(0.0)).alias(feature("sum_of_reoccurring_data_points")),
        (distinct / total).alias(feature("ratio_value_number_to_time_series_length")),
    )


def prepare_strikes(s: Series) -> Series:
    s = s.have(_mean=F.avg(flux()))
    return s.with_latest(
        _calm_above=F.when(~(flux() > F.col("_mean")), F.col("pos")),
        _calm_below=F.when(~(flux() < F.col("_mean")), F.col("pos")),
    )


def strike_columns() -> list[Column]:
    """Longest runs above and below the mean: the widest space after a break."""
    start = F.lit(-1).cast("long")
    return [
        F.max(F.col("pos") - F.coalesce(f"_calm_{side}", start)).alias(feature(f"longest_strike_{side}_mean"))
        for side in ("above", "below")
    ]


def prepare_peaks(s: Series) -> Series:
    return with_next(s).have(_n=F.count(F.lit(1))).windowed(
        lambda w: {
            **{f"_before{k}": w.frame(F.max("flux"), -k, -1) for k in PEAK_SUPPORT},
            **{f"_after{k}": w.frame(F.max("flux"), 1, k) for k in PEAK_SUPPORT},
        }
    )


def peak_columns() -> list[Column]:
    """Level crossings and local maxima."""
    out = [
        F.count_if((flux() > m) != (F.col("_next") > m)).alias(feature("number_crossing_m", m=m)) for m in (0, -1, 1)
    ]
    for k in PEAK_SUPPORT:
        full = (F.col("pos") >= k) & (F.col("pos") < F.col("_n") - k)
        peak = full & (flux() > F.col(f"_before{k}")) & (flux() > F.col(f"_after{k}"))
        out.append(F.count_if(peak).alias(feature("number_peaks", n=k)))
    return out


def largest_magnitudes(s: Series, number: int = 7) -> DataFrame:
    """Mean of the largest absolute values; map tasks keep only ``number`` per id."""
    first = Window.partitionBy(*s.keys).orderBy(F.abs(flux()).desc(), "pos")
    ranked = s.rows().select(*s.keys, "pos", "flux").withColumn("_r", F.row_number().over(first))
    top = ranked.filter(F.col("_r") <= number)
    mean = F.when(F.count(F.lit(1)) == number, F.avg(F.abs(flux())))
    return top.groupBy(*s.keys).agg(mean.alias(feature("mean_n_absolute_max", number_of_maxima=number)))


def prepare_mass(s: Series) -> Series:
    s = s.have(_n=F.count(F.lit(1)), _total=F.sum(F.abs(flux())), _energy=F.sum(flux() * flux()))
    s = s.with_running(_mass=F.abs(flux()))
    return s.with_columns(_chunk=even_chunk(F.col("pos"), F.col("_n"), CHUNKS))


def mass_columns() -> list[Column]:
    """Where the mass of the magnitudes lies, and energy shares of ten chunks."""
    reached = [F.min(F.when(F.col("_mass") >= q * F.col("_total"), F.col("pos") + 1)) for q in QUANTILES]
    out = [
        F.try_divide(r, F.max("_n")).alias(feature("index_mass_quantile", q=q)) for r, q in zip(reached, QUANTILES)
    ]
    for focus in range(CHUNKS):
        inside = F.sum(F.when(F.col("_chunk") == focus, flux() * flux()).otherwise(0.0))
        name = feature("energy_ratio_by_chunks", num_segments=CHUNKS, segment_focus=focus)
        out.append(F.try_divide(inside, F.max("_energy")).alias(name))
    return out


moments = Pass(with_median, moment_columns)
quantiles = quantile_pass()
changes = Pass(prepare_changes, change_columns)
counts = Pass(prepare_counts, count_columns)
locations = Pass(lambda s: s, location_columns)
strikes = Pass(prepare_strikes, strike_columns)
peaks = Pass(prepare_peaks, peak_columns)
mass = Pass(prepare_mass, mass_columns)
