"""One query per calculator family over the event series, with SQL twins.

Values are divided by pi: quotients of two-decimal values would often end
exactly between two rounded results and make the comparison a coin toss.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import basic, complexity, dependence, similarity, spectral, trend
from starloom.functions.names import feature
from starloom.functions.registry import FAMILIES, HALO, extract, impute
from starloom.operators.series import Series, open_series
from starloom.plans import bindings
from starloom.plans.compare import r, rounded, t_tail_sql


def s1(spark: SparkSession, sf_dir: str, block_rows: int | None = None) -> Series:
    return open_series(scaled_events(spark, sf_dir), ["id"], bindings.S1_ORDER, block_rows).located(HALO)


def scaled_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bindings.event_series(spark, sf_dir).filter("flux > 0").withColumn("flux", F.col("flux") / F.pi())


def s2(spark: SparkSession, sf_dir: str) -> Series:
    rows = bindings.lineitem_series(spark, sf_dir).filter("flux > 0")
    rows = rows.withColumn("flux", F.col("flux") / 10000)
    return open_series(rows, ["id"], bindings.S2_ORDER).located(HALO)


def _family(name: str, digits: int, source: Callable = s1, drop: tuple[str, ...] = ()) -> Callable:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(FAMILIES[name](source(spark, sf_dir)).drop(*drop), digits)

    return query


S1 = f"""
s AS (
  SELECT id, flux / pi() AS x, row_number() OVER (PARTITION BY id ORDER BY time, event_id) - 1 AS pos,
         count(*) OVER (PARTITION BY id) AS n
  FROM ({bindings.S1_SQL}) WHERE flux > 0)"""

S2 = f"""
s AS (
  SELECT id, flux / 10000 AS x, row_number() OVER (PARTITION BY id ORDER BY time, order_key, line_number) - 1 AS pos,
         count(*) OVER (PARTITION BY id) AS n
  FROM ({bindings.S2_SQL}) WHERE flux > 0)"""

PVALUE = feature("linear_trend", "pvalue")


def _moments_sql(d: int) -> str:
    items = {
        "mean": "avg(x)", "median": "median(x)", "standard_deviation": "stddev_pop(x)", "variance": "var_pop(x)",
        "minimum": "min(x)", "maximum": "max(x)", "sum_values": "sum(x)", "absolute_maximum": "max(abs(x))",
        "root_mean_square": "sqrt(avg(x * x))", "variation_coefficient": "stddev_pop(x) / avg(x)",
        "abs_energy": "sum(x * x)", "skewness": "skewness(x)", "kurtosis": "kurtosis(x)",
    }
    columns = [r(e, feature(n), d) for n, e in items.items()]
    return f"""WITH {S1} SELECT id, {', '.join(columns)}, count(x) AS "{feature('length')}",
      var_pop(x) > stddev_pop(x) AS "{feature('variance_larger_than_standard_deviation')}" FROM s GROUP BY id"""


def _quantiles_sql(d: int) -> str:
    columns = [r(f"quantile_cont(x, {q})", feature("quantile", q=q), d) for q in basic.QUANTILES]
    return f"WITH {S1} SELECT id, {', '.join(columns)} FROM s GROUP BY id"


def _changes_sql(d: int) -> str:
    at = lambda p: f"max(x) FILTER (WHERE pos = {p})"
    items = {
        feature("mean_abs_change"): "avg(abs(dx))",
        feature("mean_change"): f"({at('n - 1')} - {at('0')}) / (max(n) - 1)",
        feature("mean_second_derivative_central"):
            f"({at('n - 1')} - {at('n - 2')} - {at('1')} + {at('0')}) / (2 * (max(n) - 2))",
        feature("absolute_sum_of_changes"): "sum(abs(dx))",
        feature("cid_ce", normalize=True): "sqrt(sum(dx * dx)) / stddev_pop(x)",
        feature("cid_ce", normalize=False): "sqrt(sum(dx * dx))",
    }
    return f"""WITH {S1}, t AS (SELECT *, lead(x) OVER (PARTITION BY id ORDER BY pos) - x AS dx FROM s)
      SELECT id, {', '.join(r(e, n, d) for n, e in items.items())} FROM t GROUP BY id"""


def _counts_sql(d: int) -> str:
    out = [
        f'CAST(count_if(x > mu) AS BIGINT) AS "{feature("count_above_mean")}"',
        f'CAST(count_if(x < mu) AS BIGINT) AS "{feature("count_below_mean")}"',
        r("count_if(x >= 0) / count(*)", feature("count_above", t=0), d),
        r("count_if(x <= 0) / count(*)", feature("count_below", t=0), d),
    ]
    for (low, high), (a, b) in zip(basic.RANGES, basic.RANGE_NAMES):
        out.append(f'CAST(count_if(x >= {low} AND x < {high}) AS BIGINT) AS "{feature("range_count", max=b, min=a)}"')
    out += [f'CAST(count_if(x = {v}) AS BIGINT) AS "{feature("value_count", value=v)}"' for v in (0, 1, -1)]
    out += [r(f"count_if(abs(x - mu) > {q} * sd) / count(*)", feature("ratio_beyond_r_sigma", r=q), d) for q in basic.BEYOND_R]
    out += [f'max(sd) > {q} * max(hi - lo) AS "{feature("large_standard_deviation", r=q)}"' for q in basic.LARGE_STD_R]
    out += [f'max(abs(mu - med)) < {q} * max(hi - lo) AS "{feature("symmetry_looking", r=q)}"' for q in basic.SYMMETRY_R]
    out.append(f'0.0::DOUBLE AS "{feature("query_similarity_count", query="None", threshold=0.0)}"')
    return f"""WITH {S1}, m AS (SELECT id, avg(x) AS mu, stddev_pop(x) AS sd, min(x) AS lo, max(x) AS hi,
        median(x) AS med FROM s GROUP BY id)
      SELECT id, {', '.join(out)} FROM s JOIN m USING (id) GROUP BY id"""


def _locations_sql(d: int) -> str:
    items = {
        "first_location_of_maximum": "min(pos) FILTER (WHERE x = hi) / max(n)",
        "first_location_of_minimum": "min(pos) FILTER (WHERE x = lo) / max(n)",
        "last_location_of_maximum": "(max(pos) FILTER (WHERE x = hi) + 1) / max(n)",
        "last_location_of_minimum": "(max(pos) FILTER (WHERE x = lo) + 1) / max(n)",
    }
    return f"""WITH {S1}, t AS (SELECT *, max(x) OVER (PARTITION BY id) AS hi, min(x) OVER (PARTITION BY id) AS lo FROM s)
      SELECT id, {', '.join(r(e, feature(n), d) for n, e in items.items())} FROM t GROUP BY id"""


def _recurrence_sql(d: int) -> str:
    floats = {
        "percentage_of_reoccurring_values_to_all_values": "count_if(c > 1) / count(*)",
        "percentage_of_reoccurring_datapoints_to_all_datapoints":
            "coalesce(sum(c) FILTER (WHERE c > 1), 0) / sum(c)",
        "sum_of_reoccurring_values": "coalesce(sum(x) FILTER (WHERE c > 1), 0.0)",
        "sum_of_reoccurring_data_points": "coalesce(sum(x * c) FILTER (WHERE c > 1), 0.0)",
        "ratio_value_number_to_time_series_length": "count(*) / sum(c)",
    }
    return f"""WITH {S1}, t AS (SELECT id, x, count(*) AS c FROM s GROUP BY id, x)
      SELECT id, bool_or(c > 1) AS "{feature('has_duplicate')}", arg_max(c, x) > 1 AS "{feature('has_duplicate_max')}",
        arg_min(c, x) > 1 AS "{feature('has_duplicate_min')}", {', '.join(r(e, feature(n), d) for n, e in floats.items())}
      FROM t GROUP BY id"""


def _strikes_sql(d: int) -> str:
    def longest(sign: str) -> str:
        return f"""SELECT id, CAST(max(len) AS BIGINT) AS len FROM (
          SELECT id, g, count_if(hit) AS len FROM (
            SELECT id, x {sign} mu AS hit, sum(CASE WHEN x {sign} mu THEN 0 ELSE 1 END)
              OVER (PARTITION BY id ORDER BY pos) AS g FROM t) GROUP BY id, g) GROUP BY id"""

    return f"""WITH {S1}, t AS (SELECT *, avg(x) OVER (PARTITION BY id) AS mu FROM s),
      a AS ({longest('>')}), b AS ({longest('<')})
      SELECT id, a.len AS "{feature('longest_strike_above_mean')}", b.len AS "{feature('longest_strike_below_mean')}"
      FROM a JOIN b USING (id)"""


def _peaks_sql(d: int) -> str:
    side = [
        f"max(x) OVER (PARTITION BY id ORDER BY pos ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING) AS l{k}, "
        f"max(x) OVER (PARTITION BY id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND {k} FOLLOWING) AS r{k}"
        for k in basic.PEAK_SUPPORT
    ]
    out = [f'CAST(count_if((x > {m}) <> (nxt > {m})) AS BIGINT) AS "{feature("number_crossing_m", m=m)}"' for m in (0, -1, 1)]
    out += [
        f'CAST(count_if(pos >= {k} AND pos < n - {k} AND x > l{k} AND x > r{k}) AS BIGINT) AS "{feature("number_peaks", n=k)}"'
        for k in basic.PEAK_SUPPORT
    ]
    return f"""WITH {S1}, t AS (SELECT *, lead(x) OVER (PARTITION BY id ORDER BY pos) AS nxt, {', '.join(side)} FROM s)
      SELECT id, {', '.join(out)} FROM t GROUP BY id"""


def _largest_sql(d: int) -> str:
    name = feature("mean_n_absolute_max", number_of_maxima=7)
    return f"""WITH {S1}, t AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY abs(x) DESC, pos) AS k FROM s)
      SELECT id, {r('CASE WHEN count(*) = 7 THEN avg(abs(x)) END', name, d)} FROM t WHERE k <= 7 GROUP BY id"""


def _mass_sql(d: int) -> str:
    out = [
        r(f"min(pos + 1) FILTER (WHERE running >= {q} * total) / max(n)", feature("index_mass_quantile", q=q), d)
        for q in basic.QUANTILES
    ]
    out += [
        r(f"coalesce(sum(x * x) FILTER (WHERE chunk = {f}), 0.0) / sum(x * x)",
          feature("energy_ratio_by_chunks", num_segments=10, segment_focus=f), d)
        for f in range(basic.CHUNKS)
    ]
    return f"""WITH {S1}, t AS (SELECT *, sum(abs(x)) OVER (PARTITION BY id ORDER BY pos) AS running,
        sum(abs(x)) OVER (PARTITION BY id) AS total, ntile(10) OVER (PARTITION BY id ORDER BY pos) - 1 AS chunk FROM s)
      SELECT id, {', '.join(out)} FROM t GROUP BY id"""


def _autocorrelation_sql(d: int) -> str:
    lags, top = dependence.ACF_LAGS, dependence.MAX_LAG
    out = [r("1.0::DOUBLE", feature("autocorrelation", lag=0), d)]
    out += [r(f"r{k}", feature("autocorrelation", lag=k), d) for k in range(1, lags + 1)]
    out += [
        r(e, feature("agg_autocorrelation", f_agg=n, maxlag=top), d)
        for n, e in (("mean", "m"), ("median", "md"), ("var", "v"))
    ]
    out.append(r("1.0::DOUBLE", feature("partial_autocorrelation", lag=0), d))
    out += [
        r(f"CASE WHEN n / 2 > {k} THEN p{k}_{k} END", feature("partial_autocorrelation", lag=k), d)
        for k in range(1, lags + 1)
    ]
    steps, source = ["w1 AS (SELECT *, r1 AS p1_1 FROM wide)"], "w1"
    for k in range(2, lags + 1):
        num = " - ".join([f"r{k}", *[f"p{k-1}_{j} * r{k-j}" for j in range(1, k)]])
        den = " - ".join(["1", *[f"p{k-1}_{j} * r{j}" for j in range(1, k)]])
        steps.append(f"u{k} AS (SELECT *, ({num}) / ({den}) AS p{k}_{k} FROM {source})")
        rest = ", ".join(f"p{k-1}_{j} - p{k}_{k} * p{k-1}_{k-j} AS p{k}_{j}" for j in range(1, k))
        steps.append(f"w{k} AS (SELECT *, {rest} FROM u{k})")
        source = f"w{k}"
    wide = ", ".join(f"max(rho) FILTER (WHERE k = {k}) AS r{k}" for k in range(1, lags + 1))
    return f"""WITH {S1}, m AS (SELECT id, avg(x) AS mu, var_pop(x) AS v FROM s GROUP BY id),
      c AS (SELECT s.id, pos, n, x - mu AS c, v FROM s JOIN m USING (id)),
      acf AS (SELECT a.id, a.n, k, sum(a.c * b.c) / ((a.n - k) * max(a.v)) AS rho
        FROM c a JOIN range(1, {top + 1}) AS g(k) ON true JOIN c b ON a.id = b.id AND b.pos = a.pos + k GROUP BY a.id, a.n, k),
      wide AS (SELECT id, n, avg(rho) AS m, median(rho) AS md, var_pop(rho) AS v, {wide} FROM acf GROUP BY id, n),
      {', '.join(steps)}
      SELECT id, {', '.join(out)} FROM {source}"""


def _lagged_sql(d: int) -> str:
    leads = ", ".join(f"lead(x, {k}) OVER (PARTITION BY id ORDER BY pos) AS l{k}" for k in (1, 2, 3, 4, 6))
    out = []
    for l in (1, 2, 3):
        a, b = f"l{l}", f"l{2 * l}"
        out.append(r(f"coalesce(avg({b} * {a} * x), 0.0)", feature("c3", lag=l), d))
        out.append(r(f"coalesce(avg({b} * {b} * {a} - {a} * x * x), 0.0)", feature("time_reversal_asymmetry_statistic", lag=l), d))
    return f"WITH {S1}, t AS (SELECT *, {leads} FROM s) SELECT id, {', '.join(out)} FROM t GROUP BY id"


def _fft_sql(d: int) -> str:
    out = []
    for k in range(spectral.FFT_COEFFICIENTS):
        at = f"FILTER (WHERE k = {k})"
        for name, e in (("real", "re"), ("imag", "im"), ("abs", "sqrt(re * re + im * im)")):
            out.append(r(f"max({e}) {at}", feature("fft_coefficient", name, coeff=k), d))
    return f"""WITH {S1}, f AS (SELECT id, k, sum(x * cos(2 * pi() * ((k * pos) % n) / n)) AS re,
        -sum(x * sin(2 * pi() * ((k * pos) % n) / n)) AS im
        FROM s JOIN range({spectral.FFT_COEFFICIENTS}) AS g(k) ON 2 * k <= n GROUP BY id, k)
      SELECT id, {', '.join(out)} FROM f GROUP BY id"""


def _fft_moments_sql(d: int) -> str:
    out = [
        r("m1", feature("fft_aggregated", aggtype="centroid"), d),
        r("v", feature("fft_aggregated", aggtype="variance"), d),
        r("CASE WHEN v >= 0.5 THEN (m3 - 3 * m1 * m2 + 2 * m1 ** 3) / v ** 1.5 END",
          feature("fft_aggregated", aggtype="skew"), d),
        r("CASE WHEN v >= 0.5 THEN (m4 - 4 * m1 * m3 + 6 * m1 * m1 * m2 - 3 * m1 ** 4) / (v * v) END",
          feature("fft_aggregated", aggtype="kurtosis"), d),
    ]
    return f"""WITH {S1}, f AS (SELECT id, k, sum(x * cos(2 * pi() * ((k * pos) % n) / n)) AS re,
        -sum(x * sin(2 * pi() * ((k * pos) % n) / n)) AS im
        FROM s JOIN range(10000) AS g(k) ON 2 * k <= n GROUP BY id, k),
      a AS (SELECT id, CAST(k AS DOUBLE) AS k, sqrt(re * re + im * im) AS w FROM f),
      m AS (SELECT id, sum(k * w) / sum(w) AS m1, sum(k ** 2 * w) / sum(w) AS m2, sum(k ** 3 * w) / sum(w) AS m3,
        sum(k ** 4 * w) / sum(w) AS m4 FROM a GROUP BY id)
      SELECT id, {', '.join(out)} FROM (SELECT *, m2 - m1 * m1 AS v FROM m)"""


def _welch_sql(d: int) -> str:
    out = [r(f"max(p) FILTER (WHERE k = {k})", feature("spkt_welch_density", coeff=k), d) for k in spectral.WELCH_BINS]
    entropy = []
    for b in spectral.ENTROPY_BINS:
        # equal bins over [min, max] of the scaled density, the last one closed
        cell = f"least(floor((p / hi - lo / hi) / ((hi / hi - lo / hi) / {b})), {b - 1})"
        entropy.append(
            f"e{b} AS (SELECT id, -sum(c / t * ln(c / t)) AS e FROM (SELECT id, {cell} AS cell, count(*) AS c, max(t) AS t "
            f"FROM q GROUP BY id, cell) GROUP BY id)"
        )
        out.append(r(f"max(e{b}.e)", feature("fourier_entropy", bins=b), d))
    joins = " ".join(f"JOIN e{b} USING (id)" for b in spectral.ENTROPY_BINS)
    return f"""WITH {S2}, g AS (SELECT id, pos, x, n, unnest([pos // 128, pos // 128 - 1]) AS seg FROM s WHERE n >= 256),
      h AS (SELECT id, seg, pos - 128 * seg AS t, x FROM g WHERE seg >= 0 AND seg <= (n - 256) // 128),
      w AS (SELECT id, seg, t, (x - avg(x) OVER (PARTITION BY id, seg)) * (0.5 - 0.5 * cos(2 * pi() * t / 256)) AS y FROM h),
      f AS (SELECT id, seg, k, sum(y * cos(2 * pi() * ((k * t) % 256) / 256)) AS re,
        sum(y * sin(2 * pi() * ((k * t) % 256) / 256)) AS im FROM w, range(129) AS z(k) GROUP BY id, seg, k),
      psd AS (SELECT id, k, avg((re * re + im * im) / 96 * CASE WHEN k IN (0, 128) THEN 1 ELSE 2 END) AS p FROM f GROUP BY id, k),
      q AS (SELECT *, max(p) OVER (PARTITION BY id) AS hi, min(p) OVER (PARTITION BY id) AS lo,
        count(*) OVER (PARTITION BY id) AS t FROM psd),
      {', '.join(entropy)}
      SELECT id, {', '.join(out)} FROM psd {joins} GROUP BY id"""


def _cwt_sql(d: int) -> str:
    out = []
    for w in spectral.CWT_WIDTHS:
        for i in range(spectral.CWT_COEFFICIENTS):
            value = f"sum(x * wt) FILTER (WHERE w = {w} AND i = {i})"
            out.append(r(value, feature("cwt_coefficients", coeff=i, w=w, widths="2_5_10_20"), d))
    return f"""WITH {S1}, p AS (SELECT id, x, n, w, i, least(10 * w, n) AS len,
        i + (least(10 * w, n) - 1) // 2 - pos AS place FROM s, (VALUES (2), (5), (10), (20)) AS a(w), range(15) AS b(i)),
      q AS (SELECT *, (place - (len - 1) / 2) ** 2 / (w * w) AS z FROM p WHERE place >= 0 AND place < len AND i < n),
      t AS (SELECT id, x, w, i, 2 / (sqrt(3 * w) * pi() ** 0.25) * (1 - z) * exp(-z / 2) AS wt FROM q)
      SELECT id, {', '.join(out)} FROM t GROUP BY id"""


def _cwt_peaks_sql(d: int) -> str:
    steps = []
    for w in range(1, 6):
        z = f"((b.pos - a.pos + 0.5) ** 2 / {w * w})"
        steps.append(
            f"c{w} AS (SELECT a.id, a.pos, sum(b.x * 2 / (sqrt({3 * w}) * pi() ** 0.25) * (1 - {z}) * exp(-{z} / 2)) AS v "
            f"FROM s a JOIN s b ON a.id = b.id AND b.pos BETWEEN a.pos - {5 * w} AND a.pos + {5 * w - 1} GROUP BY a.id, a.pos)"
        )
        local = (
            f"SELECT id, pos, coalesce(v > lag(v) OVER o AND v > lead(v) OVER o, false) AS m "
            f"FROM c{w} WINDOW o AS (PARTITION BY id ORDER BY pos)"
        )
        if w == 1:
            steps.append(f"m1 AS ({local})")
        else:
            steps.append(
                f"m{w} AS (SELECT l.id, l.pos, l.m AND q.near AS m FROM ({local}) l JOIN (SELECT id, pos, bool_or(m) "
                f"OVER (PARTITION BY id ORDER BY pos ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS near FROM m{w - 1}) q "
                f"ON l.id = q.id AND l.pos = q.pos)"
            )
    return f"""WITH {S1}, {', '.join(steps)}
      SELECT id, a AS "{feature('number_cwt_peaks', n=1)}", b AS "{feature('number_cwt_peaks', n=5)}"
      FROM (SELECT id, CAST(count_if(m) AS BIGINT) AS a FROM m1 GROUP BY id) JOIN (SELECT id, CAST(count_if(m) AS BIGINT) AS b FROM m5 GROUP BY id) USING (id)"""


def _binned_sql(d: int) -> str:
    return f"""WITH {S1}, t AS (SELECT *, min(x) OVER (PARTITION BY id) AS lo, max(x) OVER (PARTITION BY id) AS hi FROM s),
      b AS (SELECT id, least(floor((x - lo) * 10 / (hi - lo)), 9) AS bin, count(*) / max(n) AS p FROM t GROUP BY id, bin)
      SELECT id, {r('-sum(p * ln(p))', feature('binned_entropy', max_bins=10), d)} FROM b GROUP BY id"""


def _benford_sql(d: int) -> str:
    return f"""WITH {S1}, t AS (SELECT id, n, CAST(substr(printf('%.15e', abs(x)), 1, 1) AS INTEGER) AS k FROM s),
      p AS (SELECT id, g.k, count_if(t.k = g.k) / max(n) AS p FROM t, range(1, 10) AS g(k) GROUP BY id, g.k)
      SELECT id, {r('corr(p, log10(1 + 1.0 / k))', feature('benford_correlation'), d)} FROM p GROUP BY id"""


def _permutation_sql(d: int) -> str:
    out = [
        r(f"max(e) FILTER (WHERE d = {k})", feature("permutation_entropy", dimension=k, tau=1), d)
        for k in complexity.PERMUTATION_DIMENSIONS
    ]
    tuples = " UNION ALL ".join(
        f"SELECT id, {k} AS d, list_grade_up(l[1:{k}])::VARCHAR AS pat FROM t WHERE pos <= n - {k}"
        for k in complexity.PERMUTATION_DIMENSIONS
    )
    return f"""WITH {S1}, t AS (SELECT *, list(x) OVER (PARTITION BY id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 6 FOLLOWING) AS l FROM s),
      u AS ({tuples}), c AS (SELECT id, d, pat, count(*) AS c FROM u GROUP BY ALL),
      e AS (SELECT id, d, -sum(p * ln(p)) AS e FROM (SELECT id, d, c / sum(c) OVER (PARTITION BY id, d) AS p FROM c) GROUP BY id, d)
      SELECT id, {', '.join(out)} FROM e GROUP BY id"""


def _templates_sql(d: int) -> str:
    radii = (*complexity.APPROXIMATE_R, complexity.SAMPLE_R)
    two = ", ".join(f"count_if(d2 <= {q} * sd) AS a{i}" for i, q in enumerate(radii))
    three = ", ".join(f"count_if(d3 <= {q} * sd) AS b{i}" for i, q in enumerate(radii))
    out = []
    for i, q in enumerate(complexity.APPROXIMATE_R):
        phi = (f"abs(sum(ln(a{i} / (n - 1))) / max(n - 1) - sum(ln(b{i} / (n - 2))) FILTER (WHERE b{i} > 0) / max(n - 2))")
        out.append(r(phi, feature("approximate_entropy", m=2, r=q), d))
    k = len(radii) - 1
    pairs = f"(sum(b{k}) - count_if(b{k} > 0)) / (sum(a{k}) - count(*))"
    out.append(r(f"CASE WHEN {pairs} > 0 THEN -ln({pairs}) END", feature("sample_entropy"), d))
    return f"""WITH {S1}, t AS (SELECT id, pos, n, x, lead(x) OVER o AS y, lead(x, 2) OVER o AS z,
        stddev_pop(x) OVER (PARTITION BY id) AS sd FROM s WINDOW o AS (PARTITION BY id ORDER BY pos)),
      u AS (SELECT * FROM t WHERE y IS NOT NULL),
      p AS (SELECT a.id, a.pos, a.n, a.sd, greatest(abs(a.x - b.x), abs(a.y - b.y)) AS d2,
        CASE WHEN a.z IS NOT NULL AND b.z IS NOT NULL THEN greatest(abs(a.x - b.x), abs(a.y - b.y), abs(a.z - b.z)) END AS d3
        FROM u a JOIN u b ON a.id = b.id),
      c AS (SELECT id, pos, n, {two}, {three} FROM p GROUP BY id, pos, n)
      SELECT id, {', '.join(out)} FROM c GROUP BY id"""


def _line_sql(y: str, t: str) -> dict[str, str]:
    sxx, syy, sxy = f"regr_sxx({y}, {t})", f"regr_syy({y}, {t})", f"regr_sxy({y}, {t})"
    return {
        "slope": f"{sxy} / nullif({sxx}, 0)",
        "intercept": f"avg({y}) - {sxy} / nullif({sxx}, 0) * avg({t})",
        "rvalue": f"coalesce({sxy} / nullif(sqrt({sxx} * {syy}), 0), CASE WHEN {sxx} > 0 THEN 0.0 END)",
        "stderr": f"CASE WHEN count({y}) > 2 THEN sqrt(greatest({syy} - {sxy} * {sxy} / {sxx}, 0) / ((count({y}) - 2) * {sxx})) END",
    }


def _linear_sql(d: int) -> str:
    out = [r(e, feature("linear_trend", a), d) for a, e in _line_sql("x", "pos").items()]
    return f"WITH {S1} SELECT id, {', '.join(out)} FROM s GROUP BY id"


def _chunk_sql(d: int) -> str:
    aggs = ("max", "min", "mean", "var")
    lines = [f"{e} AS {agg}__{a}" for agg in aggs for a, e in _line_sql(f'v_{agg}', "k").items()]
    out = [
        r(f"max({agg}__{a}) FILTER (WHERE len = {c})", feature("agg_linear_trend", attr=a, chunk_len=c, f_agg=agg), d)
        for c in trend.CHUNK_LENGTHS for agg in aggs for a in ("slope", "intercept", "rvalue", "stderr")
    ]
    return f"""WITH {S1}, c AS (SELECT id, len, pos // len AS k, max(x) AS v_max, min(x) AS v_min, avg(x) AS v_mean, var_pop(x) AS v_var
        FROM s, (VALUES (5), (10), (50)) AS g(len) GROUP BY id, len, pos // len),
      l AS (SELECT id, len, {', '.join(lines)} FROM c GROUP BY id, len)
      SELECT id, {', '.join(out)} FROM l GROUP BY id"""


def _corridor_sql(d: int) -> str:
    edges = sorted({*trend.CORRIDOR_LOW, *trend.CORRIDOR_HIGH})
    q = ", ".join(f"quantile_cont(x, {e}) AS q{i}" for i, e in enumerate(edges))
    out = []
    for low in trend.CORRIDOR_LOW:
        for high in trend.CORRIDOR_HIGH:
            if low >= high:
                continue
            a, b = f"q{edges.index(low)}", f"q{edges.index(high)}"
            at = f"FILTER (WHERE least(x, nxt) >= {a} AND greatest(x, nxt) <= {b} AND nxt IS NOT NULL)"
            for isabs, step in ((False, "nxt - x"), (True, "abs(nxt - x)")):
                for name, fn in (("mean", "avg"), ("var", "var_pop")):
                    out.append(r(f"coalesce({fn}({step}) {at}, 0.0)",
                                 feature("change_quantiles", f_agg=name, isabs=isabs, qh=high, ql=low), d))
    return f"""WITH {S1}, e AS (SELECT id, {q} FROM s GROUP BY id),
      t AS (SELECT s.*, lead(x) OVER (PARTITION BY id ORDER BY pos) AS nxt FROM s)
      SELECT id, {', '.join(out)} FROM t JOIN e USING (id) GROUP BY id"""


def _minimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(open_series(scaled_events(spark, sf_dir), ["id"], bindings.S1_ORDER), "minimal")
    return rounded(impute(found, ["id"]), 3)


def _imputed_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trend of 50-sample chunks: short series give gaps, which the median fills."""
    found = FAMILIES["chunk_trend"](s1(spark, sf_dir))
    names = [feature("agg_linear_trend", attr="slope", chunk_len=50, f_agg=a) for a in ("max", "min")]
    return rounded(impute(found.select("id", *names), ["id"]), 5)


def _imputed_sql(d: int) -> str:
    names = [feature("agg_linear_trend", attr="slope", chunk_len=50, f_agg=a) for a in ("max", "min")]
    columns = ", ".join(f"max({a}__slope) FILTER (WHERE len = 50) AS f_{a}" for a in ("max", "min"))
    lines = [f"{_line_sql(f'v_{a}', 'k')['slope']} AS {a}__slope" for a in ("max", "min")]
    out = [r(f"coalesce(f_{a}, median(f_{a}) OVER ())", n, d) for a, n in zip(("max", "min"), names)]
    return f"""WITH {S1}, c AS (SELECT id, 50 AS len, pos // 50 AS k, max(x) AS v_max, min(x) AS v_min FROM s GROUP BY id, pos // 50),
      l AS (SELECT id, len, {', '.join(lines)} FROM c GROUP BY id, len),
      w AS (SELECT id, {columns} FROM l GROUP BY id) SELECT id, {', '.join(out)} FROM w"""


SHAPE = [0.0, 1.0, 3.0, 1.0, 0.0, 0.5]
CLOSE = 1.9


def _similar(block_rows: int | None = None) -> Callable:
    return lambda spark, sf_dir: similarity.query_similarity(s1(spark, sf_dir, block_rows), SHAPE, CLOSE)


def _similar_sql() -> str:
    """Every window as a list, normalised and compared value by value."""
    m = len(SHAPE)
    z = "list_transform(w, lambda v: (v - list_avg(w)) / list_stddev_pop(w))"
    return f"""WITH {S1}, a AS (SELECT id, pos, list(x) OVER (PARTITION BY id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {m - 1} FOLLOWING) AS w FROM s),
      q AS (SELECT {z} AS q FROM (SELECT {SHAPE}::DOUBLE[] AS w)),
      d AS (SELECT id, sqrt(list_sum(list_transform(list_zip({z}, q), lambda p: pow(p[1] - p[2], 2)))) AS d FROM a, q WHERE len(w) = {m})
      SELECT id, CAST(count(*) FILTER (WHERE d <= {CLOSE}) AS BIGINT) AS "{feature('query_similarity_count', normalize=True, threshold=CLOSE)}" FROM d GROUP BY id"""


def _split(name: str, digits: int) -> Callable:
    """The same family with blocks so small that most series take the hot plan."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(FAMILIES[name](s1(spark, sf_dir, block_rows=64)), digits)

    return query


SPECS: dict[str, tuple[str, int, Callable | None, Callable, tuple[str, ...]]] = {
    "feature_moments": ("moments", 4, _moments_sql, s1, ()),
    "feature_quantiles": ("quantiles", 6, _quantiles_sql, s1, ()),
    "feature_changes": ("changes", 5, _changes_sql, s1, ()),
    "feature_counts": ("counts", 6, _counts_sql, s1, ()),
    "feature_locations": ("locations", 6, _locations_sql, s1, ()),
    "feature_recurrence": ("recurrence", 6, _recurrence_sql, s1, ()),
    "feature_strikes": ("strikes", 6, _strikes_sql, s1, ()),
    "feature_peaks": ("peaks", 6, _peaks_sql, s1, ()),
    "feature_largest_magnitudes": ("largest_magnitudes", 6, _largest_sql, s1, ()),
    "feature_mass": ("mass", 6, _mass_sql, s1, ()),
    "feature_autocorrelation": ("autocorrelation", 6, _autocorrelation_sql, s1, ()),
    "feature_lagged_products": ("lagged_products", 2, _lagged_sql, s1, ()),
    "feature_ar_coefficients": ("ar_coefficients", 5, None, s1, ()),
    "feature_unit_root": ("unit_root", 5, None, s1, ()),
    "feature_fft_coefficients": (
        "fft_coefficients", 5, _fft_sql, s1,
        tuple(feature("fft_coefficient", "angle", coeff=k) for k in range(spectral.FFT_COEFFICIENTS)),
    ),
    "feature_fft_moments": ("fft_moments", 6, _fft_moments_sql, s1, ()),
    "feature_welch": ("welch", 5, _welch_sql, s2, ()),
    "feature_cwt_coefficients": ("cwt_coefficients", 5, _cwt_sql, s1, ()),
    "feature_cwt_peaks": ("cwt_peaks", 6, _cwt_peaks_sql, s1, ()),
    "feature_binned_entropy": ("binned_entropy", 6, _binned_sql, s1, ()),
    "feature_benford": ("benford", 6, _benford_sql, s1, ()),
    "feature_permutation_entropy": ("permutation_entropy", 6, _permutation_sql, s1, ()),
    "feature_lempel_ziv": ("lempel_ziv", 6, None, s1, ()),
    "feature_template_entropies": ("template_entropies", 6, _templates_sql, s1, ()),
    "feature_linear_trend": ("linear_trend", 6, _linear_sql, s1, (PVALUE,)),
    "feature_chunk_trend": ("chunk_trend", 5, _chunk_sql, s1, ()),
    "feature_corridor_changes": ("corridor_changes", 4, _corridor_sql, s1, ()),
    "feature_drift": ("drift", 6, None, s1, ()),
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    key: _family(name, digits, source, drop) for key, (name, digits, _, source, drop) in SPECS.items()
}
QUERIES["feature_linear_trend_pvalue"] = lambda spark, sf_dir: rounded(
    FAMILIES["linear_trend"](s1(spark, sf_dir)).select("id", PVALUE), 6
)
QUERIES["feature_fft_angles"] = lambda spark, sf_dir: rounded(
    spectral.fft_coefficients(s1(spark, sf_dir)).select(
        "id", *[feature("fft_coefficient", "angle", coeff=k) for k in range(1, 30)]
    ), 4
)
QUERIES["feature_imputed"] = _imputed_quantiles
QUERIES["feature_set_minimal"] = _minimal
QUERIES["feature_query_similarity"] = _similar()
QUERIES["feature_query_similarity_split"] = _similar(64)

ORACLES: dict[str, str] = {key: sql(digits) for key, (_, digits, sql, _, _) in SPECS.items() if sql is not None}
ORACLES["feature_imputed"] = _imputed_sql(5)
ORACLES["feature_query_similarity"] = ORACLES["feature_query_similarity_split"] = _similar_sql()
ORACLES["feature_linear_trend_pvalue"] = f"""WITH {S1}, l AS (SELECT id, {_line_sql("x", "pos")["slope"]} AS b, {_line_sql("x", "pos")["stderr"]} AS e, count(x) AS n FROM s GROUP BY id)
  SELECT id, {r(t_tail_sql("b / e", "(n - 2)"), PVALUE)} FROM l"""
ORACLES["feature_fft_angles"] = (
    lambda d: f"""WITH {S1}, f AS (SELECT id, k, sum(x * cos(2 * pi() * ((k * pos) % n) / n)) AS re,
        CASE WHEN 2 * k = max(n) THEN 0.0 ELSE -sum(x * sin(2 * pi() * ((k * pos) % n) / n)) END AS im
        FROM s JOIN range(1, 30) AS g(k) ON 2 * k <= n GROUP BY id, k)
      SELECT id, {', '.join(r(f"max(degrees(atan2(im, re))) FILTER (WHERE k = {k})",
        feature("fft_coefficient", "angle", coeff=k), d) for k in range(1, 30))} FROM f GROUP BY id"""
)(4)

for _name in ("changes", "autocorrelation", "mass", "strikes", "quantiles", "fft_moments", "template_entropies", "peaks"):
    _key = f"feature_{_name}"
    QUERIES[f"{_key}_split"] = _split(_name, SPECS[_key][1])
    ORACLES[f"{_key}_split"] = ORACLES[_key]

#: Twins of families over S1; the default set is their columns side by side.
_SET = [ORACLES[key] for key, (_, _, sql, source, _) in SPECS.items() if sql is not None and source is s1]
_SET += [ORACLES["feature_fft_angles"], ORACLES["feature_linear_trend_pvalue"]]
_COLUMNS = [name for sql in _SET for name in re.findall(r'AS "(flux__[^"]+)"', sql)]
_DIGITS = {name: int(digits) for sql in _SET for digits, name in re.findall(r', (\d+)\) \+ 0\.0 AS "(flux__[^"]+)"', sql)}


def _comprehensive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every feature of the default set that a twin gives, from one extraction."""
    found = extract(open_series(scaled_events(spark, sf_dir), ["id"], bindings.S1_ORDER), "comprehensive")
    return found.select("id", *[(F.round(c, _DIGITS.get(c, 6)) + F.lit(0.0)).alias(c) for c in _COLUMNS])


QUERIES["feature_set_comprehensive"] = _comprehensive
_WHOLE = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in _COLUMNS if c not in _DIGITS)  # counts and flags are numbers in a set
ORACLES["feature_set_comprehensive"] = f"SELECT * REPLACE ({_WHOLE}) FROM ({_SET[0]})" + "".join(f" LEFT JOIN ({sql}) USING (id)" for sql in _SET[1:])
