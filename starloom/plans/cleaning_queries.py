"""Queries for series cleaning over the given tables, with SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import cleaning
from starloom.operators.series import Series, open_series
from starloom.plans import bindings
from starloom.plans.compare import r, rounded

GAP_DAYS = 25.0


def _s1(spark: SparkSession, sf_dir: str, block_rows: int | None = None) -> Series:
    rows = cleaning.valid_samples(bindings.event_series(spark, sf_dir))
    return open_series(rows, ["id"], bindings.S1_ORDER, block_rows)


def _s2(spark: SparkSession, sf_dir: str, block_rows: int | None = None) -> Series:
    rows = cleaning.valid_samples(bindings.lineitem_series(spark, sf_dir))
    return open_series(rows, ["id"], bindings.S2_ORDER, block_rows)


def _normalized(method: str):
    return lambda spark, sf_dir: rounded(cleaning.normalize(_s2(spark, sf_dir), method).rows(), 8)


def _preprocess(block_rows: int | None = None, **options):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = bindings.lineitem_series(spark, sf_dir)
        return rounded(
            cleaning.preprocess(raw, bindings.S2_ORDER, outlier_sigma=1.2, block_rows=block_rows, **options).rows(), 7
        )

    return query


def _resampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = _s2(spark, sf_dir).with_columns(flux=F.col("flux") / F.pi(), flux_err=F.col("flux_err") / F.pi())
    s = cleaning.interpolate_gaps(scaled, GAP_DAYS)
    return rounded(s.rows().select("id", "time", "flux", "flux_err"), 5)


def _cadence(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _s1(spark, sf_dir).located(1).windowed(lambda w: {"dt": w.ahead("time") - F.col("time")})
    s = s.with_quantiles("dt", cadence=0.5)
    return rounded(s.per_key(F.max("cadence").alias("cadence"), F.max("dt").alias("widest_gap")), 7)


def _families(block_rows: int | None = None):
    """Every kind of neighbour frame, running value and total, per sample."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = bindings.event_series(spark, sf_dir).withColumn("flux", F.col("flux") / F.pi())
        s = open_series(rows, ["id"], bindings.S1_ORDER, block_rows).located(7).windowed(lambda w: {
            "before": w.back("flux", 7), "after": w.ahead("flux", 5), "step": w.ahead("time") - w.back("time"),
            "near_sum": w.frame(F.sum("flux"), -7, 7), "near_low": w.frame(F.min("flux"), -3, 0), "near_mean": w.frame(F.avg("flux"), 1, 6),
            "near_first": w.frame(F.first("event_id"), -5, 2), "near_n": w.frame(F.count(F.lit(1)), -7, 7),
        })
        s = s.with_running(so_far=F.col("flux")).with_latest(top=F.col("flux")).with_stats(n=F.count(F.lit(1)))
        s = s.with_columns(row_number=F.col("pos") + 1, percent_rank=F.col("pos") / F.greatest(F.col("n") - 1, F.lit(1)))
        return rounded(s.rows().drop("time", "flux", "flux_err", "pos"), 6)

    return query


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bindings.event_series(spark, sf_dir).withColumn("flux", F.col("flux") / F.pi())
    return rounded(cleaning.quality_metrics(open_series(rows, ["id"], bindings.S1_ORDER)), 6)


VALID = "isfinite(time) AND isfinite(flux) AND isfinite(flux_err) AND flux > 0"
V1 = f"v AS (SELECT * FROM ({bindings.S1_SQL}) WHERE {VALID})"
V2 = f"v AS (SELECT * FROM ({bindings.S2_SQL}) WHERE {VALID})"
S2_COLUMNS = "id, time, flux, flux_err, order_key, line_number"


def _clip(source: str, k: float, columns: str) -> str:
    """CTEs that end in ``c``, the clipped rows of ``source``."""
    return f"""
      m AS (SELECT *, median(flux) OVER (PARTITION BY id) AS med FROM {source}),
      d AS (SELECT *, median(abs(flux - med)) OVER (PARTITION BY id) AS mad FROM m),
      c AS (SELECT {columns} FROM d WHERE abs(flux - med) < {k} * {cleaning.MAD_SCALE} * mad)"""


def _s2_rows(source: str, flux: str, err: str, d: int) -> str:
    return f"""SELECT id, {r('time', 'time', d)}, {r(flux, 'flux', d)}, {r(err, 'flux_err', d)}, order_key, line_number
      FROM {source}"""


def _detrended(source: str) -> str:
    """CTEs that end in ``t``, by Gram polynomials on a window of 101 samples."""
    p = {
        0: "1.0", 1: "{z}", 2: "({z} * {z} - 50.0 * 51 / 3)",
        3: "({z} ** 3 - {z} * (3.0 * 50 * 50 + 3 * 50 - 1) / 5)",
    }
    at = lambda k, z: p[k].format(z=z)
    norms = ", ".join(f"sum(({at(k, 'z')}) ** 2) AS n{k}" for k in range(4))
    weight = " + ".join(f"{at(k, 'za')} * {at(k, 'zb')} / n{k}" for k in range(4))
    return f"""
      q AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY time, order_key, line_number) - 1 AS pos,
        count(*) OVER (PARTITION BY id) AS n, median(flux) OVER (PARTITION BY id) AS med FROM {source}),
      b AS (SELECT *, least(greatest(pos - 50, 0), n - 101) AS start FROM q),
      norm AS (SELECT {norms} FROM (SELECT CAST(i AS DOUBLE) AS z FROM range(-50, 51) AS g(i))),
      j AS (SELECT a.id, a.pos, CAST(a.pos - a.start - 50 AS DOUBLE) AS za, CAST(o.pos - a.start - 50 AS DOUBLE) AS zb,
        o.flux AS f FROM b a JOIN b o ON a.id = o.id AND o.pos BETWEEN a.start AND a.start + 100 AND a.n >= 101),
      fit AS (SELECT id, pos, sum(f * ({weight})) AS trend FROM j, norm GROUP BY id, pos),
      t AS (SELECT b.id, time, CASE WHEN trend IS NULL THEN flux ELSE flux - trend + med END AS flux, flux_err,
        order_key, line_number FROM b LEFT JOIN fit ON b.id = fit.id AND b.pos = fit.pos)"""


GATE = "g AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY id) AS n FROM v) WHERE n >= 100)"
NORM = "z AS (SELECT id, time, flux / s AS flux, flux_err / s AS flux_err, order_key, line_number FROM (SELECT *, median(flux) OVER (PARTITION BY id) AS s FROM c))"

METRICS = ", ".join(
    r(e, n)
    for n, e in {
        "time_span_days": "max(time) - min(time)", "mean_flux": "avg(flux)", "std_flux": "stddev_pop(flux)",
        "median_flux": "max(med)", "mad_flux": "median(abs(flux - med))",
        "snr": "coalesce(max(med) / nullif(stddev_pop(flux), 0), 0.0)",
    }.items()
)

QUERIES = {
    "valid_samples": lambda spark, sf_dir: rounded(
        cleaning.valid_samples(bindings.event_series(spark, sf_dir)).select("id", "event_id", "flux"), 6
    ),
    "minimum_points": lambda spark, sf_dir: cleaning.minimum_points(_s1(spark, sf_dir), 70).per_key(
        F.count(F.lit(1)).alias("n")
    ),
    "sigma_clip": lambda spark, sf_dir: rounded(
        cleaning.sigma_clip(_s1(spark, sf_dir), 5.0).rows().select("id", "event_id", "flux"), 6
    ),
    "sigma_clip_split": lambda spark, sf_dir: rounded(
        cleaning.sigma_clip(_s1(spark, sf_dir, 64), 5.0).rows().select("id", "event_id", "flux"), 6
    ),
    "normalize_median": _normalized("median"),
    "normalize_mean": _normalized("mean"),
    "normalize_minmax": _normalized("minmax"),
    "cadence": _cadence,
    "interpolate_gaps": _resampled,
    "detrend": lambda spark, sf_dir: rounded(cleaning.detrend(_s2(spark, sf_dir)).rows(), 4),
    "windowed_families": _families(),
    "windowed_families_split": _families(16),
    "quality_metrics": _quality,
    "admission": lambda spark, sf_dir: cleaning.admission(bindings.event_series(spark, sf_dir)),
    "rejected": lambda spark, sf_dir: cleaning.rejected(bindings.event_series(spark, sf_dir), 65),
    "preprocess": _preprocess(),
    "preprocess_light": _preprocess(detrend_flux=False),
    "preprocess_split": _preprocess(block_rows=580),
}

ORACLES = {
    "valid_samples": f"WITH {V1} SELECT id, event_id, {r('flux', 'flux')} FROM v",
    "minimum_points": f"WITH {V1} SELECT id, count(*) AS n FROM v GROUP BY id HAVING count(*) >= 70",
    "sigma_clip": f"WITH {V1}, {_clip('v', 5.0, '*')} SELECT id, event_id, {r('flux', 'flux')} FROM c",
    "normalize_median": f"WITH {V2}, c AS (SELECT * FROM v), {NORM} {_s2_rows('z', 'flux', 'flux_err', 8)}",
    "normalize_mean": f"""WITH {V2}, c AS (SELECT *, avg(flux) OVER (PARTITION BY id) AS s FROM v)
      {_s2_rows('c', 'flux / s', 'flux_err / s', 8)}""",
    "normalize_minmax": f"""WITH {V2}, c AS (SELECT *, min(flux) OVER (PARTITION BY id) AS lo, max(flux) OVER (PARTITION BY id) AS hi FROM v)
      {_s2_rows('c', '(flux - lo) / (hi - lo)', 'flux_err / (hi - lo)', 8)}""",
    "cadence": f"""WITH {V1}, t AS (SELECT id, lead(time) OVER (PARTITION BY id ORDER BY time, event_id) - time AS dt FROM v)
      SELECT id, {r('median(dt)', 'cadence', 7)}, {r('max(dt)', 'widest_gap', 7)} FROM t GROUP BY id""",
    "interpolate_gaps": f"""WITH {V2}, a AS (SELECT id, time, avg(flux / pi()) AS f, avg(flux_err / pi()) AS e FROM v GROUP BY id, time),
      l AS (SELECT *, lead(time) OVER o AS t1, lead(f) OVER o AS f1, lead(e) OVER o AS e1 FROM a WINDOW o AS (PARTITION BY id ORDER BY time)),
      k AS (SELECT *, min(time) OVER (PARTITION BY id) AS t0, median(t1 - time) OVER (PARTITION BY id) AS step,
        max(t1 - time) OVER (PARTITION BY id) AS gap FROM l),
      p AS (SELECT *, unnest(range(CAST(ceil((time - t0) / step) AS BIGINT), CAST(ceil((t1 - t0) / step) AS BIGINT))) AS g
        FROM k WHERE gap > {GAP_DAYS} AND t1 IS NOT NULL),
      u AS (SELECT id, t0 + g * step AS time, f + (f1 - f) * (t0 + g * step - time) / (t1 - time) AS flux,
          e + (e1 - e) * (t0 + g * step - time) / (t1 - time) AS flux_err FROM p
        UNION ALL SELECT id, time, flux / pi(), flux_err / pi() FROM v WHERE id IN (SELECT id FROM k GROUP BY id HAVING max(gap) <= {GAP_DAYS}))
      SELECT id, {r('time', 'time', 5)}, {r('flux', 'flux', 5)}, {r('flux_err', 'flux_err', 5)} FROM u""",
    "detrend": f"WITH {V2}, {_detrended('v')} {_s2_rows('t', 'flux', 'flux_err', 4)}",
    "windowed_families": f"""WITH v AS (SELECT * REPLACE (flux / pi() AS flux) FROM ({bindings.S1_SQL}))
      SELECT id, event_id, {r('lag(flux, 7) OVER w', 'before')}, {r('lead(flux, 5) OVER w', 'after')},
        {r('lead(time) OVER w - lag(time) OVER w', 'step')}, {r('sum(flux) OVER (w ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING)', 'near_sum')},
        {r('min(flux) OVER (w ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)', 'near_low')},
        {r('avg(flux) OVER (w ROWS BETWEEN 1 FOLLOWING AND 6 FOLLOWING)', 'near_mean')},
        first_value(event_id) OVER (w ROWS BETWEEN 5 PRECEDING AND 2 FOLLOWING) AS near_first,
        count(*) OVER (w ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING) AS near_n,
        {r('sum(flux) OVER (w ROWS UNBOUNDED PRECEDING)', 'so_far')}, {r('max(flux) OVER (w ROWS UNBOUNDED PRECEDING)', 'top')},
        count(*) OVER (PARTITION BY id) AS n, row_number() OVER w AS row_number, {r('percent_rank() OVER w', 'percent_rank')}
      FROM v WINDOW w AS (PARTITION BY id ORDER BY time, event_id)""",
    "quality_metrics": f"""WITH a AS (SELECT * REPLACE (flux / pi() AS flux), {VALID} AS ok FROM ({bindings.S1_SQL})),
      m AS (SELECT *, median(flux) OVER (PARTITION BY id) AS med FROM a WHERE ok),
      q AS (SELECT id, count(*) AS n_points, {METRICS} FROM m GROUP BY id),
      w AS (SELECT id, {r('count(*) FILTER (WHERE ok) / count(*)', 'completeness')} FROM a GROUP BY id)
      SELECT * FROM q JOIN w USING (id)""",
    "admission": f"""SELECT id, count(*) AS n_rows, bool_or(NOT isnan(time)) AND bool_or(NOT isnan(flux)) AS admitted
      FROM ({bindings.S1_SQL}) GROUP BY id""",
    "rejected": f"""WITH {V1}, m AS (SELECT *, median(flux) OVER (PARTITION BY id) AS med FROM v),
      q AS (SELECT id, count(*) AS n_valid, median(abs(flux - med)) AS mad FROM m GROUP BY id)
      SELECT id, n_valid, CASE WHEN n_valid < 65 THEN 'too_few_points' ELSE 'mad_zero' END AS reason
      FROM q WHERE n_valid < 65 OR mad = 0""",
    "preprocess_light": f"WITH {V2}, {GATE}, {_clip('g', 1.2, S2_COLUMNS)}, {NORM} {_s2_rows('z', 'flux', 'flux_err', 7)}",
    "preprocess": f"""WITH {V2}, {GATE}, {_clip('g', 1.2, S2_COLUMNS)}, {NORM}, {_detrended('z')}
      {_s2_rows('t', 'flux', 'flux_err', 7)}""",
}
ORACLES["sigma_clip_split"] = ORACLES["sigma_clip"]
ORACLES["preprocess_split"] = ORACLES["preprocess"]
ORACLES["windowed_families_split"] = ORACLES["windowed_families"]
