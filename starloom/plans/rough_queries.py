"""Queries over derived rows in which the rules bite: gaps, bad values, repeated labels, files and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.names import feature
from starloom.operators import catalog, cleaning, monitor, selection
from starloom.operators.joins import attach_labels
from starloom.operators.series import open_series
from starloom.plans import bindings, extraction, matrix_queries, selection_queries
from starloom.plans.bindings import table
from starloom.plans.cleaning_queries import GAP_DAYS, GATE, NORM, ORACLES as CLEANING, S2_COLUMNS, V2, VALID, _clip, _s2
from starloom.plans.compare import r, rounded
from starloom.session import scratch_path
from starloom.sources import series

MOMENTS = {"moments": [feature(c) for c in ("mean", "minimum", "maximum", "length")]}


def rough_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with every kind of bad value, constant series, and series without a number."""
    rows = bindings.event_series(spark, sf_dir)
    e, flux = F.col("event_id"), F.col("flux") / F.pi()
    bad = (
        F.when(F.col("id") % 7 == 3, F.lit(float("nan"))).when(F.col("id") % 5 == 1, F.lit(7.0))
        .when(e % 13 == 0, F.lit(float("nan"))).when(e % 13 == 1, F.lit(float("inf"))).when(e % 13 == 2, F.lit(float("-inf")))
        .when(e % 13 == 3, F.lit(0.0)).when(e % 13 == 4, -flux).when(e % 13 == 5, F.lit(None)).otherwise(flux)
    )
    return rows.withColumns({
        "flux": bad.cast("double"), "time": F.when(e % 17 != 0, F.col("time")),
        "flux_err": F.when(e % 19 == 0, F.lit(float("nan"))).otherwise(F.col("flux_err")),
    })


ROUGH = f"""r AS (SELECT id, event_id, CASE WHEN event_id % 17 <> 0 THEN time END AS time,
    CASE WHEN event_id % 19 = 0 THEN 'nan'::DOUBLE ELSE flux_err END AS flux_err,
    CASE WHEN id % 7 = 3 THEN 'nan'::DOUBLE WHEN id % 5 = 1 THEN 7.0 WHEN event_id % 13 = 0 THEN 'nan'::DOUBLE
      WHEN event_id % 13 = 1 THEN 'inf'::DOUBLE WHEN event_id % 13 = 2 THEN '-inf'::DOUBLE WHEN event_id % 13 = 3 THEN 0.0
      WHEN event_id % 13 = 4 THEN -flux / pi() WHEN event_id % 13 = 5 THEN NULL ELSE flux / pi() END AS flux
    FROM ({bindings.S1_SQL}))"""
OK = f"coalesce({VALID}, false)"


def _rough_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cleaning.quality_metrics(open_series(rough_events(spark, sf_dir), ["id"], bindings.S1_ORDER))
    return rounded(found.select("id", "n_points", "median_flux", "mad_flux", "completeness"), 6)


def _flipped(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    labels = matrix_queries.supplier_labels(spark, sf_dir)
    ids = bindings.lineitem_series(spark, sf_dir).select("id").distinct()
    both = labels.withColumn("_order", F.lit(0)).unionByName(labels.select("id", (1 - F.col("label")).alias("label"), F.lit(1).alias("_order")))
    return ids, both


def _labels_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids, both = _flipped(spark, sf_dir)
    return attach_labels(ids, both, F.col("_order"))


def _labels_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same labels through CSV files, where file and line say which is last."""
    ids, both = _flipped(spark, sf_dir)
    path = scratch_path(spark)
    ranges = both.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "_order", "id")
    ranges.sortWithinPartitions("_order", "id").drop("_order").write.option("header", "true").csv(path)
    named = ids.select(F.col("id").cast("string").alias("id"))
    found = attach_labels(named, series.read_labels(spark, path), F.col("_order"))
    return found.select(F.col("id").cast("long").alias("id"), "label")


def _correlations_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 7th value null, every 11th NaN, and a feature without spread."""
    names = selection_queries.NAMES
    rows = selection_queries.matrix(spark, sf_dir).select(
        "id", "label",
        *[
            F.when((F.col("id") + i) % 11 == 0, F.lit(float("nan"))).when((F.col("id") + i) % 7 != 0, F.lit(0.25) if i == 5 else F.col(n)).alias(n)
            for i, n in enumerate(names)
        ],
    )
    pairs = selection.correlations(rows, names).filter("corr is not null")
    return rounded(pairs.groupBy("feature").agg(F.max(F.abs("corr")).alias("strongest"), F.count(F.lit(1)).alias("n")), 6)


def _series_dir(spark: SparkSession, sf_dir: str) -> str:
    """One file per supplier."""
    out = scratch_path(spark)
    rows = bindings.lineitem_series(spark, sf_dir).select(
        F.col("id").alias("PARTITION"), F.col("time").alias("TIME"), F.col("flux").alias("SAP_FLUX")
    )
    rows.repartition("PARTITION").write.partitionBy("PARTITION").parquet(out)
    return out


def _flat_dir(spark: SparkSession, sf_dir: str) -> str:
    """One file per supplier in one folder."""
    out = scratch_path(spark)
    rows = bindings.lineitem_series(spark, sf_dir).select(
        F.col("id").alias("PARTITION"), F.col("time").alias("TIME"), F.col("flux").alias("SAP_FLUX")
    )
    series.write_files(rows, out, "PARTITION")
    return out


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first files by path."""
    listed = series.list_files(spark, _series_dir(spark, sf_dir), "*.parquet", recursive=True, max_files=7)
    return listed.select(F.regexp_extract("path", "PARTITION=([0-9]+)", 1).cast("long").alias("id"))


def _read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series read by file; names of files are random, so only their contents are compared."""
    rows = series.read_series(spark, _flat_dir(spark, sf_dir), "parquet")
    return rounded(rows.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.max("flux").alias("top"), F.max("flux_err").alias("err")).drop("id"), 6)


def _sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series and metrics written and read."""
    out, beside = scratch_path(spark), scratch_path(spark)
    rows = bindings.lineitem_series(spark, sf_dir)
    series.write_series(rows, out, buckets=4, rows_per_task=1000)
    stored = spark.read.parquet(out)
    series.write_metrics(rows.groupBy("id").agg(F.max("flux").alias("top")), beside)
    counts = stored.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("bucket").alias("n_buckets"))
    return rounded(counts.join(spark.read.parquet(beside), "id"), 6)


def _directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan, light extraction and resume: the second call finds nothing left."""
    out, folder = scratch_path(spark), _flat_dir(spark, sf_dir)
    options = {"order": ["time"], "feature_set": MOMENTS, "clean": False}
    first = extraction.process_directory(spark, folder, out, **options).first()
    second = extraction.process_directory(spark, folder, out, **options).first()
    found = spark.read.parquet(out).drop("id")
    return rounded(found.withColumns({"n_processed": F.lit(first["n_processed"]), "n_left": F.lit(second["n_given"])}), 6)


def _metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the metrics of the rules; values scaled so that every rule fires now and then."""
    e = F.col("event_id") % 5
    metrics = F.array(*[F.lit(rule[0]) for rule in monitor.RULES.values()])
    scaled = (
        F.when(e == 0, F.col("value") * 50).when(e == 1, F.exp(-F.col("value") / 100)).when(e == 2, F.when(F.col("value") > 10, 0.0).otherwise(1.0))
        .when(e == 3, F.col("value") * 5).otherwise(F.exp(-F.col("value") / 200))
    )
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), F.get(metrics, e.cast("int")).alias("metric"), F.col("user_id").alias("service"), scaled.alias("value"), "event_id"
    )


def _rule_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = monitor.rule_alerts(_metric_samples(spark, sf_dir), ["ts", "event_id"])
    return found.select("alert", "service", F.unix_micros("started").alias("started_us"), "n_samples")


def _bad_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nights whose dates do not all parse; those give no images."""
    days = table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day")).distinct()
    start = F.when(F.dayofmonth("day") % 3 == 0, F.replace("day", F.lit("-"), F.lit("/"))).when(F.dayofmonth("day") % 3 == 1, F.lit("2024-02-31")).otherwise(F.col("day"))
    found = catalog.image_manifest(days.select(start.alias("start"), F.col("day").alias("end")), [300], 1_000_000, "x/")
    return found.groupBy("date").agg(F.count(F.lit(1)).alias("n"))


def _resampled_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = _s2(spark, sf_dir, 580).with_columns(flux=F.col("flux") / F.pi(), flux_err=F.col("flux_err") / F.pi())
    return rounded(cleaning.interpolate_gaps(scaled, GAP_DAYS).rows().select("id", "time", "flux", "flux_err"), 5)


def _filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bindings.lineitem_series(spark, sf_dir)
    s = cleaning.preprocess(raw, bindings.S2_ORDER, outlier_sigma=1.2, fill_gaps=True, max_gap=GAP_DAYS, detrend_flux=False)
    return rounded(s.rows().select("id", "time", "flux", "flux_err"), 5)


QUERIES = {
    "valid_samples_rough": lambda spark, sf_dir: rounded(
        cleaning.valid_samples(rough_events(spark, sf_dir)).select("id", "event_id", "flux"), 6
    ),
    "admission_rough": lambda spark, sf_dir: cleaning.admission(rough_events(spark, sf_dir)),
    "quality_metrics_rough": _rough_quality,
    "rejected_rough": lambda spark, sf_dir: cleaning.rejected(rough_events(spark, sf_dir), 30),
    "labels_repeated": _labels_repeated,
    "labels_from_csv": _labels_from_csv,
    "correlation_filter_with_gaps": _correlations_with_gaps,
    "directory_scan": _listed,
    "series_read": _read,
    "series_sink": _sink,
    "directory_extraction": _directory,
    "rule_alerts": _rule_alerts,
    "bad_dates": _bad_dates,
    "interpolate_gaps_split": _resampled_split,
    "preprocess_filled": _filled,
}

_FLIPPED = """SELECT DISTINCT l_suppkey AS id, CAST(coalesce(n_regionkey % 2 <> 0, false) AS INTEGER) AS label FROM lineitem
  LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey"""
_RULES = ", ".join(f"({i}, '{n}', '{m}', {limit}, {s})" for i, (n, (m, _, limit, s)) in enumerate(monitor.RULES.items()))
_SIGNS = " ".join(f"WHEN {i} THEN v {'=' if rule[1] == '==' else rule[1]} {rule[2]}" for i, rule in enumerate(monitor.RULES.values()))

ORACLES = {
    "valid_samples_rough": f"WITH {ROUGH} SELECT id, event_id, {r('flux', 'flux')} FROM r WHERE {VALID}",
    "admission_rough": f"""WITH {ROUGH} SELECT id, count(*) AS n_rows,
      coalesce(bool_or(NOT isnan(time)), false) AND coalesce(bool_or(NOT isnan(flux)), false) AS admitted FROM r GROUP BY id""",
    "quality_metrics_rough": f"""WITH {ROUGH}, m AS (SELECT *, median(flux) FILTER ({OK}) OVER (PARTITION BY id) AS med FROM r)
      SELECT id, count(*) FILTER ({OK}) AS n_points, {r(f'max(med)', 'median_flux')}, {r(f'median(abs(flux - med)) FILTER ({OK})', 'mad_flux')},
        {r(f'count(*) FILTER ({OK}) / count(*)', 'completeness')} FROM m GROUP BY id""",
    "rejected_rough": f"""WITH {ROUGH}, m AS (SELECT *, median(flux) FILTER ({OK}) OVER (PARTITION BY id) AS med FROM r),
      q AS (SELECT id, count(*) FILTER ({OK}) AS n_valid, median(abs(flux - med)) FILTER ({OK}) AS mad FROM m GROUP BY id)
      SELECT id, n_valid, CASE WHEN n_valid < 30 THEN 'too_few_points' ELSE 'mad_zero' END AS reason FROM q WHERE n_valid < 30 OR mad = 0""",
    "labels_repeated": _FLIPPED,
    "labels_from_csv": _FLIPPED,
    "correlation_filter_with_gaps": f"""WITH {selection_queries.LONG},
      k AS (SELECT id, CAST(substr(feature, 2) AS INTEGER) AS i, CASE WHEN feature = 'f5' THEN 0.25 ELSE value END AS value FROM l),
      g AS (SELECT * FROM k WHERE (id + i) % 7 <> 0 AND (id + i) % 11 <> 0),
      p AS (SELECT b.i, corr(a.value, b.value) AS c FROM g a JOIN g b ON a.id = b.id AND a.i < b.i WHERE a.i <> 5 AND b.i <> 5 GROUP BY a.i, b.i)
      SELECT 'f' || i AS feature, {r('max(abs(c))', 'strongest')}, count(*) AS n FROM p WHERE isfinite(c) GROUP BY i""",
    "directory_scan": "SELECT id FROM (SELECT DISTINCT l_suppkey AS id FROM lineitem) ORDER BY 'PARTITION=' || id || '/' LIMIT 7",
    "series_read": f"SELECT count(*) AS n, {r('max(l_extendedprice)', 'top')}, 1.0::DOUBLE AS err FROM lineitem GROUP BY l_suppkey",
    "series_sink": f"SELECT l_suppkey AS id, count(*) AS n, 1::BIGINT AS n_buckets, {r('max(l_extendedprice)', 'metrics_top')} FROM lineitem GROUP BY l_suppkey",
    "directory_extraction": f"""WITH v AS (SELECT l_suppkey AS id, l_extendedprice AS flux FROM lineitem WHERE l_extendedprice > 0),
      m AS (SELECT id, {r('avg(flux)', feature('mean'))}, {r('min(flux)', feature('minimum'))}, {r('max(flux)', feature('maximum'))},
        CAST(count(*) AS DOUBLE) AS "{feature('length')}" FROM v GROUP BY id)
      SELECT * EXCLUDE (id), count(*) OVER () AS n_processed, 0::BIGINT AS n_left FROM m""",
    "rule_alerts": f"""WITH rule(i, alert, metric, lim, seconds) AS (VALUES {_RULES}),
      s AS (SELECT user_id AS service, ts, event_id, event_id % 5 AS i, CASE event_id % 5 WHEN 0 THEN value * 50 WHEN 1 THEN exp(-value / 100)
        WHEN 2 THEN CASE WHEN value > 10 THEN 0.0 ELSE 1.0 END WHEN 3 THEN value * 5 ELSE exp(-value / 200) END AS v FROM events),
      h AS (SELECT *, CASE i {_SIGNS} END AS hit FROM s),
      a AS (SELECT *, sum(CASE WHEN hit THEN 0 ELSE 1 END) OVER (PARTITION BY service, i ORDER BY ts, event_id) AS g FROM h),
      b AS (SELECT service, i, epoch_us(min(ts)) AS started_us, epoch_us(max(ts)) AS ended_us, count(*) AS n_samples FROM a WHERE hit GROUP BY service, i, g)
      SELECT alert, service, started_us, n_samples FROM b JOIN rule USING (i) WHERE ended_us - started_us >= seconds * 1000000::BIGINT""",
    "bad_dates": """SELECT strftime(day, '%Y-%m-%d') AS date, 4::BIGINT AS n FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events)
      WHERE dayofmonth(day) % 3 = 2""",
    "interpolate_gaps_split": CLEANING["interpolate_gaps"],
    "preprocess_filled": f"""WITH {V2}, {GATE}, {_clip('g', 1.2, S2_COLUMNS)}, {NORM},
      a AS (SELECT id, time, avg(flux) AS f, avg(flux_err) AS e FROM z GROUP BY id, time),
      l AS (SELECT *, lead(time) OVER o AS t1, lead(f) OVER o AS f1, lead(e) OVER o AS e1 FROM a WINDOW o AS (PARTITION BY id ORDER BY time)),
      k AS (SELECT *, min(time) OVER (PARTITION BY id) AS t0, median(t1 - time) OVER (PARTITION BY id) AS step,
        max(t1 - time) OVER (PARTITION BY id) AS gap FROM l),
      p AS (SELECT *, unnest(range(CAST(ceil((time - t0) / step) AS BIGINT), CAST(ceil((t1 - t0) / step) AS BIGINT))) AS g
        FROM k WHERE gap > {GAP_DAYS} AND t1 IS NOT NULL),
      u AS (SELECT id, t0 + g * step AS time, f + (f1 - f) * (t0 + g * step - time) / (t1 - time) AS flux,
          e + (e1 - e) * (t0 + g * step - time) / (t1 - time) AS flux_err FROM p
        UNION ALL SELECT id, time, flux, flux_err FROM z WHERE id IN (SELECT id FROM k GROUP BY id HAVING max(gap) <= {GAP_DAYS}))
      SELECT id, {r('time', 'time', 5)}, {r('flux', 'flux', 5)}, {r('flux_err', 'flux_err', 5)} FROM u""",
}
