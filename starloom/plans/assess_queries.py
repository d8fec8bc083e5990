"""Queries for risk, evaluation, monitoring and period search, with SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import assess, monitor
from starloom.operators.series import Series, open_series
from starloom.operators.spectrum import fast_periodogram
from starloom.plans import bindings
from starloom.plans.bindings import table
from starloom.plans.compare import r, rounded

PERIODS = [0.5 + 0.25 * i for i in range(30)]
FREQUENCIES = [0.05 * i for i in range(1, 41)]
TOP_VALUE = 500.0


def threats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as threat messages; the value, scaled, stands for the risk."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("detection_id"), F.col("user_id").alias("object_id"), F.col("event_type").alias("source"),
        (F.col("value") / TOP_VALUE).alias("risk"), F.col("ts").cast("timestamp").alias("ts"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as scored examples: a squashed coordinate against the class."""
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding")[0].cast("double").alias("v"), (F.col("label") > 4).cast("int").alias("label")
    )
    return rows.withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("v") * 10)))


def samples(spark: SparkSession, sf_dir: str) -> Series:
    """Events as metric samples of one service per user."""
    rows = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("service"), F.col("ts").cast("timestamp").alias("ts"), "event_id", "value"
    )
    return open_series(rows, ["service"], ["ts", "event_id"])


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first six coordinates of an embedding as position and velocity."""
    names = ["x", "y", "z", "vx", "vy", "vz"]
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)]
    )


def _confident(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(assess.confident(threats(spark, sf_dir), "source", "risk", {"click": 0.2, "view": 0.3}, 0.1).select(
        "detection_id", "source", "risk"), 6)


def _categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = threats(spark, sf_dir).select(assess.risk_category(F.col("risk"), (0.01, 0.05, 0.2, 0.5)).alias("category"))
    return rows.groupBy("category").agg(F.count(F.lit(1)).alias("n"))


def _fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_source = threats(spark, sf_dir).groupBy("object_id", "source").agg(F.max("risk").alias("risk"), F.count(F.lit(1)).alias("weight"))
    return rounded(assess.fused_risk(per_source, ["object_id"]), 6)


def _top(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = assess.top_per_group(threats(spark, sf_dir), ["object_id"], [F.col("risk").desc(), F.col("detection_id")], 5)
    return rounded(found.select("object_id", "detection_id", "risk", "rank"), 6)


def _priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = threats(spark, sf_dir).select("detection_id", (-F.col("risk")).alias("neg"), "ts")
    return assess.ranked_threats(rows, ["neg", "ts", "detection_id"]).select("detection_id", "priority")


def _transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id", "event_type")
    s = open_series(rows, ["user_id"], ["ts", "event_id"]).located(1)
    return rounded(assess.transitions(s, "event_type"), 6)


def _residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.transform(F.slice("embedding", 1, 3), lambda v: v.cast("double")).alias("observed"),
        F.transform(F.slice("embedding", 4, 3), lambda v: v.cast("double")).alias("predicted"),
    )
    found = assess.residual_faults(rows, "observed", "predicted", 0.2)
    return rounded(found.select("vec_id", "residual", "fault", assess.dot("observed", "predicted").alias("product")), 6)


def _held(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = samples(spark, sf_dir).located()
    found = monitor.held(s, monitor.breaches(F.col("value"), ">", 30.0), 3600.0)
    return found.select(
        "service", F.unix_micros("started").alias("started_us"), F.unix_micros("ended").alias("ended_us"), "n_samples"
    )


def _rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = monitor.windowed_rate(samples(spark, sf_dir).located(1), "value", "5 days", "1 day", 432000.0)
    return rounded(found.select("service", F.unix_micros("window_start").alias("start_us"), "rate"), 9)


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), "event_type", (F.col("value") / F.pi()).alias("value")
    )
    found = monitor.window_aggregates(rows, "1 day", ["event_type"], "value")
    return rounded(found.select(
        "event_type", F.unix_micros("window_start").alias("start_us"), "n", "mean_value", "max_value"), 6)


def _ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    usage = rows.select("event_id", F.col("user_id").alias("pod"), F.col("value").alias("usage"))
    limit = rows.groupBy(F.col("user_id").alias("pod")).agg(F.max("value").alias("limit"))
    return rounded(monitor.ratio_breaches(usage, limit, ["pod"], 0.7).select("event_id", "pod", "ratio"), 6)


def _latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_type", (F.col("value") / F.pi()).alias("value"), "user_id")
    return rounded(assess.latency_report(rows, "value", F.col("value") > 30, ["event_type"]), 6)


def _periodogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = open_series(bindings.event_series(spark, sf_dir).filter("flux > 0"), ["id"], bindings.S1_ORDER)
    return rounded(assess.periodogram(s, FREQUENCIES), 6)


def _peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = open_series(bindings.event_series(spark, sf_dir).filter("flux > 0"), ["id"], bindings.S1_ORDER)
    return rounded(assess.periodogram_peaks(assess.periodogram(s, FREQUENCIES), ["id"], 3), 6)


def _fast(block_rows: int | None = None):
    """The three strongest of 5,000 frequencies, from one transform per series."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        s = open_series(bindings.event_series(spark, sf_dir).filter("flux > 0"), ["id"], bindings.S1_ORDER, block_rows)
        return rounded(assess.periodogram_peaks(fast_periodogram(s, 0.01, 5000, strongest=3), ["id"], 3), 4)

    return query


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = open_series(bindings.event_series(spark, sf_dir).filter("flux > 0"), ["id"], bindings.S1_ORDER)
    return rounded(assess.box_search(s, PERIODS, bins=20), 6)


def _approach(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = states(spark, sf_dir)
    found = assess.closest_approach(both, both, 0.1, 0.3, 200)
    return rounded(found, 6, many=True)


THREATS = "(SELECT event_id AS detection_id, user_id AS object_id, event_type AS source, value / 500.0 AS risk, ts FROM events)"
SCORED = "(SELECT vec_id AS id, CAST(label > 4 AS INTEGER) AS label, 1 / (1 + exp(-CAST(embedding[1] AS DOUBLE) * 10)) AS score FROM embeddings)"
DIGEST = "('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':42'), 1, 8))::BIGINT / 4294967296.0"
STATE = ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS {n}" for i, n in enumerate(["x", "y", "z", "vx", "vy", "vz"]))

GLS = f"""s AS (SELECT id, time - min(time) OVER (PARTITION BY id) AS t, flux - avg(flux) OVER (PARTITION BY id) AS y
    FROM ({bindings.S1_SQL}) WHERE flux > 0),
  w AS (SELECT id, f, y, cos(t * f * 2 * pi()) AS c, sin(t * f * 2 * pi()) AS s FROM s,
    (SELECT unnest([{', '.join(repr(f) for f in FREQUENCIES)}]::DOUBLE[]) AS f)),
  m AS (SELECT id, f, var_pop(y) AS yy, covar_pop(y, c) AS yc, covar_pop(y, s) AS ys, var_pop(c) AS cc, var_pop(s) AS ss,
    covar_pop(c, s) AS cs FROM w GROUP BY id, f),
  p AS (SELECT id, f AS frequency, (ss * yc * yc + cc * ys * ys - 2 * cs * yc * ys) / (yy * (cc * ss - cs * cs)) AS power FROM m)"""

QUERIES = {
    "confidence_threshold": _confident,
    "risk_categories": _categories,
    "fused_risk": _fused,
    "top_threats": _top,
    "threat_priority": _priority,
    "state_transitions": _transitions,
    "residual_faults": _residuals,
    "classification_report": lambda spark, sf_dir: rounded(
        assess.classification_report(scored(spark, sf_dir).withColumn("p", F.col("score") > 0.5), "p", "label"), 6),
    "auroc": lambda spark, sf_dir: rounded(assess.auroc(scored(spark, sf_dir), "score", "label"), 6),
    "calibration_error": lambda spark, sf_dir: rounded(assess.calibration_error(scored(spark, sf_dir), "score", "label"), 6),
    "train_split": lambda spark, sf_dir: assess.split(table(spark, sf_dir, "documents").select("doc_id"), "doc_id"),
    "latency_report": _latency,
    "held_alerts": _held,
    "sliding_rate": _rates,
    "window_aggregates": _windows,
    "ratio_alerts": _ratios,
    "periodogram": _periodogram,
    "periodogram_peaks": _peaks,
    "periodogram_fast": _fast(),
    "periodogram_fast_split": _fast(64),
    "box_search": _boxes,
    "closest_approach": _approach,
}

ORACLES = {
    "confidence_threshold": f"""SELECT detection_id, source, {r('risk', 'risk')} FROM {THREATS}
      WHERE risk >= CASE source WHEN 'click' THEN 0.2 WHEN 'view' THEN 0.3 ELSE 0.1 END""",
    "risk_categories": f"""SELECT CASE WHEN risk < 0.01 THEN 'negligible' WHEN risk < 0.05 THEN 'low' WHEN risk < 0.2 THEN 'medium'
      WHEN risk < 0.5 THEN 'high' ELSE 'critical' END AS category, count(*) AS n FROM {THREATS} GROUP BY 1""",
    "fused_risk": f"""WITH p AS (SELECT object_id, source, max(risk) AS risk, count(*) AS w FROM {THREATS} GROUP BY object_id, source)
      SELECT object_id, {r('sum(w * risk) / sum(w)', 'risk')}, count(*) AS n_sources FROM p GROUP BY object_id""",
    "top_threats": f"""SELECT object_id, detection_id, {r('risk', 'risk')}, CAST(k AS INTEGER) AS rank FROM (SELECT *, row_number() OVER
      (PARTITION BY object_id ORDER BY risk DESC, detection_id) AS k FROM {THREATS}) WHERE k <= 5""",
    "threat_priority": f"SELECT detection_id, row_number() OVER (ORDER BY risk DESC, ts, detection_id) AS priority FROM {THREATS}",
    "state_transitions": f"""WITH t AS (SELECT event_type AS from_state, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS to_state FROM events),
      c AS (SELECT from_state, to_state, count(*) AS n FROM t WHERE to_state IS NOT NULL GROUP BY 1, 2)
      SELECT from_state, to_state, n, {r('n / sum(n) OVER (PARTITION BY from_state)', 'probability')} FROM c""",
    "residual_faults": f"""WITH v AS (SELECT vec_id, embedding[1:3]::DOUBLE[] AS a, embedding[4:6]::DOUBLE[] AS b FROM embeddings),
      d AS (SELECT vec_id, sqrt((a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2 + (a[3] - b[3]) ** 2) AS q,
        a[1] * b[1] + a[2] * b[2] + a[3] * b[3] AS p FROM v)
      SELECT vec_id, {r('q', 'residual')}, q > 0.2 AS fault, {r('p', 'product')} FROM d""",
    "classification_report": f"""WITH c AS (SELECT count(*) FILTER (WHERE score > 0.5 AND label = 1) AS tp, count(*) FILTER (WHERE score > 0.5 AND label = 0) AS fp,
        count(*) FILTER (WHERE score <= 0.5 AND label = 1) AS fn, count(*) FILTER (WHERE score <= 0.5 AND label = 0) AS tn FROM {SCORED})
      SELECT *, {r('tp / (tp + fp)', 'precision')}, {r('tp / (tp + fn)', 'recall')}, {r('2 * tp / (2 * tp + fp + fn)', 'f1')},
        {r('fp / (fp + tn)', 'false_positive_rate')} FROM c""",
    "auroc": f"""WITH k AS (SELECT *, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS rk FROM {SCORED})
      SELECT {r('(sum(rk * label) - sum(label) * (sum(label) + 1) / 2) / (sum(label) * sum(1 - label))', 'auroc')} FROM k""",
    "calibration_error": f"""WITH b AS (SELECT least(floor(score * 10), 9) AS bin, count(*) AS n, avg(score) AS p, avg(label) AS y FROM {SCORED} GROUP BY 1)
      SELECT {r('sum(n * abs(p - y)) / sum(n)', 'ece')} FROM b""",
    "train_split": f"""SELECT doc_id, CASE WHEN {DIGEST} < 0.8 THEN 'train' WHEN {DIGEST} < 0.8 + 0.1 THEN 'validation' ELSE 'test' END AS split FROM documents""",
    "latency_report": f"""SELECT event_type, count(*) AS n, {', '.join(r(f'quantile_cont(value / pi(), {q})', n) for n, q in (('p50', 0.5), ('p95', 0.95), ('p99', 0.99)))},
      {r('count(*) FILTER (WHERE value / pi() > 30) / count(*)', 'error_rate')} FROM events GROUP BY event_type""",
    "held_alerts": """WITH a AS (SELECT user_id, ts, event_id, value > 30.0 AS hit,
        sum(CASE WHEN value > 30.0 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM events),
      b AS (SELECT user_id AS service, g, epoch_us(min(ts)) AS started_us, epoch_us(max(ts)) AS ended_us, count(*) AS n_samples FROM a WHERE hit GROUP BY user_id, g)
      SELECT service, started_us, ended_us, n_samples FROM b WHERE ended_us - started_us >= 3600 * 1000000::BIGINT""",
    "sliding_rate": f"""WITH a AS (SELECT user_id AS service, ts, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events),
      i AS (SELECT service, ts, CASE WHEN p IS NULL THEN NULL WHEN value >= p THEN value - p ELSE value END AS inc FROM a),
      w AS (SELECT service, inc, unnest([epoch_us(date_trunc('day', ts)) - k * 86400000000 for k in range(5)]) AS start_us FROM i)
      SELECT service, start_us, {r('coalesce(sum(inc), 0.0) / 432000.0', 'rate', 9)} FROM w GROUP BY service, start_us""",
    "window_aggregates": f"""SELECT event_type, epoch_us(date_trunc('day', ts)) AS start_us, count(*) AS n,
      {r('avg(value / pi())', 'mean_value')}, {r('max(value / pi())', 'max_value')} FROM events GROUP BY event_type, date_trunc('day', ts)""",
    "ratio_alerts": f"""WITH u AS (SELECT event_id, user_id AS pod, value / max(value) OVER (PARTITION BY user_id) AS q FROM events)
      SELECT event_id, pod, {r('q', 'ratio')} FROM u WHERE q > 0.7""",
    "periodogram": f"WITH {GLS} SELECT id, {r('frequency', 'frequency')}, {r('power', 'power')} FROM p",
    "periodogram_peaks": f"""WITH {GLS} SELECT id, {r('frequency', 'frequency')}, {r('power', 'power')}, CAST(k AS INTEGER) AS rank
      FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY power DESC, frequency) AS k FROM p) WHERE k <= 3""",
    "periodogram_fast": f"""WITH s AS (SELECT id, time - min(time) OVER (PARTITION BY id) AS t, flux - avg(flux) OVER (PARTITION BY id) AS y
        FROM ({bindings.S1_SQL}) WHERE flux > 0),
      w AS (SELECT id, k, y, cos(a) AS c, sin(a) AS s FROM (SELECT id, k, y, t * (k * 0.01) * 2 * pi() AS a FROM s, range(1, 5001) AS g(k))),
      m AS (SELECT id, k, var_pop(y) AS yy, covar_pop(y, c) AS yc, covar_pop(y, s) AS ys, var_pop(c) AS cc, var_pop(s) AS ss, covar_pop(c, s) AS cs FROM w GROUP BY id, k),
      p AS (SELECT id, k * 0.01 AS frequency, (ss * yc * yc + cc * ys * ys - 2 * cs * yc * ys) / (yy * (cc * ss - cs * cs)) AS power FROM m)
      SELECT id, {r('frequency', 'frequency', 4)}, {r('power', 'power', 4)}, CAST(k AS INTEGER) AS rank
      FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY power DESC, frequency) AS k FROM p) WHERE k <= 3""",
    "box_search": f"""WITH s AS (SELECT id, min(time) OVER w AS t0, time - min(time) OVER w AS t, flux - avg(flux) OVER w AS y,
        count(*) OVER w AS n FROM ({bindings.S1_SQL}) WHERE flux > 0 WINDOW w AS (PARTITION BY id)),
      f AS (SELECT id, t0, n, y, period, least(floor((t / period - floor(t / period)) * 20), 19)::INTEGER AS bin
        FROM s, (SELECT unnest([{', '.join(repr(p) for p in PERIODS)}]::DOUBLE[]) AS period)),
      c AS (SELECT id, period, bin, sum(y) AS sy, count(*) AS c, max(t0) AS t0, max(n) AS n FROM f GROUP BY id, period, bin),
      b AS (SELECT id, period, w, (bin - o + 20) % 20 AS start, sum(sy) AS sy, CAST(sum(c) AS DOUBLE) AS c, max(t0) AS t0, max(n) AS n
        FROM c, (VALUES (1), (2), (3), (5)) AS v(w), (SELECT unnest(range(5))::INTEGER AS o) WHERE o < w GROUP BY id, period, w, start),
      q AS (SELECT *, (sy / n) ** 2 / nullif(c / n * (1 - c / n), 0) AS score FROM b WHERE sy < 0),
      k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(score, 9) DESC, period, w, start) AS k FROM q WHERE score IS NOT NULL)
      SELECT id, {r('period', 'period')}, {r('-sy / (n - c) - sy / c', 'depth')}, {r('period * w / 20', 'duration')},
        {r('t0 + period * start / 20 + period * w / 40', 'epoch')}, {r('score', 'score')} FROM k WHERE k = 1""",
    "closest_approach": f"""WITH o AS (SELECT vec_id AS id, {STATE} FROM embeddings),
      p AS (SELECT a.id AS object_id, b.id AS catalog_id, b.x - a.x AS x, b.y - a.y AS y, b.z - a.z AS z,
        b.vx - a.vx AS vx, b.vy - a.vy AS vy, b.vz - a.vz AS vz FROM o a JOIN o b ON a.id <> b.id),
      t AS (SELECT *, least(greatest(coalesce(-(x * vx + y * vy + z * vz) / nullif(vx * vx + vy * vy + vz * vz, 0), 0), 0), 0.3) AS t FROM p),
      m AS (SELECT *, sqrt((x + vx * t) ** 2 + (y + vy * t) ** 2 + (z + vz * t) ** 2) AS miss FROM t)
      SELECT object_id, catalog_id, {r('t', 'time_to_closest_approach')}, {r('miss', 'miss_distance')} FROM m WHERE miss <= 0.1""",
}
ORACLES["periodogram_fast_split"] = ORACLES["periodogram_fast"]
