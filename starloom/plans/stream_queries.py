"""Streams over the given tables, drained into tables, with SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.basic import moments
from starloom.operators.series import open_series
from starloom.plans import bindings, feature_queries
from starloom.plans.bindings import table
from starloom.plans.compare import r, rounded
from starloom.session import scratch_path
from starloom.sources import documents
from starloom.streaming import stateful, streams

SLICES = 3


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("service"), "event_type",
        (F.col("value") / F.pi()).alias("value"),
    )


def _arriving(spark: SparkSession, rows: DataFrame, by: str, run: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run a stream after each arrival of files; the result after the last."""
    path, found = scratch_path(spark), None
    for _ in streams.arrivals(rows, path, by, SLICES):
        found = run(streams.file_stream(spark, path, rows.schema))
    return found


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = scratch_path(spark), scratch_path(spark)
    found = _arriving(
        spark, _samples(spark, sf_dir), "ts",
        lambda s: streams.drain(streams.window_stream(s, "1 day", ["event_type"], "value", "1 day"), out, checkpoint),
    )
    return rounded(found.select("event_type", F.unix_micros("window_start").alias("start_us"), "n", "mean_value", "max_value"), 6)


def _repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _samples(spark, sf_dir).select("event_id", "ts")
    out, checkpoint = scratch_path(spark), scratch_path(spark)
    return _arriving(
        spark, rows.unionByName(rows), "ts",
        lambda s: streams.drain(streams.without_repeats(s, "event_id", "1 day"), out, checkpoint),
    ).select("event_id")


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as JSON, parsed on the stream and sent on by confidence."""
    rows = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("detection_id"), F.col("event_type").alias("threat_type"),
        (F.col("value") / 500).alias("confidence"),
    )
    messages = documents.to_messages(rows, "detection_id")
    path = scratch_path(spark)
    messages.write.parquet(path)
    source = streams.file_stream(spark, path, messages.schema)
    parsed = documents.parse_messages(source, "threat_detections").select("detection_id", "threat_type", "confidence")
    out = scratch_path(spark)
    streams.route(
        parsed, {"risk_assessments": "confidence >= 0.1", "control_commands": "confidence >= 0.5"}, out, scratch_path(spark)
    )
    found = [
        spark.read.parquet(f"{out}/{topic}").drop("epoch").withColumn("topic", F.lit(topic))
        for topic in ("risk_assessments", "control_commands")
    ]
    return rounded(found[0].unionByName(found[1]), 6)


def _topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of three topics, every tenth one cut off, parsed on a stream: a value of each, and whether it is broken."""
    rows = _samples(spark, sf_dir)
    made = {
        "light_curves": (rows.groupBy(F.col("service").cast("string").alias("id")).agg(
            F.array_sort(F.collect_list(F.struct(F.unix_seconds("ts").cast("double").alias("t"), "event_id", "value"))).alias("p")
        ).select("id", F.transform("p", lambda p: p["t"]).alias("time"), F.transform("p", lambda p: p["value"]).alias("flux")), "id", F.element_at("flux", -1)),
        "debris_tracks": (rows.select(
            F.col("event_id").cast("string").alias("object_id"), F.array("value", -F.col("value"), F.lit(1.0)).alias("position_eci")
        ), "object_id", F.col("position_eci")[1]),
        "risk_assessments": (rows.select(
            F.col("event_id").cast("string").alias("detection_id"), (F.col("value") / 500).alias("risk"), F.col("event_type").alias("source")
        ), "detection_id", F.col("risk")),
    }
    found = None
    for topic, (table_, key, number) in made.items():
        messages = documents.to_messages(table_, key)
        cut = F.when(F.col("key").cast("long") % 10 == 0, F.substring("value", 1, 12)).otherwise(F.col("value"))
        path = scratch_path(spark)
        messages.withColumn("value", cut).write.parquet(path)
        parsed = documents.parse_messages(streams.file_stream(spark, path, messages.schema), topic, broken="broken")
        out = streams.drain(
            parsed.select(F.lit(topic).alias("topic"), "key", number.alias("number"), F.col("broken").isNotNull().alias("broken")), scratch_path(spark), scratch_path(spark)
        )
        found = out if found is None else found.unionByName(out)
    return rounded(found, 6)


def _running(spark: SparkSession, sf_dir: str) -> DataFrame:
    checkpoint = scratch_path(spark)
    found = _arriving(spark, _samples(spark, sf_dir), "ts", lambda s: streams.running_stats(s, ["service"], "value", checkpoint))
    return rounded(found, 6)


def _held(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = scratch_path(spark), scratch_path(spark)
    found = _arriving(
        spark, _samples(spark, sf_dir), "ts", lambda s: streams.held_alerts(s, "value > 10", 3600.0, out, checkpoint)
    )
    return found.select("service", F.unix_micros("started").alias("started_us"))


def _held_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times cut to the day: many rows of a service share one, and arrivals end within a day. Services are strings."""
    days = _samples(spark, sf_dir).withColumns(
        {"ts": F.date_trunc("day", "ts"), "service": F.col("service").cast("string")}
    )
    rows = days.withColumn("arrival", F.unix_date(F.to_date("ts")).cast("long") * 100_000_000_000 + F.col("event_id"))
    out, checkpoint = scratch_path(spark), scratch_path(spark)
    found = _arriving(spark, rows, "arrival", lambda s: streams.held_alerts(s, "value > 10", 86400.0, out, checkpoint))
    return found.select("service", F.unix_micros("started").alias("started_us"))


def _stateful(spark: SparkSession, sf_dir: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    out, checkpoint = scratch_path(spark), scratch_path(spark)
    with stateful.state_store(spark):
        return _arriving(spark, _samples(spark, sf_dir), "ts", lambda s: streams.drain(build(s), out, checkpoint))


def _absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _stateful(spark, sf_dir, lambda s: stateful.absent_services(s, 86400.0, "1 hour"))
    return found.select("service", F.unix_micros("last").alias("last_us"))


def _rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _stateful(spark, sf_dir, lambda s: stateful.sliding_rate(s, "value", "5 days", "1 day", 432000.0, "1 day"))
    return rounded(found.select("service", F.unix_micros("window_start").alias("start_us"), "rate"), 9)


def _percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _stateful(spark, sf_dir, lambda s: stateful.window_percentiles(s, "1 day", ["event_type"], "value", "1 day", k=4000))
    return rounded(found.select("event_type", F.unix_micros("window_start").alias("start_us"), "n", "p50", "p95", "p99"), 6)


def _ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Limits are samples of one kind, usages those of the others within an hour behind them."""

    def build(s: DataFrame) -> DataFrame:
        limit = s.filter("event_type = 'purchase'").select("service", "ts", F.col("value").alias("limit"))
        usage = s.filter("event_type <> 'purchase'").select("service", "ts", "event_id", F.col("value").alias("usage"))
        return stateful.ratio_alerts(usage, limit, ["service"], 0.9, "12 hours", "1 hour").select("service", "event_id", F.unix_micros("limit_ts").alias("limit_us"), "ratio")

    return rounded(_stateful(spark, sf_dir, build), 6)


def _incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = scratch_path(spark), scratch_path(spark)
    found = _arriving(
        spark, feature_queries.scaled_events(spark, sf_dir), "id",
        lambda s: streams.new_files_to_features(
            s, lambda batch: moments(open_series(batch, ["id"], bindings.S1_ORDER)), out, checkpoint
        ),
    )
    return rounded(found, 4)


QUERIES = {
    "stream_windows": _windows,
    "stream_without_repeats": _repeats,
    "stream_routing": _routed,
    "stream_topics": _topics,
    "stream_running_stats": _running,
    "stream_held_alerts": _held,
    "stream_held_alerts_ties": _held_ties,
    "stream_absent_service": _absent,
    "stream_sliding_rate": _rates,
    "stream_window_percentiles": _percentiles,
    "stream_ratio_alerts": _ratios,
    "stream_new_files_to_features": _incremental,
}

ORACLES = {
    "stream_windows": f"""SELECT event_type, epoch_us(date_trunc('day', ts)) AS start_us, count(*) AS n,
      {r('avg(value / pi())', 'mean_value')}, {r('max(value / pi())', 'max_value')} FROM events
      WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)
      GROUP BY event_type, date_trunc('day', ts)""",
    "stream_without_repeats": "SELECT event_id FROM events",
    "stream_routing": " UNION ALL ".join(
        f"""SELECT CAST(event_id AS VARCHAR) AS detection_id, event_type AS threat_type, {r('value / 500', 'confidence')},
        '{topic}' AS topic FROM events WHERE value / 500 >= {limit}"""
        for topic, limit in (("risk_assessments", 0.1), ("control_commands", 0.5))
    ),
    "stream_topics": f"""WITH m AS (
        SELECT 'light_curves' AS topic, user_id AS key, last(value / pi() ORDER BY ts, event_id) AS number FROM events GROUP BY user_id
        UNION ALL SELECT 'debris_tracks', event_id, -value / pi() FROM events UNION ALL SELECT 'risk_assessments', event_id, value / pi() / 500 FROM events)
      SELECT topic, CAST(key AS VARCHAR) AS key, {r('CASE WHEN key % 10 <> 0 THEN number END', 'number')}, key % 10 = 0 AS broken FROM m""",
    "stream_running_stats": f"""SELECT user_id AS service, count(*) AS n, {r('sum(value / pi())', 'total')},
      {r('min(value / pi())', 'low')}, {r('max(value / pi())', 'high')} FROM events GROUP BY user_id""",
    "stream_held_alerts": """WITH a AS (SELECT user_id, ts, value / pi() > 10 AS hit,
        sum(CASE WHEN value / pi() > 10 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM events),
      b AS (SELECT user_id AS service, epoch_us(min(ts)) AS started_us, epoch_us(max(ts)) AS ended_us FROM a WHERE hit GROUP BY user_id, g)
      SELECT service, started_us FROM b WHERE ended_us - started_us >= 3600 * 1000000::BIGINT""",
    "stream_held_alerts_ties": """WITH s AS (SELECT CAST(user_id AS VARCHAR) AS service, date_trunc('day', ts) AS ts, event_id, value / pi() > 10 AS hit FROM events),
      a AS (SELECT *, sum(CASE WHEN hit THEN 0 ELSE 1 END) OVER (PARTITION BY service ORDER BY ts, event_id) AS g FROM s),
      b AS (SELECT service, epoch_us(min(ts)) AS started_us, epoch_us(max(ts)) AS ended_us FROM a WHERE hit GROUP BY service, g)
      SELECT service, started_us FROM b WHERE ended_us - started_us >= 86400 * 1000000::BIGINT""",
    "stream_absent_service": """WITH a AS (SELECT user_id AS service, epoch_us(ts) AS last_us,
        lead(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_us, (SELECT max(epoch_us(ts)) - 3600000000 FROM events) AS now_us FROM events)
      SELECT service, last_us FROM a WHERE coalesce(next_us, now_us) - last_us >= 86400000000""",
    "stream_sliding_rate": f"""WITH a AS (SELECT user_id AS service, ts, value / pi() AS v, lag(value / pi()) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events),
      i AS (SELECT service, ts, CASE WHEN p IS NULL THEN NULL WHEN v >= p THEN v - p ELSE v END AS inc FROM a),
      w AS (SELECT service, inc, unnest([epoch_us(date_trunc('day', ts)) - k * 86400000000 for k in range(5)]) AS start_us FROM i)
      SELECT service, start_us, {r('coalesce(sum(inc), 0.0) / 432000.0', 'rate', 9)} FROM w
      WHERE start_us + 5 * 86400000000 <= (SELECT max(epoch_us(ts)) - 86400000000 FROM events) GROUP BY service, start_us""",
    "stream_window_percentiles": f"""SELECT event_type, epoch_us(date_trunc('day', ts)) AS start_us, count(*) AS n,
      {', '.join(r(f'quantile_disc(value / pi(), {q})', n) for n, q in (('p50', 0.5), ('p95', 0.95), ('p99', 0.99)))} FROM events
      WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events) GROUP BY event_type, date_trunc('day', ts)""",
    "stream_ratio_alerts": f"""SELECT u.user_id AS service, u.event_id, epoch_us(l.ts) AS limit_us, {r('u.value / l.value', 'ratio')} FROM events u JOIN events l
      ON u.user_id = l.user_id AND u.event_type <> 'purchase' AND l.event_type = 'purchase' AND u.ts >= l.ts AND u.ts < l.ts + INTERVAL 12 HOUR
      WHERE u.value / l.value > 0.9""",
    "stream_new_files_to_features": feature_queries.ORACLES["feature_moments"],
}
