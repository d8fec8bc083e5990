"""Alert rules over metric samples, as batch plans.

Samples are ``(ts, metric, service, value)``; ``ts`` is a timestamp. A rule that
must hold for some time fires once per run of breaching samples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.joins import lookup
from starloom.operators.series import Series, open_series

# Metric, comparison, limit and holding time in seconds.
RULES = {
    "HighDetectionLatency": ("detection_latency_ms", ">", 500.0, 300),
    "LowDetectionAccuracy": ("detection_accuracy", "<", 0.90, 600),
    "DetectionServiceDown": ("up", "==", 0.0, 120),
    "ControlLatencyExceeded": ("control_latency_ms", ">", 50.0, 60),
    "LowAvoidanceSuccessRate": ("avoidance_success_rate", "<", 0.95, 300),
}
RATIO_LIMIT = 0.90


def breaches(value: Column, comparison: str, limit: float) -> Column:
    if comparison == ">":
        return value > limit
    if comparison == "<":
        return value < limit
    if comparison == "==":
        return value == limit
    raise ValueError(f"unknown comparison {comparison!r}")


def held(s: Series, breach: Column, seconds: float) -> DataFrame:
    """Runs of breaching samples that last at least ``seconds``.

    Needs ``located()`` series with a ``ts`` column. A run is numbered by the
    calm samples before it, so its samples add up in partial aggregates.
    """
    s = s.with_columns(_hit=F.coalesce(breach, F.lit(False)))
    s = s.with_running(_run=F.when(F.col("_hit"), F.lit(0)).otherwise(F.lit(1)).cast("long"))
    runs = s.where(F.col("_hit")).rows().groupBy(*s.keys, "_run").agg(
        F.min("ts").alias("started"), F.max("ts").alias("ended"), F.count(F.lit(1)).alias("n_samples")
    )
    lasted = (F.unix_micros("ended") - F.unix_micros("started")) / F.lit(1e6)
    return runs.withColumn("held_s", lasted).filter(F.col("held_s") >= seconds).drop("_run")


def rule_alerts(samples: DataFrame, order: list[str], rules: dict[str, tuple[str, str, float, int]] = RULES, block_rows: int | None = None) -> DataFrame:
    """Alerts of all rules in one pass over ``(ts, metric, service, value)``; a rule is held by its own time.

    A sample counts for the rules of its metric. A missing value is calm.
    """
    table = F.array(*[
        F.struct(F.lit(name).alias("alert"), F.lit(metric).alias("metric"), breaches(F.col("value"), sign, limit).alias("hit"), F.lit(seconds).alias("seconds"))
        for name, (metric, sign, limit, seconds) in rules.items()
    ])
    each = samples.withColumn("_rule", F.explode(F.filter(table, lambda x: x["metric"] == F.col("metric"))))
    each = each.select("*", "_rule.alert", "_rule.hit", "_rule.seconds").drop("_rule")
    s = open_series(each, ["alert", "service"], order, block_rows).located()
    runs = held(s, F.col("hit"), 0.0)
    limits = F.create_map(*[F.lit(v) for name, rule in rules.items() for v in (name, rule[3])])
    return runs.filter(F.col("held_s") >= limits[F.col("alert")])


def increases(s: Series, counter: str) -> Series:
    """Growth of a counter since the sample before; a drop is a restart from zero."""
    s = s.windowed(lambda w: {"_last": w.back(counter)})
    grown = F.when(F.col(counter) >= F.col("_last"), F.col(counter) - F.col("_last")).otherwise(F.col(counter))
    return s.with_columns(increase=F.when(F.col("_last").isNotNull(), grown)).drop("_last")


def windowed_rate(s: Series, counter: str, size: str, slide: str, seconds: float) -> DataFrame:
    """Increase per second of a counter over sliding windows; needs ``located(1)``."""
    rows = increases(s, counter).rows()
    return rows.groupBy(*s.keys, F.window("ts", size, slide).alias("w")).agg(
        (F.coalesce(F.sum("increase"), F.lit(0.0)) / seconds).alias("rate")
    ).select(*s.keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "rate")


def window_aggregates(df: DataFrame, size: str, by: list[str], value: str) -> DataFrame:
    """Count, mean and maximum per tumbling window; the same plan runs on a stream."""
    return df.groupBy(F.window("ts", size).alias("w"), *by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean_value"), F.max(value).alias("max_value")
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "n", "mean_value", "max_value")


def ratio_breaches(usage: DataFrame, limit: DataFrame, on: list[str], share: float = RATIO_LIMIT) -> DataFrame:
    """Samples whose usage over their limit exceeds ``share``; no limit, no alert."""
    joined = lookup(usage, limit, on)
    return joined.withColumn("ratio", F.try_divide(F.col("usage"), F.col("limit"))).filter(F.col("ratio") > share)
