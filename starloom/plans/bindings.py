"""The given tables seen as series, labels and feature matrices.

``S1`` reads ``events`` as one series per user, ``S2`` reads ``lineitem`` as
one series per supplier. Times are days as doubles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

S1_ORDER = ["time", "event_id"]
S2_ORDER = ["time", "order_key", "line_number"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its times have no zone and are read as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"),
        (F.expr("unix_micros(cast(ts as timestamp))") / F.lit(86400000000.0)).alias("time"),
        F.col("value").alias("flux"),
        F.lit(1.0).alias("flux_err"),
        "event_id",
    )


def lineitem_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("id"),
        F.datediff("l_shipdate", F.lit("1992-01-01").cast("date")).cast("double").alias("time"),
        F.col("l_extendedprice").alias("flux"),
        (F.col("l_tax") + 0.001).alias("flux_err"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
    )


S1_SQL = """
  SELECT user_id AS id, epoch_us(ts) / 86400000000.0 AS time, value AS flux, 1.0 AS flux_err, event_id
  FROM events
"""

S2_SQL = """
  SELECT l_suppkey AS id, CAST(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS DOUBLE) AS time,
         l_extendedprice AS flux, l_tax + 0.001 AS flux_err, l_orderkey AS order_key, l_linenumber AS line_number
  FROM lineitem
"""
