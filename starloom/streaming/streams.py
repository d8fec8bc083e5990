"""Streams of messages, samples and files.

Event time is UTC. Rows later than ``delay`` are dropped. Windows come out in
append mode once the watermark has passed their end; running values stay in the
state store and are read from it. Checkpoint folders are always given by the caller.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starloom.operators import monitor
from starloom.session import materialise, scratch
from starloom.streaming import stateful


def topic_stream(spark: SparkSession, servers: str, topic: str, starting: str = "earliest") -> DataFrame:
    """Messages of a Kafka topic as ``key, value``; needs the Kafka package on the cluster."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    rows = reader.option("subscribe", topic).option("startingOffsets", starting).load()
    return rows.select(F.col("key").cast("string"), F.col("value").cast("string"), "timestamp")


def to_topic(df: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Write ``key, value`` rows to a Kafka topic."""
    writer = df.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
    return writer.option("checkpointLocation", checkpoint).start()


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", pattern: str | None = None, files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.load(path)


def window_stream(df: DataFrame, size: str, by: list[str], value: str, delay: str) -> DataFrame:
    """Closed tumbling windows of a stream with a ``ts`` column."""
    return monitor.window_aggregates(df.withWatermark("ts", delay), size, by, value)


def without_repeats(df: DataFrame, key: str, delay: str) -> DataFrame:
    return df.withWatermark("ts", delay).dropDuplicatesWithinWatermark([key])


def drain(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Run a stream over all that is there now into a table, and read the table."""
    query = (
        df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
        .option("path", path).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def each_batch(df: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Run ``work`` on every micro-batch that is there now."""
    query = (
        df.writeStream.foreachBatch(work).outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def route(df: DataFrame, routes: dict[str, str], path: str, checkpoint: str) -> None:
    """Send rows to one table per topic, by SQL condition; a row may go to several.

    One stream reads the source once. A batch that runs again replaces its
    own output.
    """

    def send(batch: DataFrame, epoch: int) -> None:
        with scratch(batch.sparkSession):  # the batch's rows go once they are sent
            kept = materialise(batch)
            for topic, condition in routes.items():
                kept.filter(condition).write.mode("overwrite").parquet(f"{path}/{topic}/epoch={epoch}")

    each_batch(df, send, checkpoint)


def running_stats(df: DataFrame, by: list[str], value: str, checkpoint: str) -> DataFrame:
    """Count, sum and extremes per key, kept up to date in the state store and read from there."""
    running = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.min(value).alias("low"), F.max(value).alias("high")
    )
    query = running.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return stateful.stored_stats(df.sparkSession, checkpoint, by)


def held_alerts(df: DataFrame, condition: str, seconds: float, path: str, checkpoint: str, delay: str = "30 days") -> DataFrame:
    """Alerts for conditions that hold for some time, once per run of breaches; all alerts so far.

    Rows are ``(service, ts, event_id, value)``; see ``stateful``.
    """
    with stateful.state_store(df.sparkSession):
        return drain(stateful.held_runs(df, condition, seconds, delay), path, checkpoint)


def new_files_to_features(df: DataFrame, features: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> DataFrame:
    """Features of the series in every new batch of files, appended by batch.

    A file holds whole series. A batch that runs again replaces its own rows.
    """

    def step(batch: DataFrame, epoch: int) -> None:
        with scratch(batch.sparkSession):
            features(materialise(batch)).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    each_batch(df, step, checkpoint)
    return df.sparkSession.read.parquet(path).drop("epoch")


def arrivals(df: DataFrame, path: str, by: str, slices: int) -> Iterator[int]:
    """Add a table to a folder slice by slice in order of ``by``; yields after each.

    Lets a caller run a stream on what has arrived, as a scheduled job would.
    """
    bounds = df.select(F.percentile_approx(by, [i / slices for i in range(1, slices)], 1000).alias("b")).first()["b"]
    edges = [None, *bounds, None]
    for number, (low, high) in enumerate(zip(edges[:-1], edges[1:])):
        part = df
        if low is not None:
            part = part.filter(F.col(by) > F.lit(low))
        if high is not None:
            part = part.filter(F.col(by) <= F.lit(high))
        part.write.mode("append").parquet(path)
        yield number
