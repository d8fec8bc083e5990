"""Light curve files to the canonical rows ``(id, time, flux, flux_err)`` and back."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.operators.catalog import file_stem
from starloom.operators.series import RANGE_ROWS
from starloom.operators.series import _ranges as task_count
from starloom.session import materialise

#: Buckets of a folder with a file per series.
FILE_BUCKETS = 10_000
# Flux columns by preference, each with its error column.
FLUX_COLUMNS = (("PDCSAP_FLUX", "PDCSAP_FLUX_ERR"), ("SAP_FLUX", "SAP_FLUX_ERR"), ("flux", "flux_err"))


def list_files(spark: SparkSession, path: str, pattern: str = "*", recursive: bool = False, max_files: int | None = None) -> DataFrame:
    """``(path, name, length)`` of matching files, the first ``max_files`` by path.

    Contents are not read.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(path)
        .select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length")
    )
    return files.orderBy("path").limit(max_files) if max_files else files


def resolve_flux(df: DataFrame) -> DataFrame:
    """Pick the flux column of a source by presence; a missing error counts as 1."""
    upper = {c.upper(): c for c in df.columns}
    if "TIME" not in upper:
        raise ValueError("source has no TIME column")
    for flux, error in FLUX_COLUMNS:
        if flux.upper() in upper:
            err = F.col(upper[error.upper()]) if error.upper() in upper else F.lit(1.0)
            rest = [c for c in df.columns if c == "id"]
            return df.select(
                *rest,
                F.col(upper["TIME"]).cast("double").alias("time"),
                F.col(upper[flux.upper()]).cast("double").alias("flux"),
                err.cast("double").alias("flux_err"),
            )
    raise ValueError("source has none of the flux columns")


def read_series(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    pattern: str | None = None,
    recursive: bool = False,
    max_files: int | None = None,
    schema: str | None = None,
) -> DataFrame:
    """One series per file, its id the stem of the file's name.

    Files of the same stem would merge into one series, so they are an error.
    """
    pattern = pattern or f"*.{fmt}"
    listed = list_files(spark, path, pattern, recursive, max_files)
    stems = listed.groupBy(file_stem(F.col("name")).alias("id")).count()
    repeated = stems.filter("count > 1").limit(5).collect()
    if repeated:
        raise ValueError(f"several files share a name: {[row['id'] for row in repeated]}")
    reader = spark.read.format(fmt).option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower())
    if fmt == "csv":
        reader = reader.option("header", "true")
        reader = reader.option("inferSchema", "true") if schema is None else reader
    rows = (reader.schema(schema) if schema else reader).load(path)
    rows = rows.withColumn("_name", F.col("_metadata.file_name"))
    if max_files:
        rows = rows.join(F.broadcast(listed.select(F.col("name").alias("_name"))), "_name", "left_semi")
    return resolve_flux(rows.withColumn("id", file_stem(F.col("_name"))))


def in_order(df: DataFrame) -> Column:
    """Order of rows within and across the files of a scan."""
    return F.struct(
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    )


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """``id, label`` rows of a CSV with ``_order``, so that the last of an id can win."""
    rows = spark.read.schema("id string, label int").option("header", "true").csv(path)
    return rows.select("id", "label", in_order(rows).alias("_order"))


def write_series(rows: DataFrame, path: str, buckets: int = 64, rows_per_task: int = 5_000_000) -> None:
    """Series rows by bucket of the id; a bucket is written by as many tasks as its share of the rows needs.

    Small ``rows_per_task`` make no more tasks than the rows of a large table can fill.
    """
    spread = max(1, -(-task_count(rows.count(), rows_per_task) // buckets))
    placed = rows.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int"))
    tasks = placed.repartition(buckets * spread, F.col("bucket"), F.pmod(F.xxhash64("time"), F.lit(spread)))
    tasks.sortWithinPartitions("bucket", "id", "time").write.partitionBy("bucket").parquet(path)


def write_files(rows: DataFrame, path: str, key: str = "id", buckets: int = FILE_BUCKETS) -> None:
    """A file per key in one folder.

    A task writes a file for each bucket that it has rows of, so it can write
    many keys if no two of them share a bucket: those that do are numbered and
    go to different tasks. Tasks follow the rows, not the keys.
    """
    spark = rows.sparkSession
    bucket = F.pmod(F.hash(key), F.lit(buckets))  # what bucketBy takes
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    numbered = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    keys = materialise(sizes.withColumn("_bucket", bucket).withColumn("_turn", numbered))
    deepest, size = keys.agg(F.max("_turn"), F.sum("_n")).first()
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), deepest or 1, -(-(size or 0) // RANGE_ROWS))
    task = F.pmod(F.col("_bucket") + F.col("_turn"), F.lit(tasks)).alias("_task")
    placed = rows.join(keys.select(key, task), key).repartitionById(tasks, "_task").drop("_task")
    name = f"starloom_{uuid.uuid4().hex}"
    placed.write.bucketBy(buckets, key).option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Quality metrics, one row per id, columns prefixed ``metrics_``."""
    metrics.select("id", *[F.col(c).alias(f"metrics_{c}") for c in metrics.columns if c != "id"]).write.parquet(path)
