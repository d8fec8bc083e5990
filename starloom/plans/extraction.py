"""From raw series to a labelled, selected feature matrix."""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.registry import extract, impute
from starloom.operators.assess import class_balance
from starloom.operators.cleaning import preprocess, valid_samples
from starloom.operators.joins import attach_labels, lookup, not_yet_done
from starloom.operators.selection import select_and_save
from starloom.operators.series import open_series
from starloom.session import materialise, scratch
from starloom.sources.matrix import write_matrix
from starloom.sources.series import read_labels, read_series


def features_of(
    rows: DataFrame,
    order: list[str] | None = None,
    feature_set: str | dict = "comprehensive",
    clean: bool = True,
    block_rows: int | None = None,
    **cleaning,
) -> DataFrame:
    """Feature matrix of raw series, gaps imputed; without ``clean`` only the validity test."""
    order = order or ["time"]
    if clean:
        s = preprocess(rows, order, block_rows=block_rows, **cleaning)
    else:
        s = open_series(valid_samples(rows), ["id"], order, block_rows)
    return impute(extract(s, feature_set), ["id"], written=True)


def extract_and_save(
    rows: DataFrame, output: str, labels: DataFrame | None = None, fmt: str = "parquet", **options
) -> DataFrame:
    """Write the matrix and return one row of statistics. Intermediate tables are removed."""
    with scratch(rows.sparkSession):
        return settled(_save(rows, output, labels, fmt, options))


def settled(stats: DataFrame) -> DataFrame:
    """A row of statistics that no longer depends on what it was made from."""
    return stats.sparkSession.createDataFrame(stats.collect(), stats.schema)


def _save(rows: DataFrame, output: str, labels: DataFrame | None, fmt: str, options: dict) -> DataFrame:
    matrix = features_of(rows, **options)
    if labels is not None:
        order = F.col("_order") if "_order" in labels.columns else None
        matrix = attach_labels(matrix, labels, order)
    write_matrix(matrix, output, fmt)
    written = rows.sparkSession.read.format(fmt)
    written = (written.option("header", "true") if fmt == "csv" else written).load(output)
    names = [c for c in matrix.columns if c not in ("id", "label")]
    stats = written.agg(F.count(F.lit(1)).alias("n_samples")).withColumn("n_features", F.lit(len(names)))
    if labels is not None:
        stats = stats.join(F.broadcast(class_balance(written)))
    return stats


def extract_directory(
    spark: SparkSession,
    input_dir: str,
    output: str,
    labels_path: str | None = None,
    fmt: str = "parquet",
    pattern: str | None = None,
    max_files: int | None = None,
    **options,
) -> DataFrame:
    rows = read_series(spark, input_dir, fmt, pattern, max_files=max_files)
    labels = read_labels(spark, labels_path) if labels_path else None
    return extract_and_save(rows, output, labels, **options)


def process_dataset(rows: DataFrame, output: str, labels: DataFrame | None = None, resume: bool = True, **options) -> DataFrame:
    """Features of all series without a result in ``output``; new rows are appended.

    The written table and the list of failed ids beside it are the only state:
    a second run picks up what is neither done nor known to fail. Returns one
    row: series given, processed and failed, features, seconds and series per second.
    """
    started = time.monotonic()
    with scratch(rows.sparkSession):
        counts = _process(rows, output, labels, resume, options)
    spent = time.monotonic() - started
    rate = counts[1] / spent if spent else 0.0
    schema = "n_given long, n_processed long, n_failed long, n_features int, status string, seconds double, series_per_second double"
    return rows.sparkSession.createDataFrame([(*counts, "failed" if counts[2] and not counts[1] else "done", spent, rate)], schema)


def _process(rows: DataFrame, output: str, labels: DataFrame | None, resume: bool, options: dict) -> tuple[int, int, int, int]:
    spark, failures = rows.sparkSession, f"{output.rstrip('/')}_failed"
    todo = rows
    done = existing(spark, output) if resume else None
    if done is not None:
        left = not_yet_done(rows.select("id").distinct(), done, ["id"])
        if (known := existing(spark, failures)) is not None:
            left = not_yet_done(left, known, ["id"])
        left = materialise(left)
        todo = rows.filter(F.lit(False)) if left.isEmpty() else lookup(rows, left, ["id"])
    todo = materialise(todo)
    matrix = features_of(todo, **options)
    if labels is not None:
        matrix = attach_labels(matrix, labels, F.col("_order") if "_order" in labels.columns else None)
    write_matrix(matrix, output, mode="append" if resume else "errorifexists")
    given = todo.select("id").distinct()
    failed = materialise(not_yet_done(given, spark.read.parquet(output), ["id"]))
    n_given, n_failed = given.count(), failed.count()
    if n_failed:
        failed.write.mode("append").parquet(failures)
    return n_given, n_given - n_failed, n_failed, len([c for c in matrix.columns if c not in ("id", "label")])


def process_directory(
    spark: SparkSession, input_dir: str, output: str, labels_path: str | None = None, fmt: str = "parquet",
    pattern: str | None = None, max_files: int | None = None, resume: bool = True, **options,
) -> DataFrame:
    """Scan a folder, take up what has no result yet, attach labels, append. One row of statistics."""
    rows = read_series(spark, input_dir, fmt, pattern, max_files=max_files)
    labels = read_labels(spark, labels_path) if labels_path else None
    return process_dataset(rows, output, labels, resume, **options)


def existing(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None if nothing was written there yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def run(rows: DataFrame, labels: DataFrame, output: str, selection: dict | None = None, **options) -> DataFrame:
    """Extract, label, select and save below ``output``; one row of statistics."""
    stats = extract_and_save(rows, f"{output}/features", labels, **options)
    matrix = rows.sparkSession.read.parquet(f"{output}/features")
    chosen = select_and_save(matrix, f"{output}/selected", f"{output}/scores", **(selection or {}))
    return stats.join(F.broadcast(chosen))


def merged_batches(batches: list[DataFrame]) -> DataFrame:
    """Rows of several matrices, features missing in one are null."""
    out = batches[0]
    for other in batches[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out
