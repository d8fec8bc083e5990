"""Feature matrices as Parquet or CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.selection import feature_names


def write_matrix(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Id and label first, then the features."""
    first = [c for c in ("id", "label") if c in df.columns]
    ordered = df.select(*first, *[c for c in df.columns if c not in first])
    writer = ordered.write.mode(mode).format(fmt)
    (writer.option("header", "true") if fmt == "csv" else writer).save(path)


def read_matrix(
    spark: SparkSession, path: str, fmt: str = "parquet", id_column: str = "id", label_column: str = "label"
) -> tuple[DataFrame, list[str]]:
    """The matrix, features as doubles, and the names of its features."""
    reader = spark.read.format(fmt)
    rows = (reader.option("header", "true") if fmt == "csv" else reader).load(path)
    names = feature_names(rows, id_column, label_column)
    return rows.select(
        F.col(id_column).alias("id"),
        F.col(label_column).cast("int").alias("label"),
        *[F.col(n).cast("double").alias(n) for n in names],
    ), names
