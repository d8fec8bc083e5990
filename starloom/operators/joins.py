"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.series import BLOCK_ROWS, MAX_HOT
from starloom.session import materialise


def hot_keys(df: DataFrame, keys: list[str], block_rows: int | None = None) -> DataFrame | None:
    """Keys with more rows than a block, at most ``MAX_HOT`` of them, or None."""
    spark = df.sparkSession
    wanted = block_rows or int(spark.conf.get("spark.starloom.blockRows", str(BLOCK_ROWS)))
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    top = sizes.agg(F.max("_n"), F.sum("_n")).first()
    limit = max(wanted, (top[1] or 0) // MAX_HOT)
    if (top[0] or 0) <= limit:
        return None
    return materialise(sizes.filter(F.col("_n") > limit).select(*keys))


def lookup(many: DataFrame, one: DataFrame, keys: list[str], how: str = "inner", block_rows: int | None = None) -> DataFrame:
    """Join a large table to one with unique keys.

    Rows of hot keys meet their few partners by broadcast and do not move; all
    other rows take the join that Spark picks.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    hot = hot_keys(many, keys, block_rows)
    if hot is None:
        return many.join(one, keys, how)
    few = one.join(F.broadcast(hot), keys, "left_semi")
    still = many.join(F.broadcast(hot), keys, "left_semi").join(F.broadcast(few), keys, how)
    rest = many.join(F.broadcast(hot), keys, "left_anti").join(one, keys, how)
    return rest.unionByName(still)


def last_by_key(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """One row per key, the last in order; partial on the map side."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r"))
    return picked.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def first_by_key(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_r"))
    return picked.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def attach_labels(features: DataFrame, labels: DataFrame, order: Column | None = None, default: int = 0) -> DataFrame:
    """Label of each id, ``default`` if there is none.

    Of repeated labels the last in ``order`` wins. Without an order there is no
    last one, so labels of an id that differ are an error when the rows are read.
    """
    if order is not None:
        unique = last_by_key(labels, ["id"], order).select("id", "label")
    else:
        seen = labels.groupBy("id").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        conflict = F.raise_error(F.concat(F.lit("labels of an id differ and have no order: "), F.col("id").cast("string")))
        unique = seen.select("id", F.when(F.col("low").eqNullSafe(F.col("high")), F.col("low")).otherwise(conflict.cast("int")).alias("label"))
    joined = lookup(features.drop("label"), unique, ["id"], "left")
    return joined.withColumn("label", F.coalesce(F.col("label"), F.lit(default)).cast("int"))


def not_yet_done(todo: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key has no result yet."""
    return todo.join(done.select(*keys).distinct(), keys, "left_anti")
