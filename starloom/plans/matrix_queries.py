"""Whole plans over the given tables: clean, extract, label, select, resume."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.basic import changes, moments, one_pass, quantiles
from starloom.functions.names import feature
from starloom.operators.cleaning import preprocess
from starloom.operators.joins import attach_labels
from starloom.plans import bindings, extraction
from starloom.plans.bindings import table
from starloom.plans.cleaning_queries import GATE, NORM, S2_COLUMNS, V2, _clip
from starloom.plans.compare import r, rounded
from starloom.session import scratch_path
from starloom.sources import matrix, series

SMALL_SET = {
    "moments": [feature(c) for c in ("mean", "standard_deviation", "minimum", "maximum", "length")],
    "changes": [feature("mean_abs_change")],
    "quantiles": [feature("quantile", q=0.1)],
}


def supplier_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1 for suppliers of the even regions."""
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    joined = supplier.join(F.broadcast(nation), supplier["s_nationkey"] == nation["n_nationkey"])
    return joined.select(F.col("s_suppkey").alias("id"), (F.col("n_regionkey") % 2 == 0).cast("int").alias("label"))


def flagship(spark: SparkSession, sf_dir: str, min_points: int = 100) -> DataFrame:
    """Validity, gate, clip, normalise, features and labels.

    The cleaning keeps one partitioning by id, and all features of the small
    set are aggregates over it.
    """
    s = preprocess(
        bindings.lineitem_series(spark, sf_dir), bindings.S2_ORDER, min_valid_points=min_points, outlier_sigma=1.2,
        detrend_flux=False,
    ).located(1)
    found = one_pass(s, [moments, changes, quantiles]).select("id", *[c for names in SMALL_SET.values() for c in names])
    return rounded(attach_labels(found, supplier_labels(spark, sf_dir)), 7)


def _options() -> dict:
    return {"order": bindings.S2_ORDER, "feature_set": SMALL_SET, "outlier_sigma": 1.2, "detrend_flux": False}


def _resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the suppliers first, then all: the second run appends the rest."""
    rows = bindings.lineitem_series(spark, sf_dir)
    out = scratch_path(spark)
    labels = supplier_labels(spark, sf_dir)
    extraction.process_dataset(rows.filter("id % 2 = 0"), out, labels, **_options())
    extraction.process_dataset(rows, out, labels, **_options())
    return rounded(spark.read.parquet(out), 7)


def _statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark)
    stats = extraction.extract_and_save(bindings.lineitem_series(spark, sf_dir), out, supplier_labels(spark, sf_dir), **_options())
    return rounded(stats, 6)


def _round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matrix to CSV and back."""
    out = scratch_path(spark)
    matrix.write_matrix(flagship(spark, sf_dir), out, "csv")
    found, names = matrix.read_matrix(spark, out, "csv")
    return rounded(found.select(F.col("id").cast("long").alias("id"), "label", *names), 7)


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per supplier series, scanned again with the id from the file name."""
    out = scratch_path(spark)
    rows = bindings.lineitem_series(spark, sf_dir).select(
        F.col("id").alias("PARTITION"), F.col("time").alias("TIME"), F.col("flux").alias("SAP_FLUX")
    )
    rows.repartition("PARTITION").write.partitionBy("PARTITION").parquet(out)
    listed = series.list_files(spark, out, "*.parquet", recursive=True)
    found = spark.read.option("recursiveFileLookup", "true").parquet(out)
    found = found.withColumn("id", F.regexp_extract(F.col("_metadata.file_path"), "PARTITION=([0-9]+)", 1).cast("long"))
    resolved = series.resolve_flux(found).join(F.broadcast(listed.agg(F.count(F.lit(1)).alias("n_files"))))
    return rounded(resolved.groupBy("id").agg(
        F.count(F.lit(1)).alias("n"), F.max("flux").alias("top"), F.max("flux_err").alias("err"),
        (F.max("n_files") > 0).alias("listed"),
    ), 6)


def _full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extraction, selection and statistics in one go."""
    out = scratch_path(spark)
    return rounded(extraction.run(
        bindings.lineitem_series(spark, sf_dir), supplier_labels(spark, sf_dir), out,
        {"method": "f_test", "k": 3}, **_options(),
    ), 6)


_ITEMS = {
    feature("mean"): "avg(flux)", feature("standard_deviation"): "stddev_pop(flux)", feature("minimum"): "min(flux)",
    feature("maximum"): "max(flux)", feature("mean_abs_change"): "avg(abs(d))", feature("quantile", q=0.1): "quantile_cont(flux, 0.1)",
}


def _matrix_sql(length: str, label_type: str, d: int) -> str:
    columns = ", ".join(r(e, n, d) for n, e in _ITEMS.items())
    return f"""WITH {V2}, {GATE}, {_clip('g', 1.2, S2_COLUMNS)}, {NORM},
      y AS (SELECT *, lead(flux) OVER (PARTITION BY id ORDER BY time, order_key, line_number) - flux AS d FROM z),
      w AS (SELECT id, {columns}, {length} AS "{feature('length')}" FROM y GROUP BY id),
      lab AS (SELECT s_suppkey AS id, CAST(n_regionkey % 2 = 0 AS {label_type}) AS label FROM supplier JOIN nation ON s_nationkey = n_nationkey)
      SELECT w.*, coalesce(label, 0) AS label FROM w LEFT JOIN lab USING (id)"""


QUERIES = {
    "flagship": flagship,
    "resumed_extraction": _resumed,
    "extraction_statistics": _statistics,
    "matrix_round_trip": _round_trip,
    "series_files": _files,
    "extract_and_select": _full,
}

ORACLES = {
    "flagship": _matrix_sql("count(*)", "INTEGER", 7),
    "resumed_extraction": _matrix_sql("CAST(count(*) AS DOUBLE)", "INTEGER", 7),
    "matrix_round_trip": _matrix_sql("CAST(count(*) AS DOUBLE)", "INTEGER", 7),
    "extraction_statistics": f"""WITH m AS ({_matrix_sql('count(*)', 'INTEGER', 7)})
      SELECT count(*) AS n_samples, CAST(7 AS INTEGER) AS n_features, count(*) FILTER (WHERE label = 1) AS n_positive,
        count(*) FILTER (WHERE label <> 1) AS n_negative, {r('count(*) FILTER (WHERE label = 1) / count(*)', 'ratio')} FROM m""",
    "extract_and_select": f"""WITH m AS ({_matrix_sql('count(*)', 'INTEGER', 7)})
      SELECT count(*) AS n_samples, CAST(7 AS INTEGER) AS n_features, count(*) FILTER (WHERE label = 1) AS n_positive,
        count(*) FILTER (WHERE label <> 1) AS n_negative, {r('count(*) FILTER (WHERE label = 1) / count(*)', 'ratio')},
        CAST(3 AS BIGINT) AS n_selected, CAST(7 AS INTEGER) AS n_total, {r('3 / 7', 'selected_ratio')} FROM m""",
    "series_files": f"""SELECT l_suppkey AS id, count(*) AS n, {r('max(l_extendedprice)', 'top')}, 1.0::DOUBLE AS err, true AS listed
      FROM lineitem GROUP BY l_suppkey""",
}
