"""Observation catalogs, products, manifests, checksums and their statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.joins import first_by_key, lookup
from starloom.operators.series import global_positions, open_series

# Catalog defaults for missing coordinates and exposure.
CATALOG_DEFAULTS = {"s_ra": 0.0, "s_dec": 0.0, "t_exptime": 0.0, "sector": 0}

# Source column, name and default of the star's parameters.
STELLAR_PARAMETERS = (
    ("ID", "tic_id", "unknown"),
    ("ra", "ra", 0.0),
    ("dec", "dec", 0.0),
    ("Teff", "teff", 5778.0),
    ("logg", "logg", 4.44),
    ("rad", "radius", 1.0),
    ("mass", "mass", 1.0),
    ("Tmag", "tmag", 99.0),
    ("d", "distance", 0.0),
)

# Image fields used when none are given, and images per field.
DEFAULT_FIELDS = (100, 200, 300)
CCDS = 4
IMAGE_MB = 150.0


def matching(df: DataFrame, equal: dict | None = None, among: dict | None = None) -> DataFrame:
    """Equality and membership predicates, pushed to the scan."""
    for name, value in (equal or {}).items():
        df = df.filter(F.col(name) == value)
    for name, values in (among or {}).items():
        df = df.filter(F.col(name).isin(list(values)))
    return df


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Fill missing columns and null values with defaults."""
    return df.withColumns(
        {n: F.coalesce(F.col(n), F.lit(v)) if n in df.columns else F.lit(v) for n, v in defaults.items()}
    )


def stellar_parameters(df: DataFrame, fill_values: bool = False) -> DataFrame:
    """Rename star columns; a default stands for a missing column.

    With ``fill_values`` it also stands for null and NaN values.
    """
    out = []
    for source, name, default in STELLAR_PARAMETERS:
        value = F.col(source) if source in df.columns else F.lit(default)
        if isinstance(default, str):
            value = value.cast("string")
        elif fill_values and source in df.columns:
            value = F.nanvl(value.cast("double"), F.lit(default))
        out.append((F.coalesce(value, F.lit(default)) if fill_values else value).alias(name))
    return df.select(*out)


def first_targets(df: DataFrame, order: list[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def file_stem(name: Column) -> Column:
    """Name without its last suffix."""
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def products_of(observations: DataFrame, products: DataFrame, key: str, block_rows: int | None = None) -> DataFrame:
    """Products of each observation; every product row carries its observation."""
    return lookup(products, observations, [key], "inner", block_rows)


def observations_without(observations: DataFrame, products: DataFrame, key: str) -> DataFrame:
    """Observations without any product; they count as failed."""
    return observations.join(products.select(key).distinct(), key, "left_anti")


def first_product(products: DataFrame, key: str, order: list[str]) -> DataFrame:
    return first_by_key(products, [key], F.struct(*order))


def target_documents(
    observations: DataFrame, target: str, order: list[str], fields: list[str], per_document: int = 10_000
) -> DataFrame:
    """Observations nested per target.

    A target with more than ``per_document`` observations gets several
    documents, numbered by ``part``; all its observations are kept.
    """
    s = open_series(observations, [target], order).located().with_stats(n_observations=F.count(F.lit(1)))
    rows = s.rows().withColumn("part", F.expr(f"pos div {per_document}"))
    nested = F.array_sort(F.collect_list(F.struct("pos", *fields)))
    documents = rows.groupBy(target, "part").agg(F.max("n_observations").alias("n_observations"), nested.alias("o"))
    return documents.select(
        target,
        "part",
        "n_observations",
        F.transform("o", lambda o: F.struct(*[o[f].alias(f) for f in fields])).alias("observations"),
    )


def iso_utc(timestamp: Column) -> Column:
    return F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def image_manifest(
    nights: DataFrame, field_ids: list[int] | None = None, max_images: int = 100, base_url: str = "https://images.example/"
) -> DataFrame:
    """Images of every night, field and CCD in that order, the first ``max_images``.

    ``nights`` has one row per range with string columns ``start`` and ``end``;
    a date that does not parse gives no images.
    """
    fields = list(field_ids or DEFAULT_FIELDS)
    first, last = [F.try_to_timestamp(F.col(c), F.lit("yyyy-MM-dd")).cast("date") for c in ("start", "end")]
    days = nights.select(first.alias("a"), last.alias("b")).filter("a <= b")
    rows = days.select(F.explode(F.sequence("a", "b")).alias("day"))
    rows = rows.select("day", F.posexplode(F.array(*[F.lit(f) for f in fields])).alias("place", "field_id"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(CCDS))).alias("ccd_id"))
    rows = rows.orderBy("day", "place", "ccd_id").limit(max_images)
    name = F.format_string(
        "ztf_%s_field%06d_ccd%02d_sci.fits", F.date_format("day", "yyyyMMdd"), F.col("field_id"), F.col("ccd_id")
    )
    folder = F.format_string(
        "sci/%s/%s/field%06d/", F.date_format("day", "yyyy"), F.date_format("day", "MMdd"), F.col("field_id")
    )
    return rows.select(
        name.alias("filename"),
        "field_id",
        "ccd_id",
        F.date_format("day", "yyyy-MM-dd").alias("date"),
        F.concat(F.lit(base_url), folder, name).alias("url"),
        F.lit(IMAGE_MB).alias("size_mb"),
        F.lit(None).cast("string").alias("md5"),
    )


def in_manifest(df: DataFrame, start: str, end: str, field_ids: list[int] | None = None) -> DataFrame:
    return df.filter(F.col("date").between(start, end) & F.col("field_id").isin(list(field_ids or DEFAULT_FIELDS)))


def not_stored(manifest: DataFrame, stored: DataFrame, key: str = "filename") -> DataFrame:
    """Manifest rows without a stored file."""
    return manifest.join(stored.select(key), key, "left_anti")


def verify_checksums(files: DataFrame, expected: DataFrame) -> DataFrame:
    """Compare the MD5 of ``content`` by ``name``; no expected value means unchecked.

    The digest is taken before the join, so contents never move.
    """
    digests = files.select("name", F.md5(F.col("content").cast("binary")).alias("actual"))
    joined = digests.join(expected.select("name", "md5"), "name", "left")
    status = (
        F.when(F.col("md5").isNull(), "unchecked")
        .when(F.lower("md5") == F.col("actual"), "ok")
        .otherwise("corrupt")
    )
    return joined.select("name", "actual", "md5", status.alias("status"))


def file_stats(files: DataFrame, first: int = 10) -> DataFrame:
    """Count, total size in GB and the first names."""
    totals = files.agg(
        F.count(F.lit(1)).alias("n_files"),
        (F.coalesce(F.sum("length"), F.lit(0)) / F.lit(float(1024**3))).alias("total_gb"),
    )
    names = files.select("name").orderBy("name").limit(first).agg(F.sort_array(F.collect_list("name")).alias("names"))
    return totals.join(F.broadcast(names))


def source_totals(results: DataFrame) -> DataFrame:
    """Successes, failures and size per source, and over all (source null)."""
    zero = F.lit(0)
    return results.rollup("source").agg(
        F.coalesce(F.sum("successful"), zero).alias("successful"),
        F.coalesce(F.sum("failed"), zero).alias("failed"),
        F.coalesce(F.sum("size_gb"), F.lit(0.0)).alias("size_gb"),
    )


def tally(df: DataFrame, status: str, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(F.col(status) == "ok").alias("n_successful"),
        F.count_if(F.col(status) != "ok").alias("n_failed"),
    )


def batch_index(ids: DataFrame, order: list[str], batch_size: int) -> DataFrame:
    """Batch number of each row in sorted order, without one global window."""
    placed = global_positions(ids, order)
    return placed.withColumn("batch_index", F.expr(f"pos div {batch_size}")).drop("pos")
