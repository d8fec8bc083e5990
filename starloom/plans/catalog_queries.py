"""Queries for catalogs, joins, manifests and statistics, with SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import catalog, joins
from starloom.operators.assess import class_balance
from starloom.plans import bindings
from starloom.plans.bindings import table
from starloom.plans.compare import r, rounded
from starloom.plans.extraction import merged_batches
from starloom.session import scratch_path
from starloom.sources import documents

BASE_URL = "https://images.example/"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as observations."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("obs_id"), F.col("o_custkey").alias("target"),
        F.col("o_orderstatus").alias("obs_collection"), F.col("o_orderpriority").alias("product_type"),
        F.col("o_totalprice").alias("t_exptime"), F.col("o_orderdate").alias("observed"),
    )


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as products."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("obs_id"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"),
        F.col("l_returnflag").alias("subgroup"), F.col("l_extendedprice").alias("size"),
    )


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "source")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    return joins.attach_labels(documents, labels)


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.format_string("doc_%06d.v1.txt", F.col("doc_id")).alias("name"), F.col("n_chars").alias("length"),
        F.col("text").alias("content"), "doc_id",
    )


def _defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("int").alias("sector"))
    rows = documents.join(labels, "doc_id", "left").select("doc_id", "sector", F.lit(1.5).alias("s_ra"))
    return catalog.with_defaults(rows, catalog.CATALOG_DEFAULTS)


def _stars(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ID"), F.col("p_size").cast("double").alias("rad"), F.col("p_retailprice").alias("Tmag")
    )
    return catalog.stellar_parameters(rows)


def _span(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("ts", "yyyy-MM-dd")
    return table(spark, sf_dir, "events").agg(F.min(day).alias("start"), F.max(day).alias("end"))


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = catalog.image_manifest(_span(spark, sf_dir), [300, 100], 150, BASE_URL)
    return catalog.in_manifest(found, "2024-01-03", "2024-01-12", [100, 300])


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = catalog.target_documents(
        _orders(spark, sf_dir), "target", ["observed", "obs_id"], ["obs_id", "obs_collection", "t_exptime"], per_document=8
    )
    return nested.select(
        "target", "part", "n_observations", F.size("observations").cast("long").alias("n_inside"),
        F.array_join(F.transform("observations", lambda o: o["obs_id"].cast("string")), ",").alias("obs_ids"),
    )


def _json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested documents to JSON text and back, one row per observation again."""
    nested = catalog.target_documents(
        _orders(spark, sf_dir), "target", ["observed", "obs_id"], ["obs_id", "observed"], per_document=100
    )
    stamped = nested.withColumn(
        "observations", F.transform("observations", lambda o: F.struct(o["obs_id"].alias("obs_id"), catalog.iso_utc(o["observed"]).alias("observed")))
    )
    path = scratch_path(spark)
    documents.write_documents(stamped.select("target", "observations"), path)
    schema = "target long, observations array<struct<obs_id: long, observed: string>>"
    parsed = documents.read_documents(spark, path, schema)
    return parsed.select("target", F.explode("observations").alias("o")).select("target", "o.obs_id", "o.observed")


def _checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _files(spark, sf_dir)
    md5 = F.when(F.col("doc_id") % 3 == 0, F.lit(None)).when(F.col("doc_id") % 7 == 0, F.lit("0" * 32)).otherwise(F.md5("content"))
    found = catalog.verify_checksums(files, files.select("name", md5.alias("md5")))
    return catalog.tally(found, "status", ["status"])


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = catalog.file_stats(_files(spark, sf_dir))
    return rounded(found.select("n_files", "total_gb", F.array_join("names", ",").alias("names")), 9)


def _totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    results = rows.select(
        "source", (F.col("quality") == 1).cast("long").alias("successful"), (F.col("quality") == 0).cast("long").alias("failed"),
        (F.col("n_chars") / F.lit(float(1024**3))).alias("size_gb"),
    )
    return rounded(catalog.source_totals(results), 9)


def _unioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two data sets in one job: rows of both, told apart by a column."""
    a = bindings.event_series(spark, sf_dir).select("id", "time", "flux", "event_id", F.lit("events").alias("dataset"))
    b = bindings.lineitem_series(spark, sf_dir).select("id", "time", "flux", "flux_err", F.lit("lineitem").alias("dataset"))
    both = merged_batches([a, b])
    return rounded(both.groupBy("dataset", "id").agg(
        F.count(F.lit(1)).alias("n"), F.max("time").alias("last"), F.count("flux_err").alias("n_err")
    ), 6)


def _batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "documents").select("doc_id")
    return catalog.batch_index(ids, ["doc_id"], 100).groupBy("batch_index").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")
    )


def _props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "k long")["k"].alias("k"), F.get_json_object("props", "$.k").alias("k_text")
    )


ORDERS = "(SELECT o_orderkey AS obs_id, o_custkey AS target, o_orderstatus AS obs_collection, o_orderpriority AS product_type, o_totalprice AS t_exptime, o_orderdate AS observed FROM orders)"
PRODUCTS = "(SELECT l_orderkey AS obs_id, l_linenumber AS line, l_partkey AS part, l_returnflag AS subgroup, l_extendedprice AS size FROM lineitem)"
FILES = "(SELECT printf('doc_%06d.v1.txt', doc_id) AS name, n_chars AS length, text AS content, doc_id FROM documents)"

QUERIES = {
    "catalog_filter": lambda spark, sf_dir: catalog.matching(
        _orders(spark, sf_dir), {"obs_collection": "F"}, {"product_type": ["1-URGENT", "2-HIGH"]}
    ).select("obs_id", "target"),
    "product_types": lambda spark, sf_dir: catalog.matching(_products(spark, sf_dir), among={"subgroup": ["A", "R"]}).select(
        "obs_id", "line", "subgroup"
    ),
    "catalog_defaults": _defaults,
    "stellar_parameters": _stars,
    "image_manifest": _manifest,
    "first_targets": lambda spark, sf_dir: catalog.first_targets(
        _orders(spark, sf_dir).select("obs_id", "t_exptime"), ["t_exptime", "obs_id"], 100
    ),
    "attach_labels": _labelled,
    "class_balance": lambda spark, sf_dir: rounded(class_balance(_labelled(spark, sf_dir)), 6),
    "last_label_wins": lambda spark, sf_dir: joins.last_by_key(
        table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), "event_type", "event_id"), ["id"], F.col("event_id")
    ),
    "resume_filter": lambda spark, sf_dir: joins.not_yet_done(
        table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), ["doc_id"]
    ),
    "skip_existing": lambda spark, sf_dir: catalog.not_stored(
        _files(spark, sf_dir).select("name", "length"),
        _files(spark, sf_dir).join(table(spark, sf_dir, "labels").filter("quality = 1"), "doc_id").select("name"), "name",
    ),
    "products_of_observations": lambda spark, sf_dir: catalog.products_of(
        _orders(spark, sf_dir).select("obs_id", "target"), _products(spark, sf_dir).select("obs_id", "line", "part"), "obs_id"
    ),
    "products_of_observations_split": lambda spark, sf_dir: catalog.products_of(
        _orders(spark, sf_dir).select("obs_id", "target"), _products(spark, sf_dir).select("obs_id", "line", "part"), "obs_id",
        block_rows=6,
    ),
    "observations_without_products": lambda spark, sf_dir: catalog.observations_without(
        _orders(spark, sf_dir).select("obs_id", "target"), _products(spark, sf_dir), "obs_id"
    ),
    "first_product": lambda spark, sf_dir: rounded(catalog.first_product(_products(spark, sf_dir), "obs_id", ["line", "part", "size"]), 6),
    "target_documents": _documents,
    "json_documents": _json_documents,
    "checksum_status": _checksums,
    "file_statistics": _stats,
    "source_totals": _totals,
    "outcome_tally": lambda spark, sf_dir: catalog.tally(
        table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left").select(
            "lang", F.when(F.col("quality") == 1, "ok").otherwise("failed").alias("status")
        ), "status", ["lang"],
    ),
    "union_of_datasets": _unioned,
    "batch_index": _batches,
    "json_fields": _props,
    "file_stems": lambda spark, sf_dir: _files(spark, sf_dir).select("name", catalog.file_stem(F.col("name")).alias("stem")),
}

ORACLES = {
    "catalog_filter": f"SELECT obs_id, target FROM {ORDERS} WHERE obs_collection = 'F' AND product_type IN ('1-URGENT', '2-HIGH')",
    "product_types": f"SELECT obs_id, line, subgroup FROM {PRODUCTS} WHERE subgroup IN ('A', 'R')",
    "catalog_defaults": """SELECT doc_id, coalesce(CAST(quality AS INTEGER), 0) AS sector, 1.5::DOUBLE AS s_ra,
      0.0::DOUBLE AS s_dec, 0.0::DOUBLE AS t_exptime FROM documents LEFT JOIN labels USING (doc_id)""",
    "stellar_parameters": """SELECT CAST(p_partkey AS VARCHAR) AS tic_id, 0.0::DOUBLE AS ra, 0.0::DOUBLE AS dec,
      5778.0::DOUBLE AS teff, 4.44::DOUBLE AS logg, CAST(p_size AS DOUBLE) AS radius, 1.0::DOUBLE AS mass,
      p_retailprice AS tmag, 0.0::DOUBLE AS distance FROM part""",
    "image_manifest": f"""WITH d AS (SELECT CAST(unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS DATE) AS day FROM events),
      f AS (SELECT * FROM (VALUES (0, 300), (1, 100)) AS v(place, field_id)),
      m AS (SELECT * FROM d, f, (SELECT CAST(i AS INTEGER) AS ccd_id FROM range(1, 5) AS g(i)) ORDER BY day, place, ccd_id LIMIT 150),
      n AS (SELECT *, printf('ztf_%s_field%06d_ccd%02d_sci.fits', strftime(day, '%Y%m%d'), field_id, ccd_id) AS filename FROM m)
      SELECT filename, field_id, ccd_id, strftime(day, '%Y-%m-%d') AS date,
        '{BASE_URL}' || printf('sci/%s/%s/field%06d/', strftime(day, '%Y'), strftime(day, '%m%d'), field_id) || filename AS url,
        150.0::DOUBLE AS size_mb, CAST(NULL AS VARCHAR) AS md5 FROM n
      WHERE day BETWEEN DATE '2024-01-03' AND DATE '2024-01-12' AND field_id IN (100, 300)""",
    "first_targets": f"SELECT obs_id, t_exptime FROM {ORDERS} ORDER BY t_exptime, obs_id LIMIT 100",
    "attach_labels": """SELECT doc_id AS id, source, CAST(coalesce(quality, 0) AS INTEGER) AS label
      FROM documents LEFT JOIN labels USING (doc_id)""",
    "class_balance": f"""SELECT count(*) FILTER (WHERE l = 1) AS n_positive, count(*) FILTER (WHERE l <> 1) AS n_negative,
      {r('count(*) FILTER (WHERE l = 1) / count(*)', 'ratio')}
      FROM (SELECT coalesce(quality, 0) AS l FROM documents LEFT JOIN labels USING (doc_id))""",
    "last_label_wins": "SELECT user_id AS id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY user_id",
    "resume_filter": "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "skip_existing": f"SELECT name, length FROM {FILES} WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)",
    "products_of_observations": f"SELECT obs_id, line, part, target FROM {PRODUCTS} JOIN {ORDERS} USING (obs_id)",
    "observations_without_products": f"SELECT obs_id, target FROM {ORDERS} WHERE obs_id NOT IN (SELECT l_orderkey FROM lineitem)",
    "first_product": f"""SELECT obs_id, line, part, subgroup, {r('size', 'size')} FROM (SELECT *, row_number() OVER
      (PARTITION BY obs_id ORDER BY line, part, size) AS k FROM {PRODUCTS}) WHERE k = 1""",
    "target_documents": f"""WITH p AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY observed, obs_id) - 1 AS pos,
        count(*) OVER (PARTITION BY target) AS n_observations FROM {ORDERS})
      SELECT target, pos // 8 AS part, max(n_observations) AS n_observations, count(*) AS n_inside,
        string_agg(CAST(obs_id AS VARCHAR), ',' ORDER BY pos) AS obs_ids FROM p GROUP BY target, pos // 8""",
    "json_documents": f"SELECT target, obs_id, strftime(observed, '%Y-%m-%dT%H:%M:%SZ') AS observed FROM {ORDERS}",
    "checksum_status": f"""WITH f AS (SELECT *, md5(content) AS actual FROM {FILES}),
      e AS (SELECT *, CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN repeat('0', 32) ELSE actual END AS expected FROM f),
      s AS (SELECT CASE WHEN expected IS NULL THEN 'unchecked' WHEN expected = actual THEN 'ok' ELSE 'corrupt' END AS status FROM e)
      SELECT status, count(*) AS n_total, count(*) FILTER (WHERE status = 'ok') AS n_successful,
        count(*) FILTER (WHERE status <> 'ok') AS n_failed FROM s GROUP BY status""",
    "file_statistics": f"""SELECT count(*) AS n_files, {r('sum(length) / 1073741824.0', 'total_gb', 9)},
      (SELECT string_agg(name, ',' ORDER BY name) FROM (SELECT name FROM {FILES} ORDER BY name LIMIT 10)) AS names FROM {FILES}""",
    "source_totals": f"""SELECT source, CAST(coalesce(sum(CASE WHEN quality = 1 THEN 1 WHEN quality = 0 THEN 0 END), 0) AS BIGINT) AS successful,
      CAST(coalesce(sum(CASE WHEN quality = 0 THEN 1 WHEN quality = 1 THEN 0 END), 0) AS BIGINT) AS failed,
      {r('sum(n_chars / 1073741824.0)', 'size_gb', 9)} FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ROLLUP (source)""",
    "outcome_tally": """SELECT lang, count(*) AS n_total, count(*) FILTER (WHERE quality = 1) AS n_successful,
      count(*) FILTER (WHERE quality IS DISTINCT FROM 1) AS n_failed FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang""",
    "union_of_datasets": f"""SELECT 'events' AS dataset, id, count(*) AS n, {r('max(time)', 'last')}, CAST(0 AS BIGINT) AS n_err FROM ({bindings.S1_SQL}) GROUP BY id
      UNION ALL SELECT 'lineitem', id, count(*), {r('max(time)', 'last')}, count(flux_err) FROM ({bindings.S2_SQL}) GROUP BY id""",
    "batch_index": """SELECT b AS batch_index, count(*) AS n, min(doc_id) AS first_id, max(doc_id) AS last_id
      FROM (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS b FROM documents) GROUP BY b""",
    "json_fields": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS k_text FROM events",
    "file_stems": f"SELECT name, regexp_replace(name, '\\.[^.]*$', '') AS stem FROM {FILES}",
}
ORACLES["products_of_observations_split"] = ORACLES["products_of_observations"]
