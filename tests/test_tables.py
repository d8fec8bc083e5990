"""Sources, catalogs, whole plans, monitoring and streams on small tables."""

import datetime as dt

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starloom.operators import assess, catalog, monitor
from starloom.operators.joins import attach_labels
from starloom.operators.series import open_series
from starloom.plans import extraction
from starloom.sources import documents, matrix, series
from starloom.streaming import streams

FEW = {"moments": ["flux__mean", "flux__length"]}


@pytest.fixture
def curves(spark, tmp_path):
    """Three series files with different flux columns, and labels with a repeat."""
    rng = np.random.default_rng(2)
    for i in range(3):
        flux = {"PDCSAP_FLUX": 1 + 0.01 * rng.standard_normal(150), "SAP_FLUX": np.full(150, np.nan)}
        pd.DataFrame({"TIME": np.arange(150.0), **flux}).to_parquet(tmp_path / f"star.{i}.parquet")
    (tmp_path / "labels.csv").write_text("id,label\nstar.0,0\nstar.1,1\nstar.0,1\n")
    return tmp_path


def test_scan_takes_id_from_the_name(spark, curves):
    rows = series.read_series(spark, str(curves))
    assert {r["id"] for r in rows.select("id").distinct().collect()} == {"star.0", "star.1", "star.2"}
    assert rows.agg(F.max("flux_err")).first()[0] == 1.0
    capped = series.read_series(spark, str(curves), max_files=2)
    assert {r["id"] for r in capped.select("id").distinct().collect()} == {"star.0", "star.1"}


def test_repeated_names_are_refused(spark, curves):
    (curves / "deep").mkdir()
    pd.DataFrame({"TIME": [1.0], "SAP_FLUX": [1.0]}).to_parquet(curves / "deep" / "star.0.parquet")
    with pytest.raises(ValueError):
        series.read_series(spark, str(curves), recursive=True)


def test_flux_needs_a_column(spark):
    with pytest.raises(ValueError):
        series.resolve_flux(spark.createDataFrame([(1.0,)], "TIME double"))
    got = series.resolve_flux(spark.createDataFrame([(1.0, 2.0, 0.5)], "TIME double, SAP_FLUX float, SAP_FLUX_ERR float")).first()
    assert got["flux"] == 2.0 and got["flux_err"] == 0.5


def test_directory_to_matrix(spark, curves, tmp_path):
    out = str(tmp_path / "matrix")
    stats = extraction.extract_directory(
        spark, str(curves), out, str(curves / "labels.csv"), feature_set=FEW, detrend_flux=False
    ).first()
    assert (stats["n_samples"], stats["n_positive"], stats["n_negative"]) == (3, 2, 1)
    found, names = matrix.read_matrix(spark, out)
    assert names == FEW["moments"]
    labels = {r["id"]: r["label"] for r in found.collect()}
    assert labels == {"star.0": 1, "star.1": 1, "star.2": 0}


def test_resume_appends_only_what_is_left(spark, curves, tmp_path):
    rows = series.read_series(spark, str(curves))
    out = str(tmp_path / "out")
    first = extraction.process_dataset(rows.filter("id = 'star.1'"), out, feature_set=FEW, detrend_flux=False).first()
    second = extraction.process_dataset(rows, out, feature_set=FEW, detrend_flux=False).first()
    third = extraction.process_dataset(rows, out, feature_set=FEW, detrend_flux=False).first()
    assert [r["n_processed"] for r in (first, second, third)] == [1, 2, 0]
    assert spark.read.parquet(out).select("id").distinct().count() == spark.read.parquet(out).count() == 3


def test_labels_default_to_zero(spark):
    features = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "id string, f double")
    got = attach_labels(features, spark.createDataFrame([("a", 1)], "id string, label int")).orderBy("id").toPandas()
    assert got.label.tolist() == [1, 0]


def test_series_sink(spark, curves, tmp_path):
    rows = series.read_series(spark, str(curves)).select("id", "time", "flux", "flux_err")
    series.write_series(rows, str(tmp_path / "store"), buckets=4)
    assert spark.read.parquet(str(tmp_path / "store")).count() == rows.count()


def test_bad_date_gives_no_images(spark):
    nights = spark.createDataFrame([("2024-13-77", "2024-01-05")], "start string, end string")
    assert catalog.image_manifest(nights).count() == 0
    good = spark.createDataFrame([("2024-01-01", "2024-01-02")], "start string, end string")
    found = catalog.image_manifest(good, [100], 7).toPandas()
    assert len(found) == 7 and set(found.field_id) == {100}
    assert found.filename[0] == "ztf_20240101_field000100_ccd01_sci.fits"


def test_star_defaults(spark):
    sparse = catalog.stellar_parameters(spark.createDataFrame([("7", float("nan"))], "ID string, Teff double")).first()
    assert np.isnan(sparse["teff"]) and sparse["logg"] == 4.44
    filled = catalog.stellar_parameters(spark.createDataFrame([("7", float("nan"))], "ID string, Teff double"), True).first()
    assert filled["teff"] == 5778.0


def test_checksums_of_files(spark, tmp_path):
    (tmp_path / "good.bin").write_bytes(b"abc")
    (tmp_path / "bad.bin").write_bytes(b"abd")
    files = spark.read.format("binaryFile").load(str(tmp_path)).select(
        F.element_at(F.split("path", "/"), -1).alias("name"), "content"
    )
    md5 = "900150983cd24fb0d6963f7d28e17f72"
    expected = spark.createDataFrame([("good.bin", md5), ("bad.bin", md5)], "name string, md5 string")
    got = {r["name"]: r["status"] for r in catalog.verify_checksums(files, expected).collect()}
    assert got == {"good.bin": "ok", "bad.bin": "corrupt"}


def test_large_targets_get_several_documents(spark):
    rows = spark.range(25).select(F.lit("t").alias("target"), F.col("id").alias("obs"))
    got = catalog.target_documents(rows, "target", ["obs"], ["obs"], per_document=10).orderBy("part").toPandas()
    assert [len(o) for o in got.observations] == [10, 10, 5]
    assert [o["obs"] for part in got.observations for o in part] == list(range(25))


def test_messages_round_trip(spark):
    text = '{"detection_id":"d1","timestamp":"2024-05-01T10:00:00Z","confidence":0.9,"object_parameters":{"position_eci":[1,2,3]}}'
    rows = spark.createDataFrame([(text,), ("broken",)], "value string")
    got = documents.parse_messages(rows, "threat_detections").withColumn("ts", documents.event_time("timestamp")).collect()
    assert got[0]["object_parameters"]["position_eci"] == [1.0, 2.0, 3.0] and got[0]["ts"].year == 2024
    assert got[1]["detection_id"] is None
    told = documents.parse_messages(rows, "threat_detections", broken="bad").collect()
    assert [r["bad"] for r in told] == [None, "broken"] and told[0]["confidence"] == 0.9


def test_curves_from_messages(spark):
    texts = ['{"id":"a","time":[1,2,3],"flux":[5,6]}', '{"id":"b","time":[],"flux":[1]}', '{"id":"c"}', '{"id":"d","time":[1],"flux":[2],"flux_err":[0.5]}']
    parsed = documents.parse_messages(spark.createDataFrame([(t,) for t in texts], "value string"), "light_curves")
    got = sorted(tuple(r) for r in documents.curve_rows(parsed).collect())
    assert got == [("a", 1.0, 5.0, None), ("a", 2.0, 6.0, None), ("d", 1.0, 2.0, 0.5)]


def samples(values, step=60, service=1):
    start = dt.datetime(2024, 1, 1)
    return [(service, start + dt.timedelta(seconds=step * i), i, float(v)) for i, v in enumerate(values)]


SCHEMA = "service long, ts timestamp, event_id long, value double"


@pytest.mark.parametrize("block_rows", [None, 4])
def test_condition_must_hold(spark, block_rows):
    rows = spark.createDataFrame(samples([9, 9, 9, 9, 1, 9, 9, 1, 9, 9, 9, 9, 9]), SCHEMA)
    s = open_series(rows, ["service"], ["ts", "event_id"], block_rows).located()
    got = monitor.held(s, monitor.breaches(F.col("value"), ">", 5.0), 180).orderBy("started").toPandas()
    assert got.n_samples.tolist() == [4, 5] and got.held_s.tolist() == [180.0, 240.0]


def test_counter_restart(spark):
    rows = spark.createDataFrame(samples([10, 15, 2, 6]), SCHEMA)
    s = monitor.increases(open_series(rows, ["service"], ["ts"]).located(1), "value")
    got = s.rows().orderBy("event_id").toPandas().increase
    assert got.tolist()[1:] == [5.0, 2.0, 4.0]


def test_held_alerts_span_batches_and_fire_once(spark, tmp_path):
    """A run over three batches fires in the batch where it has lasted long enough."""
    values = [9, 9, 1, 9, 9, 9, 9, 9, 9, 9, 1, 9]
    rows = samples(values) + samples([1] * 6 + [9] * 6, service=2)
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    found = None
    for low in (0, 4, 8):
        part = [r for r in rows if low <= r[2] < low + 4]
        spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(source)
        stream = streams.file_stream(spark, source, spark.read.parquet(source).schema)
        found = streams.held_alerts(stream, "value > 5", 240, out, checkpoint)
    got = {(r["service"], r["started"].minute) for r in found.collect()}
    assert got == {(1, 3), (2, 6)} and found.count() == 2


def test_box_search_finds_the_transit(spark):
    rng = np.random.default_rng(4)
    t = np.sort(rng.uniform(0, 60, 3000))
    flux = 1 + 0.0005 * rng.standard_normal(3000) - 0.01 * (((t - 1.0) % 3.0) < 0.15)
    rows = spark.createDataFrame(pd.DataFrame({"id": 1, "time": t, "flux": flux}))
    got = assess.box_search(open_series(rows, ["id"], ["time"]), [1.7, 2.3, 3.0, 3.7, 4.1], bins=60).first()
    assert got["period"] == 3.0 and got["depth"] == pytest.approx(0.01, abs=0.003)


def test_risk_categories(spark):
    rows = spark.createDataFrame([(v,) for v in (0.0, 1e-5, 1e-3, 0.05, 0.5)], "r double")
    got = [r[0] for r in rows.select(assess.risk_category(F.col("r"))).collect()]
    assert got == list(assess.RISK_CATEGORIES)


def test_approach_with_crowded_cells(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame(rng.normal(0, 0.2, (300, 6)), columns=["x", "y", "z", "vx", "vy", "vz"])
    pdf.insert(0, "id", range(300))
    both = spark.createDataFrame(pdf)
    got = assess.closest_approach(both, both, 0.05, 0.2, block_rows=25).count()
    p, v = pdf[["x", "y", "z"]].to_numpy(), pdf[["vx", "vy", "vz"]].to_numpy()
    d, w = p[None] - p[:, None], v[None] - v[:, None]
    t = np.clip(-(d * w).sum(2) / np.maximum((w * w).sum(2), 1e-300), 0, 0.2)
    near = np.linalg.norm(d + w * t[..., None], axis=2) <= 0.05
    assert got == near.sum() - 300


def test_a_file_per_key_needs_no_task_per_key(spark, tmp_path):
    """300 keys in 40 buckets: each file holds one key, each key has one file, and a task writes many of them."""
    rows = spark.range(900).selectExpr("id % 300 as key", "cast(id as double) as TIME", "cast(id div 300 as double) as SAP_FLUX")
    tables = spark.catalog.listTables()
    series.write_files(rows, str(tmp_path / "flat"), "key", buckets=40)
    names = [p.name for p in (tmp_path / "flat").glob("*.parquet")]
    assert len(names) == 300 and len({n.split("-")[1] for n in names}) < 60
    found = spark.read.parquet(str(tmp_path / "flat")).groupBy(F.col("_metadata.file_name")).agg(F.count_distinct("key").alias("keys"), F.count("key").alias("n"))
    assert {(r["keys"], r["n"]) for r in found.collect()} == {(1, 3)}
    assert series.read_series(spark, str(tmp_path / "flat")).select("id").distinct().count() == 300
    assert spark.catalog.listTables() == tables


def test_approach_copies_few_rows_and_sends_pairs_on(spark, monkeypatch):
    """A row is copied for each large tile of the other side, not for each small one, and pairs leave a task in stretches."""
    monkeypatch.setattr(assess, "TILES", 10)
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame(np.hstack([rng.uniform(0.02, 0.08, (3000, 3)), np.zeros((3000, 3))]), columns=["x", "y", "z", "vx", "vy", "vz"])
    pdf.insert(0, "id", [f"o{i}" for i in range(3000)])
    both = spark.createDataFrame(pdf)
    left, right, on, tasks = assess._tiled(both, both, 0.05, 1.0, 50)
    assert left.count() == right.count() == 3000 and tasks == 1
    state = pdf[assess.STATE[1:]].to_numpy().T
    tile = [pa.array([pdf.id.tolist()], pa.list_(pa.string())), pa.array([state.tobytes()], pa.binary())]
    sent = list(assess._meeting(0.05, 1.0)(iter([pa.RecordBatch.from_arrays(tile * 2, ["a_id", "a", "b_id", "b"])])))
    assert len(sent) > 5 and max(b.num_rows for b in sent) <= assess.PAIRS_SENT + assess.PAIRS_AT_ONCE
    d = state[:3].T[:, None] - state[:3].T[None]
    near = np.linalg.norm(d, axis=2) <= 0.05
    assert sum(b.num_rows for b in sent) == near.sum() > 1_000_000
    found = assess.closest_approach(both, both, 0.05, 1.0, 50)
    assert found.count() == near.sum() - 3000 and not found.filter("object_id = catalog_id").count()
