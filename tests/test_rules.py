"""Rules that only bite on unusual rows, and what a session leaves behind."""

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom import session
from starloom.functions.registry import extract
from starloom.functions import registry
from starloom.operators import assess, cleaning, joins, selection
from starloom.operators.series import open_series
from starloom.plans.compare import rounded


def long_series(spark, n=2500):
    return spark.range(n).select(F.lit("a").alias("id"), F.col("id").cast("double").alias("time"), (F.col("id") % 17 + 1.0).alias("flux"))


@pytest.mark.parametrize("block", [100_000, 300])
def test_windows_past_the_halo_are_refused(spark, block):
    s = open_series(long_series(spark), ["id"], ["time"], block).located(200)
    own = Window.partitionBy("id").orderBy("pos")
    for make in (
        lambda w: {"far": w.ahead("flux", 500)},
        lambda w: {"far": w.frame(F.sum("flux"), -201, 0)},
        lambda w: {"far": F.sum("flux").over(own)},
        lambda w: {"far": F.col("flux") - F.percent_rank().over(own)},
        lambda w: {"far": F.sum("flux").over(own.rangeBetween(-500, 0))},
    ):
        with pytest.raises(ValueError, match="reaches|window of its own"):
            s.windowed(make)


def test_frames_do_not_depend_on_the_plan(spark):
    def values(block):
        s = open_series(long_series(spark, 3000), ["id"], ["time"], block).located(10).windowed(lambda w: {
            "sum": w.frame(F.sum("flux"), -10, 10), "first": w.frame(F.first("flux"), -10, 0), "list": w.frame(F.collect_list("flux"), 0, 3),
            "slope": w.ahead("flux", 10) - w.back("flux", 10), "flux": -F.col("flux"),
        })
        s = s.with_running(total=F.col("flux")).with_columns(number=F.col("pos") + 1)
        s = s.windowed(lambda w: {"total": w.ahead("total", 9) - w.back("total", 10)})
        return sorted((tuple(r) for r in s.rows().select("time", "sum", "first", "list", "slope", "flux", "total", "number").collect()))

    assert values(None) == values(1000) == values(37)


@pytest.mark.parametrize("block", ["100000", "300"])
def test_families_that_look_far_get_their_halo(spark, block):
    def far(s):
        return s.windowed(lambda w: {"_far": w.ahead("flux", 500)}).per_key(F.count("_far").alias("n_far"))

    registry.register("far", far, halo=500)
    spark.conf.set("spark.starloom.blockRows", block)
    try:
        s = open_series(long_series(spark), ["id"], ["time"])
        assert extract(s, {"far": None}).first()["n_far"] == 2000
    finally:
        spark.conf.unset("spark.starloom.blockRows")
        for names in (registry.FAMILIES, registry.REACH, registry.FEATURE_SETS["efficient"], registry.FEATURE_SETS["comprehensive"]):
            names.pop("far")


def test_conflicting_labels_need_an_order(spark):
    ids = spark.createDataFrame([(1,), (2,)], "id long")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (2, 1, 0), (2, 1, 1)], "id long, label int, turn int")
    with pytest.raises(PySparkException, match="have no order"):
        joins.attach_labels(ids, labels.select("id", "label")).collect()
    found = joins.attach_labels(ids, labels, F.col("turn")).collect()
    assert {r["id"]: r["label"] for r in found} == {1: 0, 2: 1}


@pytest.mark.parametrize("chunk", [7, 100_000])
def test_long_gaps_are_emitted_in_chunks(spark, monkeypatch, chunk):
    monkeypatch.setattr(cleaning, "CHUNK_POINTS", chunk)
    rows = spark.createDataFrame([("a", t, t, 1.0) for t in (0.0, 1.0, 2.0, 3.0, 5000.0)], "id string, time double, flux double, flux_err double")
    got = sorted(r["flux"] for r in cleaning.interpolate_gaps(open_series(rows, ["id"], ["time"]), 2.0).rows().collect())
    assert got == pytest.approx([float(i) for i in range(5000)])


def test_scores_tie_by_significant_digits(spark):
    scores = spark.createDataFrame([("a", 1e-12), ("b", 4e-11), ("c", 0.0), ("d", 4e-11 * (1 + 1e-14))], "feature string, s double")
    assert [r["feature"] for r in selection.top_features(scores, "s", 3).collect()] == ["b", "d", "a"]


def test_scratch_is_removed_after_a_failure(spark):
    def exists(path):
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)

    with pytest.raises(KeyError):
        with session.scratch(spark) as path:
            session.materialise(spark.range(3))
            assert exists(path)
            raise KeyError
    assert not exists(path)


def test_a_fast_object_does_not_bring_slow_ones_together(spark):
    """2,000 slow objects far apart and one fast: candidates stay near linear, and no meeting is lost."""
    slow = [(i, float(i % 50), float(i // 50), 0.0, 0.001 * (i % 3), 0.0, 0.0) for i in range(2000)]
    columns = "id long, x double, y double, z double, vx double, vy double, vz double"
    both = spark.createDataFrame([*slow, (9999, -100.0, 7.0, 0.0, 200.0, 0.0, 0.0)], columns)
    assert assess.approach_candidates(both, both, 0.1, 1.0).count() < 3 * 2001
    found = assess.closest_approach(both, both, 0.1, 1.0).filter("object_id = 9999").select("catalog_id").collect()
    assert {r[0] for r in found} == {i for i in range(2000) if i // 50 == 7}


def test_crowded_cells_are_compared_in_many_tasks(spark):
    """Crowded cells go as tiles through a shuffle, thin ones through a join that is not broadcast; both meet all pairs."""
    rng = np.random.default_rng(5)
    state = np.vstack([rng.normal(0, 0.2, (400, 6)), np.hstack([rng.uniform(5, 9, (200, 3)), rng.normal(0, 0.2, (200, 3))])])
    columns = "id long, x double, y double, z double, vx double, vy double, vz double"
    both = spark.createDataFrame([(i, *map(float, row)) for i, row in enumerate(state)], columns)
    found = assess.closest_approach(both, both, 0.2, 1.0, block_rows=50)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "strategy=merge" in plan
    got = {(r[0], r[1]): (r[2], r[3]) for r in found.collect()}
    wanted = {}
    for i in range(len(state)):
        d = state - state[i]
        t = np.clip(-(d[:, :3] * d[:, 3:]).sum(1) / np.maximum((d[:, 3:] ** 2).sum(1), 1e-300), 0, 1)
        miss = np.linalg.norm(d[:, :3] + d[:, 3:] * t[:, None], axis=1)
        wanted.update({(i, int(j)): (t[j], miss[j]) for j in np.flatnonzero(miss <= 0.2) if j != i})
    assert got.keys() == wanted.keys() and len(got) > 1000
    assert np.allclose([got[k] for k in wanted], list(wanted.values()))
    assert any(min(k) >= 400 for k in got)


def test_rounding_of_many_rows_gives_the_same_numbers(spark):
    """Bit for bit, with halves, values beside them, signs, large, small and missing ones."""
    rng = np.random.default_rng(12)
    halves = (rng.integers(-(10**7), 10**7, 20_000) + 0.5) / 1e6
    values = np.concatenate([
        halves, np.nextafter(halves, 9), np.nextafter(halves, -9), halves * (1 + 1e-10), rng.normal(0, 1, 20_000), rng.normal(0, 1e-6, 20_000), rng.normal(0, 1e8, 5_000),
        rng.integers(-(10**12), 10**12, 5_000) / 1e6, [0.0, -0.0, np.nan, np.inf, -np.inf, 1e300, 5e-324, 99999.9999995, 4.999999999e-7],
    ])
    rows = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double").coalesce(1)
    for digits in (6, 4):
        got, wanted = ([r["x"] for r in rounded(rows, digits, many).collect()] for many in (True, False))
        assert got[-1] is None and np.array(got[:-1]).tobytes() == np.array(wanted[:-1]).tobytes()
