"""Both plans of a keyed, ordered table against pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from starloom.functions import basic
from starloom.operators.joins import first_by_key, last_by_key, lookup
from starloom.operators import series
from starloom.operators.series import BLOCK_ROWS, FEW_RANGES, _ranged, _ranges, global_positions, open_series, running_totals
from starloom.sources.series import write_series


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(3)
    n = 900
    key = np.where(rng.random(n) < 0.4, 0, rng.integers(1, 30, n))
    pdf = pd.DataFrame({"k": key, "t": rng.permutation(n), "v": np.round(rng.exponential(1, n), 1)})
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("block_rows", [None, 25, 100])
def test_positions_lags_and_running_sums(skewed, block_rows):
    pdf, df = skewed
    s = open_series(df, ["k"], ["t"], block_rows).located(halo=3)
    assert (s.hot is None) == (block_rows is None)
    s = s.windowed(lambda w: {"before": w.back("v", 3), "after": w.ahead("v", 2)})
    s = s.with_running(run=F.col("v")).with_latest(top=F.col("v")).with_stats(n=F.count(F.lit(1)))
    got = s.rows().toPandas().sort_values(["k", "t"]).reset_index(drop=True)
    want = pdf.sort_values(["k", "t"]).reset_index(drop=True)
    g = want.groupby("k").v
    assert len(got) == len(want)
    assert (got.pos == want.groupby("k").cumcount()).all()
    assert np.allclose(got.before, g.shift(3), equal_nan=True) and np.allclose(got.after, g.shift(-2), equal_nan=True)
    assert np.allclose(got.run, g.cumsum()) and np.allclose(got.top, g.cummax())
    assert (got.n == g.transform("size")).all()


@pytest.mark.parametrize("block_rows", [None, 25])
def test_quantiles(skewed, block_rows):
    pdf, df = skewed
    s = open_series(df, ["k"], ["t"], block_rows).with_quantiles("v", a=0.1, b=0.5, c=0.93)
    got = s.per_key(*[F.max(c).alias(c) for c in "abc"]).toPandas().set_index("k").sort_index()
    for c, q in zip("abc", (0.1, 0.5, 0.93)):
        assert np.allclose(got[c], pdf.groupby("k").v.quantile(q))


def test_copies_of_one_row_are_split(spark):
    """Rows equal in every column still get distinct positions, in several blocks."""
    df = spark.range(500).select(F.lit(1).alias("k"), F.lit(2.0).alias("t"))
    s = open_series(df, ["k"], ["t"], 40).located(halo=5)
    got = s.rows().toPandas()
    assert sorted(got.pos) == list(range(500))
    assert s.hot.select("_block").distinct().count() >= 12


def test_halo_may_be_wider_than_a_block(spark):
    df = spark.range(300).select(F.lit(1).alias("k"), F.col("id").cast("double").alias("t"))
    s = open_series(df, ["k"], ["t"], 20).located(halo=60).windowed(lambda w: {"far": w.ahead("t", 60)})
    got = s.rows().toPandas().sort_values("t")
    assert np.allclose(got.far.dropna(), np.arange(60, 300))


def test_global_positions_and_totals(spark):
    spark.conf.set("spark.starloom.blockRows", "50")
    try:
        df = spark.range(0, 1000, 3).withColumn("w", F.col("id") % 7)
        got = global_positions(df.orderBy(F.rand(1)), ["id"]).toPandas().sort_values("id")
        assert (got.pos.to_numpy() == np.arange(len(got))).all()
        run = running_totals(df, [], ["id"], total="w").toPandas().sort_values("id")
        assert (run.total.to_numpy() == (np.arange(0, 1000, 3) % 7).cumsum()).all()
    finally:
        spark.conf.unset("spark.starloom.blockRows")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("block_rows", [None, 30])
def test_lookup(skewed, spark, how, block_rows):
    pdf, df = skewed
    one = pd.DataFrame({"k": range(0, 20), "name": [f"n{i}" for i in range(20)]})
    got = lookup(df, spark.createDataFrame(one), ["k"], how, block_rows).toPandas()
    want = pdf.merge(one, on="k", how=how)
    by = ["k", "t"]
    pd.testing.assert_frame_equal(
        got.sort_values(by).reset_index(drop=True)[["k", "t", "name"]].fillna("-"),
        want.sort_values(by).reset_index(drop=True)[["k", "t", "name"]].fillna("-"),
        check_dtype=False,
    )


def test_first_and_last(skewed):
    pdf, df = skewed
    first = first_by_key(df, ["k"], F.col("t")).toPandas().set_index("k").sort_index()
    last = last_by_key(df, ["k"], F.col("t")).toPandas().set_index("k").sort_index()
    ordered = pdf.sort_values("t").groupby("k")
    assert np.allclose(first.v, ordered.v.first().sort_index()) and np.allclose(last.v, ordered.v.last().sort_index())


def test_plan_has_one_exchange(spark, sf_dir, capsys):
    """Gate, clip and normalisation share the partitioning by id; the scan is pruned and filtered."""
    from starloom.operators.cleaning import preprocess
    from starloom.plans import bindings

    rows = preprocess(bindings.lineitem_series(spark, sf_dir), bindings.S2_ORDER, detrend_flux=False).rows()
    rows.explain("formatted")
    plan = capsys.readouterr().out
    assert plan.count("hashpartitioning(") == 1
    assert "GreaterThan(l_extendedprice,0.0)" in plan and "l_quantity" not in plan


def test_small_blocks_make_no_more_ranges_than_rows_fill(spark):
    """Ranges follow the rows, not the blocks: tasks of some ten rows each do not end on large tables."""
    assert [_ranges(n, 64) for n in (0, 64, 640, 6_000_000, 60_000_000)] == [1, 1, 10, FEW_RANGES, 240]
    assert _ranges(10 * BLOCK_ROWS, BLOCK_ROWS) == 10
    df = spark.range(4000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    ranged = _ranged(df, ("k",), ("t",), 10)
    assert ranged.select("_part").distinct().count() <= FEW_RANGES
    assert ranged.groupBy("k").agg(F.count_distinct("_part").alias("n")).agg(F.min("n")).first()[0] > 5
    got = open_series(df, ["k"], ["t"], 10).located(3).rows()
    assert got.filter("pos = t div 3").count() == 4000


def test_task_results_of_split_changes_do_not_follow_the_blocks(spark):
    """What tasks send back follows their number: ten times the rows in blocks of eight make hardly more tasks."""

    def tasks(rows: int) -> int:
        group, sc = f"changes of {rows}", spark.sparkContext
        df = spark.range(rows).selectExpr("id div 20 as id", "id * 1.0D as time", "id % 7 * 1.0D as flux")
        sc.setJobGroup(group, group)
        try:
            found = basic.changes(open_series(df, ["id"], ["time"], 8).located(2)).collect()
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        assert len(found) == rows // 20
        stages = {i for job in sc.statusTracker().getJobIdsForGroup(group) for i in sc.statusTracker().getJobInfo(job).stageIds}
        return sum(sc.statusTracker().getStageInfo(i).numCompletedTasks for i in stages if sc.statusTracker().getStageInfo(i))

    small, large = tasks(800), tasks(8000)
    assert 0 < large < small + 3 * FEW_RANGES


def test_write_series_makes_no_more_tasks_than_rows_fill(spark, tmp_path):
    """A small ``rows_per_task`` gives a file per task only until the rows of a table fill larger ones."""
    df = spark.range(4000).select((F.col("id") % 50).alias("id"), F.col("id").cast("double").alias("time"))
    write_series(df, str(tmp_path / "out"), buckets=4, rows_per_task=5)
    assert len(list((tmp_path / "out").rglob("*.parquet"))) <= FEW_RANGES
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4000


def test_tasks_of_ordinary_keys_follow_the_rows(spark, monkeypatch, capsys):
    """The rows of a large table are dealt once, to as many tasks as they fill, whatever the shuffle partitions."""
    monkeypatch.setattr(series, "RANGE_ROWS", 50)
    df = spark.range(4000).select((F.col("id") % 300).alias("k"), F.col("id").alias("t"))
    s = open_series(df, ["k"], ["t"]).with_stats(n=F.count(F.lit(1))).with_quantiles("t", mid=0.5).located()
    s.cold.explain()
    plan = capsys.readouterr().out
    assert plan.count("hashpartitioning(") == 1 and ", 80)" in plan and s.cold.rdd.getNumPartitions() == 80
    assert s.cold.filter("pos = t div 300 and n in (13, 14)").count() == 4000
