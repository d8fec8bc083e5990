"""The forest that is grown in tasks, against plain recursion, Spark's forest and itself."""

import numpy as np
import pandas as pd
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from starloom.operators import forest, selection


def _table(spark, rows, width, classes=2, seed=3, parts=5):
    """Noise, with a label that follows the first features, a rare flag and a constant."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((rows, width))
    x[:, -2], x[:, -1] = rng.random(rows) < 0.01, 1.0
    label = np.clip(np.floor(x[:, 0] + 0.5 * x[:, 1] + rng.standard_normal(rows) + classes / 2), 0, classes - 1)
    pdf = pd.DataFrame(x, columns=[f"c{i}" for i in range(width)])
    pdf.insert(0, "label", label.astype(int))
    pdf.insert(0, "id", range(rows))
    return spark.createDataFrame(pdf).repartition(parts, "id"), [f"c{i}" for i in range(width)]


def _scores(found):
    return found.toPandas().set_index("feature").rf_importance


@pytest.fixture
def large(spark, monkeypatch):
    """A table above the limit, on which Spark's forest, whose every node passes the driver, is not asked."""

    def refused(**options):
        raise AssertionError("grown by Spark ML")

    monkeypatch.setattr(selection, "RandomForestClassifier", refused)
    return _table(spark, selection.TREE_ROWS // 100 + 100, 6)


def test_large_tables_need_no_forest_on_the_driver(large):
    df, names = large
    found = _scores(selection.forest_importance(df, names))
    assert found.sum() == pytest.approx(1.0) and found.idxmax() == "c0" and found["c5"] == 0.0


@pytest.mark.parametrize("classes", [2, 5])
def test_importances_are_those_of_sparks_forest(spark, classes):
    df, names = _table(spark, 3_000, 16, classes)
    own = _scores(selection.forest_importance(df, names, spark_rows=0))
    given = _scores(selection.forest_importance(df, names))
    assert np.corrcoef(own, given)[0, 1] > 0.98
    assert np.abs(own - given).max() < 0.2 * given.max() and own["c15"] == given["c15"] == 0.0


@pytest.mark.parametrize("classes", [2, 4])
def test_a_tree_does_not_depend_on_where_it_is_grown(spark, classes):
    """Nodes grown each by a task, or counted by many tasks down to a few rows: the same importances."""
    df, names = _table(spark, 2_000, 9, classes)
    whole = _scores(selection.forest_importance(df, names, trees=6, spark_rows=0))
    for node_rows in (700, 60):
        parts = _scores(selection.forest_importance(df, names, trees=6, spark_rows=0, node_rows=node_rows))
        assert np.allclose(whole, parts, rtol=1e-9, atol=1e-12)


@pytest.mark.parametrize("classes, levels", [(2, 30), (3, 30), (2, 3)])
def test_growth_is_that_of_plain_recursion(classes, levels):
    rng = np.random.default_rng(9)
    x = rng.integers(0, forest.BINS, (900, 7)).astype("uint8")
    x[:, 6] %= 2
    y = ((x[:, 0] > 12).astype(int) + (rng.random(900) < 0.3) * rng.integers(0, classes, 900)).clip(0, classes - 1).astype("uint8")
    w = forest.bag(1, 4, 0, 900)
    kept = w > 0
    x, y, w = x[kept], y[kept], w[kept]
    gains = np.zeros(7)

    def below(rows, node, level):
        total = np.bincount(y[rows], w[rows], classes)
        if level == levels or (total > 0).sum() < 2:
            return
        best = (0.0, 0, 0)
        for feature in forest.drawn(1, 4, np.array([node]), 7, 3)[0]:
            for cut in range(forest.BINS - 1):
                left = np.bincount(y[rows], w[rows] * (x[rows, feature] <= cut), classes)
                if 0 < left.sum() < total.sum():
                    right = total - left
                    gain = (left**2).sum() / left.sum() + (right**2).sum() / right.sum() - (total**2).sum() / total.sum()
                    best = max(best, (gain, -1, 0), key=lambda b: b[0]) if gain <= best[0] else (gain, feature, cut)
        if best[0] > 1e-9:
            gains[best[1]] += best[0]
            right = x[rows, best[1]] > best[2]
            below(rows[~right], 2 * node, level + 1)
            below(rows[right], 2 * node + 1, level + 1)

    below(np.arange(len(y)), 1, 0)
    assert np.allclose(forest.grow(x, y, w, classes, 1, 4, 1, levels, 3), gains)


def test_features_are_drawn_evenly_and_once():
    drawn = forest.drawn(7, 3, np.arange(1, 20_001), 12, 4)
    assert all(len(set(row)) == 4 for row in drawn[:500].tolist())
    assert np.abs(np.bincount(drawn.ravel(), minlength=12) / 20_000 - 4 / 12).max() < 0.02


def test_cuts_follow_all_rows(spark):
    """Few values are all told apart, many fall into bins of about equal count."""
    df, names = _table(spark, 40_000, 4, parts=3)
    rows = df.selectExpr(f"array({', '.join(names)}) as x")
    ends = forest.cuts(rows, 4)
    assert ends[2].tolist() == [0.0] and not len(ends[3]) and len(ends[0]) == forest.BINS - 1
    values = np.array([r["x"][0] for r in rows.collect()])
    share = np.bincount(np.searchsorted(ends[0], values), minlength=forest.BINS) / len(values)
    assert np.abs(share * forest.BINS - 1).max() < 0.1


@pytest.mark.parametrize("label", ["1.5D", "-1", "cast(null as int)", "100"])
def test_labels_that_are_no_classes_are_refused(spark, label):
    df, names = _table(spark, 50, 4)
    with pytest.raises(ValueError):
        selection.forest_importance(df.selectExpr("id", f"if(id = 7, {label}, label) as label", *names), names, spark_rows=0)


def test_missing_values_are_refused(spark):
    df, names = _table(spark, 50, 4)
    for missing in ("double('NaN')", "cast(null as double)"):
        gaps = df.selectExpr("id", "label", f"if(id = 7, {missing}, c0) as c0", *names[1:])
        with pytest.raises((PySparkException, Py4JJavaError)):
            selection.forest_importance(gaps, names, spark_rows=0)


def test_a_single_tree_may_split_by_all_features_and_none_gives_nothing(spark):
    df, names = _table(spark, 3_000, 5)
    found = [_scores(selection.forest_importance(df, names, trees=1, depth=1, spark_rows=n)) for n in (0, 10_000)]
    assert found[0].tolist() == found[1].tolist() == [1.0, 0.0, 0.0, 0.0, 0.0]
    assert _scores(selection.forest_importance(df.withColumn("label", df.id * 0), names, trees=3, spark_rows=0)).sum() == 0
    assert _scores(selection.forest_importance(df, names, trees=3, depth=0, spark_rows=0)).sum() == 0


def test_all_methods_meet_on_a_large_table(large):
    chosen = selection.select(large[0], "all").filter("selected").toPandas().feature.tolist()
    assert {"c0", "c1"} <= set(chosen) and "c5" not in chosen


def test_a_large_table_is_ranked_with_its_forest(large):
    ranked = selection.feature_importance(large[0], 3).toPandas()
    assert ranked.feature.tolist()[:2] == ["c0", "c1"] and ranked.rf_importance_rank.tolist()[:2] == [1.0, 2.0]
