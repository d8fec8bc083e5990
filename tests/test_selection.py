"""Selection and ranking on seeded matrices, against numpy and brute force."""

import math
from itertools import product

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from starloom.operators import columns, selection
from starloom.operators.information import neighbour_information


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(42)
    pdf = pd.DataFrame(rng.standard_normal((100, 20)), columns=[f"feature_{i}" for i in range(20)])
    label = rng.integers(0, 2, 100)
    pdf["feature_3"] += 1.5 * label
    pdf["correlated_1"] = pdf.feature_0 + 0.01 * rng.standard_normal(100)
    pdf["correlated_2"] = pdf.feature_1 + 0.01 * rng.standard_normal(100)
    pdf["constant"] = 1.0
    pdf["flag"] = np.where(rng.random(100) < 0.9, label, 1 - label).astype(float)
    pdf.insert(0, "label", label)
    pdf.insert(0, "id", range(100))
    return pdf


@pytest.fixture(scope="module")
def matrix(spark, frame):
    return spark.createDataFrame(frame)


def test_copies_of_features_go(matrix):
    names = selection.feature_names(matrix)
    kept = selection.uncorrelated(matrix, names, 0.95)
    assert [n for n in names if n not in kept] == ["correlated_1", "correlated_2"]


@pytest.mark.parametrize("method", ["mutual_info", "f_test", "random_forest"])
def test_top_k(matrix, method):
    found = selection.select(matrix, method, k=10).toPandas()
    assert found.selected.sum() == 10
    assert found.set_index("feature").selected["feature_3"]


def test_all_methods_meet(matrix):
    chosen = selection.select(matrix, "all").filter("selected").toPandas().feature.tolist()
    assert "feature_3" in chosen and "flag" in chosen and "constant" not in chosen


def test_unknown_method(matrix):
    with pytest.raises(ValueError):
        selection.select(matrix, "guess")


def test_missing_label(matrix):
    with pytest.raises(ValueError):
        selection.feature_names(matrix.drop("label"))


def test_batch_number_is_no_feature(matrix):
    assert "batch_index" not in selection.feature_names(matrix.withColumn("batch_index", F.lit(1)))


def test_relevance_types(matrix, frame):
    found = selection.relevance(selection.long_form(matrix, selection.feature_names(matrix))).toPandas().set_index("feature")
    assert found.type["constant"] == "constant" and not found.relevant["constant"]
    assert found.type["flag"] == "binary" and found.relevant["flag"]
    assert found.type["feature_3"] == "real" and found.relevant["feature_3"]


def test_several_classes(spark):
    rng = np.random.default_rng(2)
    label = rng.integers(0, 3, 300)
    pdf = pd.DataFrame({"id": range(300), "label": label, "a": label == 2, "b": rng.standard_normal(300)})
    pdf["a"] = pdf.a + 0.1 * rng.standard_normal(300)
    long = selection.long_form(spark.createDataFrame(pdf), ["a", "b"])
    found = selection.relevance(long).toPandas().set_index("feature").relevant
    assert found["a"] and not found["b"]


def test_rank_sums_with_ties(spark):
    rng = np.random.default_rng(9)
    value, label = rng.integers(0, 6, 80), rng.integers(0, 2, 80)
    long = spark.createDataFrame(pd.DataFrame({"feature": "x", "value": value.astype(float), "label": label}))
    got = selection.rank_sums(long).first()
    pairs = [(a > b) + 0.5 * (a == b) for a, b in product(value[label == 1], value[label == 0])]
    assert got["u"] == pytest.approx(sum(pairs))


def test_mean_ranks_share_ties(spark):
    scores = spark.createDataFrame([("a", 3.0), ("b", 3.0), ("c", 9.0), ("d", 1.0)], "feature string, s double")
    got = selection.average_rank(scores, ["s"]).toPandas().set_index("feature").s_rank
    assert got.to_dict() == {"a": 2.5, "b": 2.5, "c": 1.0, "d": 4.0}


def test_exact_test():
    # the lady tasting tea, two-sided
    assert selection.hypergeometric_tail(3, 1, 1, 3) == pytest.approx(34 / 70)
    total = math.comb(20, 8)
    given = math.comb(10, 7) * math.comb(10, 1)
    want = sum(p for k in range(9) if (p := math.comb(10, k) * math.comb(10, 8 - k)) <= given) / total
    assert selection.hypergeometric_tail(7, 3, 1, 9) == pytest.approx(want)


def test_discovery_control(spark):
    p = [0.0001, 0.004, 0.019, 0.0095, 0.2, 0.9]
    rows = spark.createDataFrame([(f"f{i}", v) for i, v in enumerate(p)], "feature string, p_value double")
    got = selection.false_discoveries(rows, 0.05).toPandas().set_index("feature").relevant
    m, c = len(p), sum(1 / i for i in range(1, len(p) + 1))
    order = np.argsort(p)
    last = max([r for r, i in enumerate(order, 1) if p[i] <= r * 0.05 / (m * c)], default=0)
    assert got.sum() == last and all(got[f"f{i}"] for i in order[:last])


def test_golden_f_test(spark):
    from starloom.plans import selection_queries

    found = selection.f_test(selection_queries.matrix(spark, "/root/testdata/sf0.01"), selection_queries.NAMES).filter("feature = 'f0'").first()
    assert found["f_score"] == pytest.approx(1.6834860324630179)
    assert found["p_value"] == pytest.approx(0.19506258862761494)


def test_select_and_save(spark, matrix, tmp_path):
    out, info = str(tmp_path / "out"), str(tmp_path / "info")
    stats = selection.select_and_save(matrix, out, info, method="f_test", k=4).first()
    assert stats["n_selected"] == 4 and spark.read.parquet(out).columns[:2] == ["id", "label"]
    assert spark.read.json(info).filter("selected").count() == 4


def _matrix(spark, n, width, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)).round(1)
    x[:, 1] = x[:, 0] * 2 + rng.normal(size=n) * 0.01
    x[:, 2] = 1e9 + x[:, 0]
    x[:, 3] = 7.0
    x[rng.random(x.shape) < 0.05] = np.nan
    label = (np.nan_to_num(x[:, 0]) > 0.3).astype(int) + (rng.random(n) < 0.2)
    label[0] = 9
    pdf = pd.DataFrame(x, columns=[f"c{i}" for i in range(width)]).assign(id=np.arange(n), label=label)
    return pdf, spark.createDataFrame(pdf).repartition(7)


def test_tiles_give_every_pair_once(spark, monkeypatch):
    monkeypatch.setattr(columns, "TILE", 4)
    monkeypatch.setattr(columns, "FAN", 2)
    pdf, df = _matrix(spark, 300, 10)
    names = [f"c{i}" for i in range(10)]
    got = {(r["earlier"], r["feature"]): r["corr"] for r in selection.correlations(df, names).collect()}
    want = pdf[names].corr()
    assert len(got) == 45
    for (a, b), c in got.items():
        assert (c is None) == np.isnan(want.loc[a, b]) and (c is None or abs(c - want.loc[a, b]) < 1e-6)
    strong = {(r["earlier"], r["feature"]) for r in selection.correlations(df, names, 0.9).collect()}
    assert strong == {p for p, c in got.items() if c is not None and abs(c) > 0.9} == {("c0", "c1"), ("c0", "c2"), ("c1", "c2")}
    assert selection.correlations(df.limit(0), names, 0.5).count() == 0


def _plain_information(v, c, k=3):
    from math import inf

    psi = lambda n: sum(1 / i for i in range(1, n)) - 0.5772156649015329
    keep = [i for i in range(len(v)) if list(c).count(c[i]) > 1]
    v, c, total = v[keep], c[keep], 0.0
    for i in range(len(v)):
        own = np.sort(np.abs(np.delete(v[c == c[i]], np.flatnonzero(np.flatnonzero(c == c[i]) == i)[0]) - v[i]))
        near = min(k, len(own))
        r = own[near - 1]
        m = int((np.abs(v - v[i]) < r).sum() if r > 0 else (v == v[i]).sum())
        total += psi(near) - psi(len(own) + 1) - psi(m)
    return max(0.0, psi(len(v)) + total / len(v)) if len(v) else inf


@pytest.mark.parametrize("block", [None, 40])
def test_information_by_neighbours(spark, block):
    """Ties, missing values, a class of one sample, a constant column."""
    pdf, df = _matrix(spark, 220, 5)
    names = [f"c{i}" for i in range(5)]
    got = {r["feature"]: r["mutual_info"] for r in neighbour_information(df, names, block_rows=block).collect()}
    for n in names:
        there = np.isfinite(pdf[n].to_numpy())
        assert got[n] == pytest.approx(_plain_information(pdf[n].to_numpy()[there], pdf.label.to_numpy()[there]), abs=1e-9)


def test_moments_of_classes(spark):
    pdf, df = _matrix(spark, 200, 6)
    got = {(r["feature"], r["label"]): r for r in columns.class_moments(df, [f"c{i}" for i in range(6)]).collect()}
    for (name, label), r in got.items():
        part = pdf.loc[pdf.label == label, name].dropna()
        assert r["n"] == len(part) and r["m"] == pytest.approx(part.mean()) and r["v"] == pytest.approx(part.var(ddof=0), abs=1e-6)


def test_forest_grows_in_parts_that_the_driver_can_hold(matrix, monkeypatch):
    """All trees are grown, few at once; one part is the forest as it was."""
    sizes, plain = [], selection.RandomForestClassifier

    def recorded(**options):
        sizes.append((options["numTrees"], options["seed"]))
        return plain(**options)

    monkeypatch.setattr(selection, "RandomForestClassifier", recorded)
    names = selection.feature_names(matrix)
    parts = selection.forest_importance(matrix, names, trees=25, depth=5, tree_rows=1000).toPandas()
    assert [n for n, _ in sizes] == [10, 10, 5] and len({seed for _, seed in sizes}) == 3
    assert parts.rf_importance.sum() == pytest.approx(1.0)
    assert parts.rf_importance.idxmax() == parts.index[parts.feature == "flag"][0]
    sizes.clear()
    whole = selection.forest_importance(matrix, names, trees=25, depth=5).toPandas()
    assert sizes == [(25, 42)]
    assert np.abs(whole.rf_importance - parts.rf_importance).max() < 0.1
