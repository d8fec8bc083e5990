"""Calculators against numpy, and the hot plan against the plain one."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from starloom.functions import complexity, dependence, registry, spectral, tails
from starloom.functions.names import feature
from starloom.operators.series import open_series


def series_of(spark, arrays, block_rows=None):
    rows = pd.concat(
        [pd.DataFrame({"id": i, "time": np.arange(len(x), dtype=float), "flux": x}) for i, x in enumerate(arrays)]
    )
    return open_series(spark.createDataFrame(rows), ["id"], ["time"], block_rows).located(registry.HALO)


def arrays():
    rng = np.random.default_rng(11)
    walk = np.cumsum(rng.standard_normal(700)) * 0.05 + 3
    tied = np.round(rng.exponential(2, 620), 1) + 0.1
    short = rng.standard_normal(60)
    return [walk, tied, short]


@pytest.fixture(scope="module")
def plain(spark):
    return series_of(spark, arrays())


@pytest.fixture(scope="module")
def split(spark):
    return series_of(spark, arrays(), 250)


def by_id(df):
    return df.toPandas().sort_values("id").set_index("id")


@pytest.mark.parametrize("name", list(registry.FAMILIES))
def test_hot_plan_agrees(plain, split, name):
    assert split.hot is not None
    family = registry.FAMILIES[name]
    a, b = by_id(registry.numeric(family(plain), ("id",))), by_id(registry.numeric(family(split), ("id",)))
    pd.testing.assert_frame_equal(a, b[a.columns], rtol=1e-6, atol=1e-8)


def test_autoregression(plain):
    got = by_id(dependence.ar_coefficients(plain))
    for i, x in enumerate(arrays()):
        k = 10
        m = np.column_stack([np.ones(len(x) - k), *[x[k - j : len(x) - j] for j in range(1, k + 1)]])
        want = np.linalg.lstsq(m, x[k:], rcond=None)[0]
        assert np.allclose(got.loc[i].to_numpy(dtype=float), want, atol=1e-6)


def dickey_fuller(x):
    """Plain least squares for every lag, then again on the longest sample."""

    def fit(lag, start):
        d, t = np.diff(x), np.arange(start, len(x) - 1)
        m = np.column_stack([np.ones(len(t)), x[t], *[d[t - j] for j in range(1, lag + 1)]])
        beta, *_ = np.linalg.lstsq(m, d[t], rcond=None)
        rss = ((d[t] - m @ beta) ** 2).sum()
        return m, beta, rss

    top = min(math.ceil(12 * (len(x) / 100) ** 0.25), len(x) // 2 - 2)
    scores = []
    for lag in range(top + 1):
        m, _, rss = fit(lag, top)
        n = len(m)
        scores.append(n * (math.log(2 * math.pi * rss / n) + 1) + 2 * m.shape[1])
    best = int(np.argmin(scores))
    m, beta, rss = fit(best, best)
    se = math.sqrt(rss / (len(m) - m.shape[1]) * np.linalg.inv(m.T @ m)[1, 1])
    return beta[1] / se, best


def test_unit_root(plain):
    got = by_id(dependence.unit_root(plain))
    for i, x in enumerate(arrays()):
        stat, lag = dickey_fuller(x)
        assert got.iloc[i, 0] == pytest.approx(stat, rel=1e-6) and got.iloc[i, 2] == lag
    assert got.iloc[0, 1] > 0.05 > got.iloc[2, 1]


def test_unit_root_pvalues():
    # published 1, 5 and 10 percent points of the statistic with a constant
    for stat, p in ((-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10)):
        assert dependence.unit_root_pvalue(stat) == pytest.approx(p, abs=2e-3)


def phrases(symbols):
    seen, current = set(), ()
    for s in symbols:
        current += (s,)
        if current not in seen:
            seen.add(current)
            current = ()
    return len(seen)


def test_phrase_complexity(plain):
    got = by_id(complexity.lempel_ziv(plain))
    for i, x in enumerate(arrays()):
        for bins in complexity.LZ_BINS:
            edges = np.linspace(x.min(), x.max(), bins + 1)[1:]
            want = phrases(np.searchsorted(edges, x).tolist()) / len(x)
            assert got.loc[i, feature("lempel_ziv_complexity", bins=bins)] == pytest.approx(want)


def test_entropies(plain):
    got = by_id(complexity.template_entropies(plain))
    for i, x in enumerate(arrays()):
        r = 0.2 * x.std()

        def matches(m):
            t = np.lib.stride_tricks.sliding_window_view(x, m)
            return (np.abs(t[:, None] - t[None]).max(axis=2) <= r).sum(axis=1)

        two, three = matches(2), matches(3)
        phi = [np.log(c / len(c)).mean() for c in (two, three)]
        assert got.loc[i, feature("approximate_entropy", m=2, r=0.2)] == pytest.approx(abs(phi[0] - phi[1]))
        sample, pairs = got.loc[i, feature("sample_entropy")], three.sum() - len(three)
        if pairs:
            assert sample == pytest.approx(-math.log(pairs / (two.sum() - len(two))))
        else:
            assert np.isnan(sample)


def test_drift(plain):
    got = by_id(registry.FAMILIES["drift"](plain))
    x = arrays()[0]
    signal, step = x[:-1], np.diff(x)
    inner = np.quantile(signal, [i / 30 for i in range(1, 30)])
    cell = np.searchsorted(inner, signal)
    groups = pd.DataFrame({"c": cell, "x": signal, "d": step}).groupby("c").mean()
    want = np.polyfit(groups.x, groups.d, 3)
    assert np.allclose(got.iloc[0, :4].to_numpy(dtype=float), want)


def test_constant_and_tiny_series(spark):
    s = series_of(spark, [np.full(50, 2.0), np.array([1.5]), np.array([1.0, 2.0])])
    found = registry.impute(registry.extract(s, "comprehensive"), ["id"]).toPandas()
    assert len(found) == 3
    assert np.isfinite(found.drop(columns="id").to_numpy(dtype=float)).all()
    assert found.shape[1] > 780


def test_transit_lowers_the_minimum(spark):
    rng = np.random.default_rng(1)
    t = np.linspace(0, 10, 1000)
    flat = 1 + 0.001 * rng.standard_normal(1000)
    dipped = np.where(np.abs(t - 5) < 0.05, flat - 0.01, flat)
    got = by_id(registry.FAMILIES["moments"](series_of(spark, [flat, dipped])))
    assert got.loc[1, feature("minimum")] < got.loc[0, feature("minimum")]


def test_minimal_set(plain):
    found = registry.extract(plain, "minimal")
    assert len(found.columns) == 1 + sum(len(c) for c in registry.MINIMAL.values())
    assert found.count() == 3


def test_long_spectrum(spark):
    x = np.random.default_rng(5).standard_normal(997)
    rows = spark.createDataFrame(pd.DataFrame({"id": 1, "pos": np.arange(997), "flux": x}))
    got = spectral.long_spectrum(rows, "id").toPandas().sort_values("k")
    assert np.allclose(got.re + 1j * got.im, np.fft.rfft(x))


def test_register(plain):
    registry.register("range_width", lambda s: s.per_key((F.max("flux") - F.min("flux")).alias("flux__range_width")))
    try:
        with pytest.raises(ValueError):
            registry.register("range_width", lambda s: s)
        found = by_id(registry.extract(plain, {"range_width": None}))
        assert np.allclose(found.flux__range_width, [np.ptp(x) for x in arrays()])
    finally:
        del registry.FAMILIES["range_width"]
        for chosen in ("efficient", "comprehensive"):
            del registry.FEATURE_SETS[chosen]["range_width"]


def test_impute(spark):
    rows = spark.createDataFrame(
        [(1, 1.0, float("inf"), None), (2, float("nan"), 4.0, None), (3, 3.0, float("-inf"), float("nan")), (4, 8.0, 2.0, None)],
        "id int, a double, b double, c double",
    )
    got = registry.impute(rows, ["id"]).orderBy("id").toPandas()
    assert got.a.tolist() == [1, 3, 3, 8] and got.b.tolist() == [4, 4, 2, 2] and got.c.tolist() == [0, 0, 0, 0]


def test_tails():
    assert tails.f_tail(1.6834860324630179, 1, 498) == pytest.approx(0.19506258862761494, rel=1e-9)
    assert tails.t_tail(2.0, 10) == pytest.approx(0.07338803477, rel=1e-6)
    assert tails.beta_inc(2, 3, 0.4) == pytest.approx(0.5248, rel=1e-9)
    assert tails.normal_cdf(1.959963985) == pytest.approx(0.975, abs=1e-9)


@pytest.mark.parametrize("block", [None, 60])
@pytest.mark.parametrize("normalize", [True, False])
def test_query_similarity(spark, block, normalize):
    from starloom.functions.similarity import distances, query_similarity

    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=300) + 1e5, np.full(30, 1e5), rng.normal(size=100) + 1e5])
    query = (x[40:48] + rng.normal(size=8) * 0.1).tolist()

    def plain(w):
        a, b = np.asarray(w), np.asarray(query)
        if normalize:
            a, b = ((v - v.mean()) / v.std() if v.std() > 0 else v * 0 for v in (a, b))
        return np.sqrt(np.square(a - b).sum())

    want = np.array([plain(x[i : i + 8]) for i in range(len(x) - 7)])
    assert np.allclose(distances(x, np.array(query), normalize), want, atol=1e-5)
    pdf = pd.DataFrame({"id": ["a"] * len(x) + ["b"] * 5, "time": np.arange(len(x) + 5.0), "flux": np.concatenate([x, x[:5]])})
    limit = float(np.sort(want)[12:14].mean())
    got = query_similarity(open_series(spark.createDataFrame(pdf), ["id"], ["time"], block), query, limit, normalize).toPandas().set_index("id").iloc[:, 0]
    assert got["a"] == 13 and got["b"] == 0


def test_short_series_share_a_call(spark):
    """Many short blocks go to one call, without copies that their windows do not need, and keep their own counts."""
    from starloom.functions import similarity

    rng = np.random.default_rng(9)
    ids = rng.permutation(np.repeat(np.arange(70), np.arange(1, 71)))
    pdf = pd.DataFrame({"id": [f"s{i}" for i in ids], "time": np.arange(len(ids) * 1.0), "flux": rng.normal(size=len(ids))})
    query, rows = [0.0, 1.0, 3.0, 1.0], spark.createDataFrame(pdf)
    want = {i: int((similarity.distances(v.to_numpy(), np.array(query)) <= 1.5).sum()) for i, v in pdf.groupby("id")["flux"]}
    for block in (None, 16):
        s = open_series(rows, ["id"], ["time"], block).located(20)
        dealt = similarity._blocks(s, 3).toPandas()
        assert dealt["_call"].nunique() == 1 and dealt["_own"].sum() == len(ids)
        blocks = dealt.groupby(["id", "_block"])["_own"].agg(["any", "size", "sum"])
        assert blocks["any"].all() and (blocks["size"] - blocks["sum"]).max() <= 3
        got = dict(similarity.query_similarity(s, query, 1.5).collect())
        assert got == want and sum(got.values()) > 20


def test_unit_root_in_parts_of_the_design(spark, monkeypatch):
    """Few design rows at a time give the products of all of them."""
    walk = np.cumsum(np.random.default_rng(11).normal(size=400))
    pdf = pd.DataFrame({"id": np.arange(400) // 200, "time": np.arange(400.0), "flux": walk})
    s = open_series(spark.createDataFrame(pdf), ["id"], ["time"]).located()
    want = sorted(dependence.unit_root(s).collect())
    monkeypatch.setattr(dependence, "DESIGN_ROWS", 7)
    got = sorted(dependence.unit_root(s).collect())
    assert len(got) == 2 and all(np.allclose(a, b, rtol=1e-9) for a, b in zip(got, want))
    x = walk[:200] / 3
    assert (dependence._design(x, 60, 70, 5)[:, 2] == np.diff(x)[59:69]).all()


def test_long_transforms_share_calls(spark, monkeypatch):
    """Series of many lengths through few calls of two rounds, and lines of one through several, against numpy."""
    rng = np.random.default_rng(12)
    sizes = [1, 2, 5, 33, 64, 150, 700]
    pdf = pd.concat([pd.DataFrame({"id": f"s{n}", "pos": np.arange(n), "flux": rng.normal(size=n)}) for n in sizes])
    df = spark.createDataFrame(pdf)
    for rows in (512, spectral.LINE_ROWS):
        monkeypatch.setattr(spectral, "LINE_ROWS", rows)
        got = spectral.long_spectrum(df, "id").toPandas().sort_values(["id", "k"])
        for n in sizes:
            one, want = got[got["id"] == f"s{n}"], np.fft.fft(pdf["flux"][pdf["id"] == f"s{n}"])[: n // 2 + 1]
            assert np.allclose(one["re"] + 1j * one["im"], want, atol=1e-9)
    calls = spectral._four_steps(df.selectExpr("id", "1L as n", "16L as m1", "64L as m2", "0 as ch", "pos as t", "flux as re", "0D as im"), "id", 3)
    assert calls.count() == len(sizes) * 1024
