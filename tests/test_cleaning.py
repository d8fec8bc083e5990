import numpy as np
import pandas as pd
import pytest

from starloom.operators import cleaning
from starloom.operators.series import open_series
from starloom.plans import bindings


def cleaned(spark, pdf, **options):
    return cleaning.preprocess(spark.createDataFrame(pdf), **options).rows().toPandas().sort_values(["id", "time"])


def test_invalid_samples_go(spark, curve):
    curve.loc[10:14, "flux"] = np.nan
    curve.loc[20:24, "time"] = np.nan
    curve.loc[30, "flux"] = 0.0
    curve.loc[31, "flux"] = np.inf
    out = cleaning.valid_samples(spark.createDataFrame(curve)).toPandas()
    assert len(out) == 988
    assert np.isfinite(out[["time", "flux"]].to_numpy()).all()


def test_outliers_go(spark, curve):
    curve.loc[50, "flux"] = 10.0
    curve.loc[100, "flux"] = -5.0
    out = cleaned(spark, curve, detrend_flux=False)
    assert len(out) < 1000 and out.flux.max() < 10 and out.flux.min() > -5


@pytest.mark.parametrize("method", cleaning.NORMALISATIONS)
def test_normalise(spark, curve, method):
    flux = cleaned(spark, curve, detrend_flux=False, normalize_method=method).flux
    if method == "median":
        assert abs(flux.median() - 1) < 1e-9
    elif method == "mean":
        assert abs(flux.mean() - 1) < 1e-9
    else:
        assert flux.min() == 0 and flux.max() == 1


def test_unknown_method_is_refused(spark, curve):
    with pytest.raises(ValueError):
        cleaned(spark, curve, normalize_method="mode")


def test_detrend_lowers_spread(spark, curve):
    curve["flux"] += 0.001 * curve.time
    flat = cleaned(spark, curve, detrend_flux=True).flux.std()
    raw = cleaned(spark, curve, detrend_flux=False).flux.std()
    assert flat < raw


def savgol(x, width, order):
    """Local polynomial fits by least squares, the ends from the end windows."""
    half, n, out = width // 2, len(x), np.empty(len(x))
    t = np.arange(width)
    for i in range(n):
        start = min(max(i - half, 0), n - width)
        fit = np.polynomial.Polynomial.fit(t, x[start : start + width], order)
        out[i] = fit(i - start)
    return out


@pytest.mark.parametrize("block_rows", [None, 200])
@pytest.mark.parametrize("width", [100, 101, 31])
def test_detrend_equals_local_fits(spark, curve, block_rows, width):
    s = open_series(spark.createDataFrame(curve), ["id"], ["time"], block_rows)
    got = cleaning.detrend(s, width, 3).rows().toPandas().sort_values("time").flux.to_numpy()
    x = curve.flux.to_numpy()
    want = x - savgol(x, width + (width % 2 == 0), 3) + np.median(x)
    assert np.allclose(got, want, atol=1e-10)


def test_detrend_leaves_short_series(spark, curve):
    s = open_series(spark.createDataFrame(curve.head(100)), ["id"], ["time"])
    got = cleaning.detrend(s, 101, 3).rows().toPandas().sort_values("time").flux
    assert np.allclose(got, curve.flux.head(100))


def test_constant_series_is_rejected_or_kept(spark, curve):
    curve["flux"] = 2.0
    assert len(cleaned(spark, curve, detrend_flux=False)) == 0
    assert len(cleaned(spark, curve, detrend_flux=False, on_zero_mad="keep")) == 1000
    why = cleaning.rejected(spark.createDataFrame(curve)).toPandas()
    assert why.reason.tolist() == ["mad_zero"]


@pytest.mark.parametrize("n, kept", [(99, 0), (100, 100)])
def test_gate_is_inclusive(spark, curve, n, kept):
    s = open_series(spark.createDataFrame(curve.head(n)), ["id"], ["time"])
    assert cleaning.minimum_points(s, 100).rows().count() == kept


@pytest.mark.parametrize("block_rows", [None, 150])
def test_gaps_are_resampled(spark, curve, block_rows):
    holed = curve.drop(index=range(300, 340)).reset_index(drop=True)
    holed = pd.concat([holed, holed.iloc[[5, 700]]])
    s = open_series(spark.createDataFrame(holed), ["id"], ["time"], block_rows)
    got = cleaning.interpolate_gaps(s, 0.5).rows().toPandas().sort_values("time")
    base = holed.groupby("time").flux.mean()
    t = base.index.to_numpy()
    step = np.median(np.diff(t))
    grid = t[0] + step * np.arange(np.ceil((t[-1] - t[0]) / step))
    assert np.allclose(got.time, grid) and np.allclose(got.flux, np.interp(grid, t, base.to_numpy()))


@pytest.mark.parametrize("block_rows", [None, 150])
def test_series_without_gap_stays(spark, curve, block_rows):
    s = open_series(spark.createDataFrame(curve), ["id"], ["time"], block_rows)
    got = cleaning.interpolate_gaps(s, 0.5).rows().toPandas().sort_values("time")
    assert np.allclose(got.flux, curve.flux)


def test_quality_counts_all_rows(spark, curve):
    curve.loc[0:99, "flux"] = np.nan
    q = cleaning.quality_metrics(open_series(spark.createDataFrame(curve), ["id"], ["time"])).toPandas().iloc[0]
    x = curve.flux.dropna()
    assert q.n_points == 900 and abs(q.completeness - 0.9) < 1e-12
    assert abs(q.snr - x.median() / x.std(ddof=0)) < 1e-9
    assert abs(q.mad_flux - (x - x.median()).abs().median()) < 1e-12


@pytest.mark.parametrize(
    "columns, values, admitted",
    [
        ("id string, time double, flux double", [("a", 1.0, float("nan")), ("a", 2.0, 5.0)], True),
        ("id string, time double", [("a", 1.0)], False),
        ("id string, time double, flux double", [("a", 1.0, float("nan"))], False),
    ],
)
def test_admission(spark, columns, values, admitted):
    assert cleaning.admission(spark.createDataFrame(values, columns)).first()["admitted"] is admitted


def test_hot_plan_equals_plain_plan(spark, sf_dir):
    """A key with most of the rows goes through blocks and must agree."""
    raw = bindings.lineitem_series(spark, sf_dir)
    skewed = raw.selectExpr("case when id % 3 = 0 then 0 else id end as id", "* except (id)")
    plain = cleaning.preprocess(skewed, bindings.S2_ORDER, min_valid_points=50).rows()
    split = cleaning.preprocess(skewed, bindings.S2_ORDER, min_valid_points=50, block_rows=300).rows()
    by = ["id", *bindings.S2_ORDER]
    a = plain.toPandas().sort_values(by).reset_index(drop=True)
    b = split.toPandas().sort_values(by).reset_index(drop=True)[a.columns]
    assert len(a) > 4000
    pd.testing.assert_frame_equal(a, b, rtol=1e-9)
