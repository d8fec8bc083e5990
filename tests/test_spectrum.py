"""Fast periodograms against direct sums."""

import numpy as np
import pandas as pd
import pytest

from starloom.operators import assess, spectrum
from starloom.operators.series import open_series
from starloom.operators.spectrum import Grid, fast_periodogram


def test_waves_equal_direct_sums():
    rng = np.random.default_rng(2)
    grid, phase, weights = Grid(700), rng.random(300), rng.normal(size=(2, 300))
    phase[:3] = 0.0, 1 - 1e-12, 0.5
    want = weights @ np.exp(2j * np.pi * np.outer(phase, np.arange(701)))
    assert np.abs(grid.waves(grid.spread(phase, weights)) - want).max() < 1e-8


@pytest.mark.parametrize("block", [None, 50])
def test_powers_equal_the_plain_plan(spark, block):
    rng = np.random.default_rng(5)
    t = np.sort(rng.uniform(1e4, 1e4 + 90, 260))
    pdf = pd.DataFrame({"id": np.where(np.arange(260) % 4 == 0, "a", "b"), "time": t, "flux": 3e4 + np.sin(2 * np.pi * 0.61 * t) + rng.normal(size=260)})
    pdf = pd.concat([pdf, pd.DataFrame({"id": ["c"], "time": [1.0], "flux": [2.0]})])
    s = open_series(spark.createDataFrame(pdf), ["id"], ["time"], block)
    assert (s.hot is None) == (block is None)
    got = {(r["id"], round(r["frequency"], 6)): r["power"] for r in fast_periodogram(s, 0.05, 60).collect()}
    want = assess.periodogram(open_series(spark.createDataFrame(pdf), ["id"], ["time"]), [0.05 * k for k in range(1, 61)]).collect()
    assert len(got) == 180 and all(got["c", round(0.05 * k, 6)] is None for k in range(1, 61))
    for r in want:
        if r["id"] != "c":
            assert got[r["id"], round(r["frequency"], 6)] == pytest.approx(r["power"], abs=1e-7)


def test_many_frequencies_find_the_wave(spark):
    t = np.random.default_rng(1).uniform(0, 400, 3000)
    pdf = pd.DataFrame({"id": 1, "time": t, "flux": np.cos(2 * np.pi * 7.313 * t)})
    found = fast_periodogram(open_series(spark.createDataFrame(pdf), ["id"], ["time"]), 0.001, 10_000)
    top = assess.periodogram_peaks(found, ["id"], 1).first()
    assert top["frequency"] == pytest.approx(7.313) and top["power"] > 0.999 and found.count() == 10_000


@pytest.mark.parametrize("block", [None, 50])
def test_only_the_strongest_powers_leave_a_task(spark, block, monkeypatch):
    """The ranks are those of all powers, also where a hot series comes in many pieces."""
    monkeypatch.setattr(spectrum, "PIECE_ROWS", 10)
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"id": np.arange(700) % 5 // 2, "time": rng.uniform(0, 60, 700), "flux": rng.normal(size=700)})
    pdf = pd.concat([pdf, pd.DataFrame({"id": [9], "time": [1.0], "flux": [2.0]})])
    s = open_series(spark.createDataFrame(pdf), ["id"], ["time"], block)
    few = fast_periodogram(s, 0.05, 80, strongest=3)
    assert few.count() == 4 * 3
    got, want = ({(r["id"], r["rank"]): r for r in assess.periodogram_peaks(p, ["id"], 3).collect()} for p in (few, fast_periodogram(s, 0.05, 80)))
    assert {k: r["frequency"] for k, r in got.items()} == {k: r["frequency"] for k, r in want.items()}
    assert [spectrum.strongest_of(np.array(v), 2).tolist() for v in ([1, np.nan, 3, 3], [np.nan, 1, np.nan], [2])] == [[2, 3], [1, 0], [0]]


def test_box_search_folds_in_the_task_of_a_series(spark, capsys):
    """No row per sample and period moves, and both plans find the same boxes."""
    rng = np.random.default_rng(4)
    t = rng.uniform(0, 40, 900)
    flux = rng.normal(size=900) - 4 * ((t / 2.5) % 1 < 0.1)
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(900) % 7 // 3, "time": t, "flux": flux}))
    plain, split = (open_series(df, ["id"], ["time"], b) for b in (None, 200))
    assert plain.hot is None and split.hot is not None
    found = assess.box_search(plain, [1.0, 2.5, 3.75], bins=20)
    found.explain()
    assert "Generate" not in capsys.readouterr().out
    got, want = (sorted(tuple(round(v, 9) for v in r) for r in p.collect()) for p in (found, assess.box_search(split, [1.0, 2.5, 3.75], bins=20)))
    assert got == want and len(got) == 3 and all(r[1] == 2.5 for r in got)
