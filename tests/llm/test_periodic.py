"""Periodic runs against a search over all distances."""

import random

import brute
import numpy as np
import pytest

from starloom.llm import periodic, queries
from starloom.llm.wavelet import WaveletMatrix


@pytest.mark.parametrize("letters", [1, 2, 3, 40])
def test_runs_of_random_words(letters):
    r = random.Random(letters)
    for _ in range(60):
        texts = []
        for _ in range(r.randint(0, 4)):
            w = [r.randrange(letters) for _ in range(r.randint(0, 150))]
            for _ in range(r.randint(0, 3)):
                unit = [r.randrange(letters) for _ in range(r.randint(1, 40))]
                at = r.randint(0, len(w))
                w[at:at] = [unit[j % len(unit)] for j in range(r.randint(len(unit), 6 * len(unit)))]
            texts.append(w)
        first = np.cumsum([0] + [len(w) for w in texts])
        got = periodic.find_runs(np.array([x + 5 for w in texts for x in w], np.uint64), first)
        assert [tuple(x) for x in got.tolist()] == [(k, *run) for k, w in enumerate(texts) for run in brute.runs(w)]


def test_successors():
    values = np.random.default_rng(2).permutation(200)
    m = WaveletMatrix.of(values)
    low, high = np.sort(np.random.default_rng(3).integers(0, 201, (2, 500)), axis=0)
    least = np.random.default_rng(4).integers(0, 300, 500)
    want = [min((v for v in values[a:b].tolist() if v >= c), default=-1) for a, b, c in zip(low, high, least)]
    assert m.successor(low, high, least).tolist() == want


def test_rows_and_digests(spark, docs, texts, nothing):
    clash = docs.withColumnRenamed("verdict", "runs")
    more = [(i, " ".join(f"w{(k * k) % (7 + i)}" for k in range(60 + i)), "s") for i in range(200, 260)]
    more += [(300 + i, "x " + "a b " * 20 + "c d e " * (9 + i) + "y z " * 12, "s") for i in range(12)]
    table = clash.select("doc_id", "text", "runs").unionByName(spark.createDataFrame(more, "doc_id long, text string, runs string"))
    rows = [r[:2] for r in texts] + [r[:2] for r in more]
    want = sorted(brute.periodic(rows), key=repr)
    got = periodic.periodic_runs(table, order=queries.planted_runs).collect()
    assert sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed_text"]) for r in got), key=repr) == want
    assert any(len(r[2]) > 1 for r in want) and periodic.periodic_runs(nothing).count() == 0
    best = periodic.periodic_runs(table, order=queries.planted_runs).select("runs", periodic.strongest("runs").alias("best")).collect()
    for found, one in best:
        assert (tuple(one) if one else None) == min(((r[0], r[1], r[2]) for r in found), key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
