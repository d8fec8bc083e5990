"""State of streams over several batches, and sketches against exact ranks."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from starloom.streaming import stateful, streams

SCHEMA = "service string, ts timestamp, event_id long, value double"
START = dt.datetime(2024, 1, 1)


def sample(service, minute, event_id=0, value=1.0):
    return (service, START + dt.timedelta(minutes=minute), event_id, value)


def run(spark, tmp_path, batches, build, schema=SCHEMA):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    seen = []
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        with stateful.state_store(spark):
            found = streams.drain(build(streams.file_stream(spark, source, spark.createDataFrame([], schema).schema)), out, checkpoint)
        seen.append(sorted(tuple(r) for r in found.collect()))
    return seen


def test_a_service_that_sends_nothing_alerts_once(spark, tmp_path):
    """a goes silent between two samples of a batch, b between batches (told by the timer, not again by the sample), c for good."""
    batches = [
        [sample("a", 0), sample("a", 5), sample("b", 0), sample("c", 1), sample("c", 0, 7)],
        [sample("a", m) for m in range(6, 20)],
        [sample("b", 30), sample("b", 30, 1), sample("b", -9), sample("a", 20), sample("a", 33)],
    ]
    seen = run(spark, tmp_path, batches, lambda s: stateful.absent_services(s, 120.0, "1 minute").select("service", F.date_format("last", "mm")))
    assert seen[0] == [("a", "00"), ("b", "00"), ("c", "01")]
    assert seen[1] == seen[0]
    assert seen[2] == [("a", "00"), ("a", "20"), ("b", "00"), ("b", "30"), ("c", "01")]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != stateful.PROVIDER


def test_counters_go_on_over_batches(spark, tmp_path):
    batches = [[sample("a", 0, value=10.0), sample("a", 1, value=15.0)], [sample("a", 2, value=2.0), sample("a", 1, 1, value=16.0)], [sample("b", 300), sample("a", 3, value=9.0)], [sample("b", 301)]]
    seen = run(spark, tmp_path, batches, lambda s: stateful.sliding_rate(s, "value", "2 minutes", "1 minute", 120.0, "1 minute").select(F.date_format("window_start", "HH:mm"), "service", "rate"))
    got = {(t, s): round(rate * 120, 6) for t, s, rate in seen[-1]}
    assert got[("00:00", "a")] == 6.0 and got[("00:01", "a")] == 5.0 + 1.0 + 2.0 and got[("00:02", "a")] == 2.0 + 7.0


def test_ratios_in_time(spark, tmp_path):
    schema = "pod string, ts timestamp, usage double, limit double"
    rows = [("p", START, None, 10.0), ("p", START + dt.timedelta(minutes=3), 9.5, None), ("p", START + dt.timedelta(minutes=8), 9.9, None), ("q", START, 99.0, None)]

    def build(s):
        return stateful.ratio_alerts(s.filter("usage is not null").drop("limit"), s.filter("limit is not null").drop("usage"), ["pod"], 0.9, "5 minutes", "1 minute").select("pod", "usage", "ratio")

    assert run(spark, tmp_path, [rows[:1], rows[1:]], build, schema)[-1] == [("p", 9.5, 0.95)]


def test_ranks_of_sketched_percentiles(spark):
    values = np.random.default_rng(3).lognormal(0, 2, 40_000)
    rows = spark.createDataFrame([(START, float(v)) for v in values] + [(START, None)], "ts timestamp, value double").repartition(7)
    got = stateful.window_percentiles(rows, "1 hour", [], "value", "1 minute").first()
    assert got["n"] == len(values)
    for name, p in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
        assert abs((values <= got[name]).mean() - p) < 2.5 / 400
    none = stateful.window_percentiles(rows.filter("value is null"), "1 hour", [], "value", "1 minute").first()
    assert none["n"] == 0 and none["p50"] is None


class Kept:
    """A value of state that stays in memory."""

    def __init__(self, value=None):
        self.value = value

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def test_a_small_batch_costs_no_frames(spark):
    """Samples in order of time and id, seen ones dropped; a batch without an alert gives no empty frame."""
    runs = stateful.HeldRuns(5e-6, "string")
    runs.state = Kept()
    part = pd.DataFrame({"us": [3, 1, 3, 2], "event_id": ["b", "a", None, "a"], "value": [True, True, True, True]})
    assert list(runs.handleInputRows(("s",), iter([part.iloc[:2], part.iloc[2:]]), None)) == []
    assert runs.state.value[0] == 3 and runs.state.value[2:] == (1, False)
    numbers = pd.DataFrame({"us": [9, 3, 3, 1], "event_id": [1, 5, 4, 9], "value": [1.0, 2.0, 3.0, 4.0]})
    us, ids, values = stateful.new_samples([[numbers[c].to_numpy() for c in numbers]], (3, 4))
    assert (us.tolist(), ids.tolist(), values.tolist()) == ([3, 9], [5, 1], [2.0, 1.0])
    runs.state = Kept((3, "b", 1, False))
    later = pd.DataFrame({"us": [9, 3], "event_id": ["a", "a"], "value": [True, False]})
    found = list(runs.handleInputRows(("s",), iter([later]), None))
    assert [f.values.tolist() for f in found] == [[["s", 1]]] and runs.state.value == (9, "a", 1, True)
