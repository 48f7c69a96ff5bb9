"""Alerts on a stream against the batch alerts over the same rows."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from conftest import as_set
from pyspark.sql import functions as F

from tallyforge.operators import series
from tallyforge.sources.requests import read_requests, write_table
from tallyforge.streaming.alerts import ALERTS, AlertProcessor, start_alerts

START = datetime(2024, 1, 1)
BATCH = {
    "rejection_rate": (series.alert_rejection_rate, {"threshold": 0.3, "hold": "3 minutes"}),
    "compute_units": (series.alert_compute_units, {"threshold": 0.2, "hold": "4 minutes"}),
    "server_errors": (series.alert_server_errors, {"threshold": 0.2, "window": "6 minutes", "step": "4 minutes", "hold": "8 minutes"}),
    "429_spike": (series.alert_429_spike, {"threshold": 0.01}),
}


def rows(seed=3, n=1500, span=7200):
    """Bursts of faults, a consumer that falls silent for half an hour, and one with a single request."""
    draw = random.Random(seed)
    found = [{"event_time": START + timedelta(seconds=5000), "consumer_id": "once", "status_code": 429}]
    for _ in range(n):
        second = draw.randrange(span)
        consumer = draw.choice(["a", "b", "c"])
        if consumer == "b" and 2000 < second < 3800:
            continue
        bad = (second // 900) % 2 == 0 and draw.random() < 0.6
        found.append(
            {
                "event_time": START + timedelta(seconds=second),
                "consumer_id": consumer,
                "route_name": f"r{second % 2}",
                "status_code": draw.choice([429, 502]) if bad else 200,
                "compute_units": draw.choice([1, 5, 20]),
            }
        )
    return sorted(found, key=lambda r: r["event_time"])


@pytest.mark.parametrize("name", BATCH)
def test_stream_alerts_equal_batch_alerts(spark, make_log, tmp_path, name):
    source, out, log = str(tmp_path / "log"), str(tmp_path / "out"), rows()
    for i in range(3):  # three deliveries, each taken up where the last run stopped
        write_table(make_log(log[i * len(log) // 3 : (i + 1) * len(log) // 3]).coalesce(1), source, "requests", mode="append")
        operator, changed = BATCH[name]
        stream = read_requests(spark, source, stream=True)
        start_alerts(stream, name, out, str(tmp_path / "state"), available_now=True, partitions=2, **changed).awaitTermination()
    closed = max(r["event_time"] for r in log) - timedelta(minutes=10)
    want = operator(make_log(log), **changed).where(F.col("eval_time") <= F.lit(closed))
    got = spark.read.parquet(out)
    assert as_set(got.select(*want.columns)) == as_set(want)
    assert {r.state for r in want.collect()} == {"pending", "firing"}


def test_a_run_goes_on_where_no_pane_is_shared(spark, make_log, tmp_path):
    """Windows that do not overlap: a run is carried over triggers in which no pane is left."""
    source, out = str(tmp_path / "log"), str(tmp_path / "out")
    changed = {"window": "10 minutes", "step": "10 minutes", "hold": "20 minutes"}
    log = [
        {"event_time": START + timedelta(seconds=400 * i), "consumer_id": c, "status_code": 403}
        for i in range(40)
        for c in ("a", None, "b")
        if c != "b" or i % 7
    ]
    for i in range(5):
        write_table(make_log(log[24 * i : 24 * (i + 1)]).coalesce(1), source, "requests", mode="append")
        stream = read_requests(spark, source, stream=True)
        start_alerts(stream, "plan_violation", out, str(tmp_path / "state"), available_now=True, partitions=2, **changed).awaitTermination()
    closed = max(r["event_time"] for r in log[:120]) - timedelta(minutes=10)
    want = series.alert_plan_violation(make_log(log[:120]), **changed).where(F.col("eval_time") <= F.lit(closed))
    assert as_set(spark.read.parquet(out).select(*want.columns)) == as_set(want)
    assert {r.state for r in want.collect()} == {"pending", "firing"}


class Handle:
    """States in memory; counts the calls."""

    def __init__(self):
        self.calls = 0

    def _state(self, *_):
        handle, held = self, {}

        class State:
            def __getattr__(self, name):
                def call(*args):
                    handle.calls += 1
                    if name in ("put", "update"):
                        held["all"] = args[0]
                    elif name == "updateValue":
                        held[args[0]] = args[1]
                    elif name == "clear":
                        held.clear()
                    elif name == "exists":
                        return bool(held)
                    elif name == "get":
                        return held.get("all", ())
                    elif name == "iterator":
                        return iter(list(held.items()))
                    return None

                return call

        return State()

    getValueState = getListState = getMapState = _state

    def registerTimer(self, moment):
        self.calls += 1


def test_calls_to_the_state_do_not_grow_with_series_and_panes():
    class Clock:
        def getCurrentWatermarkInMs(self):
            return 100 * 60_000

    def calls(consumers, minutes):
        handle, processor = Handle(), AlertProcessor(ALERTS["rejection_rate"])
        processor.init(handle)
        rows = [(f"c{i}", 60 * m, 1.0, 2.0) for i in range(consumers) for m in range(minutes)]
        panes = pd.DataFrame(rows, columns=["consumer_id", "pane_start", "pane_amount", "pane_total"])
        list(processor.handleInputRows(("c0",), iter([panes]), Clock()))
        list(processor.handleExpiredTimer(("c0",), Clock(), None))
        return handle.calls

    assert calls(50, 100) == calls(2, 98)
