"""Alerts on a stream: panes per series, then a pending and firing machine per series (S6 with F7-F12)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from math import gcd
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tallyforge.operators.series import EXPENSIVE_METHODS, seconds
from tallyforge.streaming.token_bucket import _ROCKSDB
from tallyforge.streaming.windows import start_append


#: Series are dealt by hash into this many groups, each a key of the state.  A checkpoint keeps its number for life.
BUCKETS = 1024


@dataclass(frozen=True)
class AlertRule:
    """A condition on sliding windows of a series, and how long it has to hold.

    ``amount`` is summed per window: as a share of ``of`` (also summed), or per second without it.
    ``where`` chooses the requests of the series.
    """

    by: Sequence[str]
    amount: str
    threshold: float
    of: str | None = None
    where: str = "true"
    window: str | int = "5 minutes"
    step: str | int = "1 minute"
    hold: str | int = "5 minutes"


#: The stream forms of the alerts of ``operators.series``.
ALERTS: dict[str, AlertRule] = {
    "rejection_rate": AlertRule(("consumer_id",), "int(status_code = 429)", 0.1, of="1"),
    "expensive": AlertRule(
        ("consumer_id", "rpc_method"), "1", 10.0, where=f"rpc_method rlike '^(?:{EXPENSIVE_METHODS})\\\\z'", step="30 seconds", hold="10 minutes"
    ),
    "429_spike": AlertRule(
        ("route_name", "consumer_id"), "1", 50.0, where="status_code = 429", window="1 minute", step="30 seconds", hold="2 minutes"
    ),
    "plan_violation": AlertRule(
        ("consumer_id",), "1", 0.0, where="status_code = 403 AND plan_slug = 'free'", window="1 minute", hold="1 minute"
    ),
    "compute_units": AlertRule(("consumer_id", "plan_slug"), "compute_units", 1000.0, hold="10 minutes"),
    "server_errors": AlertRule(("route_name",), "int(status_code >= 500)", 0.05, of="1"),
    "failing_upstreams": AlertRule(("chain_slug", "upstream_host"), "int(status_code >= 500)", 0.5, of="1", hold="2 minutes"),
}


class AlertProcessor(StatefulProcessor):
    """The series of one bucket: the panes that a window can still cover, and since when the condition has held.

    When panes come in or a timer expires, all windows that the watermark has passed since the last time are evaluated,
    for all series of the bucket at once, also those that have fallen silent.  The state is read and written once for a
    bucket and trigger, so the calls to it do not grow with panes and series.  It is a window's panes, and two numbers for
    each series that met the condition in the last window.
    """

    def __init__(self, rule: AlertRule) -> None:
        self.rule, self.by = rule, list(rule.by)
        self.width, self.stride, self.hold = seconds(rule.window), seconds(rule.step), seconds(rule.hold)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        keys = ", ".join(f"{c} string" for c in self.by)
        self.panes = handle.getListState("panes", f"{keys}, start bigint, amount double, total double")
        # The last window evaluated, and the first one of the run it is in.
        self.runs = handle.getListState("runs", f"{keys}, evaluated bigint, since bigint")
        self.closed = handle.getValueState("closed", "second bigint")

    def _after(self, second: Any) -> Any:
        """The first evaluation after ``second``."""
        return second - second % self.stride + self.stride

    def _met(self, panes: pd.DataFrame, done: int, closed: int) -> pd.DataFrame:
        """(series, moment, value) of the windows after ``done`` and up to ``closed`` that meet the condition."""
        rows = panes[["series", "start", "amount", "total"]].sort_values(["series", "start"])
        rows = rows.assign(unknown=rows["amount"].isna() | rows["total"].isna())
        rows["moment"] = np.maximum(self._after(rows["start"]), self._after(done))
        parts = []
        while True:
            rows = rows[(rows["moment"] <= closed) & (rows["moment"] <= rows["start"] + self.width)]
            parts.append(rows)
            if rows.empty:
                break
            rows = rows.assign(moment=rows["moment"] + self.stride)
        sums = pd.concat(parts).groupby(["series", "moment"])[["amount", "total", "unknown"]].sum().reset_index()
        by = self.width if self.rule.of is None else sums["total"].where(sums["total"] != 0)
        sums["value"] = (sums["amount"] / by).where(sums["unknown"] == 0)
        return sums.loc[sums["value"] > self.rule.threshold, ["series", "moment", "value"]]

    def _evaluate(self, fresh: list[pd.DataFrame], closed: int) -> Iterator[pd.DataFrame]:
        names = [*self.by, "start", "amount", "total"]
        held = pd.DataFrame(list(self.panes.get()), columns=names)
        runs = pd.DataFrame(list(self.runs.get()), columns=[*self.by, "evaluated", "since"])
        some = [part for part in (held, *fresh) if len(part)]
        if not some:  # a later timer of a silent bucket, or an earlier one behind the panes of this trigger
            if not (runs["evaluated"] + self.stride >= self._after(closed)).any():
                self.runs.clear()
                self.closed.clear()
            return
        panes = pd.concat(some, ignore_index=True)
        keys = pd.concat([panes[self.by], runs[self.by]], ignore_index=True) if len(runs) else panes[self.by]
        series = keys.groupby(self.by, dropna=False).ngroup().to_numpy()
        keys = keys.assign(series=series).drop_duplicates("series").set_index("series")
        panes["series"] = series[: len(panes)]
        run = runs[["evaluated", "since"]].set_index(series[len(panes) :]).astype("int64")

        met = self._met(panes, int(self.closed.get()[0]) if self.closed.exists() else -(1 << 62), closed)
        goes_on = (met["series"] == met["series"].shift()) & (met["moment"] == met["moment"].shift() + self.stride)
        taken_up = met["moment"] == met["series"].map(run["evaluated"]) + self.stride
        since = met["moment"].where(~taken_up, met["series"].map(run["since"]))
        met["since"] = since.where(~goes_on).ffill().astype("int64")
        if len(met):
            yield pd.DataFrame(
                {
                    "eval_time": pd.to_datetime(met["moment"].to_numpy(), unit="s"),
                    **{c: keys.loc[met["series"], c].to_numpy() for c in self.by},
                    "value": met["value"].to_numpy(),
                    "state": np.where(met["moment"] - met["since"] >= self.hold, "firing", "pending"),
                    "active_since": pd.to_datetime(met["since"].to_numpy(), unit="s"),
                }
            )

        coming = self._after(closed)
        left = panes[panes["start"] + self.width >= np.maximum(coming, self._after(panes["start"]))]
        # A run goes on only if the next window meets the condition too.
        last = pd.concat([run, met.set_index("series")[["moment", "since"]].set_axis(run.columns, axis=1)])
        last = last[last["evaluated"] + self.stride >= coming]
        for state, rows in ((self.panes, left[names]), (self.runs, keys.loc[last.index].assign(**last))):
            state.put(list(rows.itertuples(index=False, name=None))) if len(rows) else state.clear()
        self.closed.update((closed,))
        if len(left) or len(last):
            self.handle.registerTimer(int(coming if len(last) else max(coming, self._after(left["start"].min()))) * 1000)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        fresh = [batch.rename(columns=lambda c: c.removeprefix("pane_"))[[*self.by, "start", "amount", "total"]] for batch in rows]
        yield from self._evaluate(fresh, timerValues.getCurrentWatermarkInMs() // 1000)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        yield from self._evaluate([], timerValues.getCurrentWatermarkInMs() // 1000)

    def close(self) -> None:
        pass


def alerts(stream: DataFrame, rule: AlertRule, watermark: str = "10 minutes") -> DataFrame:
    """(eval_time, by..., value, state, active_since) as the batch alerts give them, once the watermark has passed a window.

    Requests are summed per series and pane (the largest span of which window and step are multiples) in a first stateful
    aggregation, so no request is copied into the windows that cover it and Python sees panes only; a second
    stateful operator holds the panes of a window and the states of the alerts, a hash bucket of series at a time.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    grain = gcd(seconds(rule.window), seconds(rule.step))
    # The clock has to hear of all requests, and a filter would be pushed before it: what the rule leaves out
    # is summed in one group without a key, and dropped after that.
    chosen = F.coalesce(F.expr(rule.where), F.lit(False))
    panes = (
        stream.withWatermark("event_time", watermark)
        .groupBy(F.window("event_time", f"{grain} seconds").alias("pane"), *[F.when(chosen, F.col(c)).alias(c) for c in rule.by])
        .agg(
            F.sum(F.when(chosen, F.expr(rule.amount))).cast("double").alias("pane_amount"),
            F.sum(F.when(chosen, F.expr(rule.of or "0"))).cast("double").alias("pane_total"),
            F.max(chosen).alias("pane_chosen"),
        )
        .where("pane_chosen")
    )
    bucket = F.pmod(F.xxhash64(*rule.by), F.lit(BUCKETS)).alias("bucket")
    timed = panes.select(bucket, *rule.by, F.window_time("pane").alias("pane_time"), F.unix_seconds("pane.start").alias("pane_start"), "pane_amount", "pane_total")
    keys = ", ".join(f"{c} string" for c in rule.by)
    return timed.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=AlertProcessor(rule),
        outputStructType=f"eval_time timestamp, {keys}, value double, state string, active_since timestamp",
        outputMode="append",
        timeMode="eventTime",
    )


def start_alerts(
    stream: DataFrame,
    rule: AlertRule | str,
    out: str,
    checkpoint: str,
    watermark: str = "10 minutes",
    available_now: bool = False,
    interval: str = "30 seconds",
    partitions: int | None = None,
    **changed: Any,
) -> StreamingQuery:
    """S6 into a Parquet folder: a rule, or the name of one of ALERTS with ``changed`` fields."""
    found = replace(ALERTS[rule] if isinstance(rule, str) else rule, **changed)
    return start_append(alerts(stream, found, watermark), out, checkpoint, available_now, interval, partitions=partitions)
