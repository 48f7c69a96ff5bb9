"""Token bucket on a stream."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tallyforge.operators.limits import Bucket
from tallyforge.operators.series import seconds
from tallyforge.streaming.windows import start_append

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class TokenBucketProcessor(StatefulProcessor):
    """One bucket per key; a bucket idle until it would be full again is dropped.

    Eviction goes by event time, so a stalled stream refills nothing.  It
    waits two windows, or as many as a full refill takes, and therefore
    never changes a decision.
    """

    def __init__(self, capacity: int, refill: int, window: int) -> None:
        self.capacity, self.refill, self.window = capacity, refill, window
        self.idle = window * max(2, -(-capacity // refill))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.bucket = handle.getValueState("bucket", "tokens bigint, refilled bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        wanted: Counter[int] = Counter()
        for batch in rows:
            wanted.update(batch.groupby("second")["n"].sum().to_dict())
        decided = []
        known = self.bucket.get() if self.bucket.exists() else None
        bucket = Bucket(int(known[0]), int(known[1])) if known else None
        refilled = bucket.refilled if bucket else None
        for now in sorted(wanted):
            if bucket is None:
                bucket = Bucket(self.capacity, now)
            count = wanted[now]
            passed = bucket.take(now, count, self.capacity, self.refill, self.window)
            decided.append((key[0], pd.Timestamp(now, unit="s"), count, passed, count - passed))
        self.bucket.update((bucket.tokens, bucket.refilled))
        if bucket.refilled != refilled:
            self.handle.registerTimer((bucket.refilled + self.idle) * 1000)
        yield pd.DataFrame(decided, columns=["key", "event_time", "requests", "allowed", "rejected"])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        if self.bucket.exists():
            refilled = int(self.bucket.get()[1])
            # A later refill has set a timer of its own.
            if (refilled + self.idle) * 1000 <= expiredTimerInfo.getExpiryTimeInMs():
                self.bucket.clear()
        yield pd.DataFrame(columns=["key", "event_time", "requests", "allowed", "rejected"])

    def close(self) -> None:
        pass


def bucket_decisions(
    stream: DataFrame,
    key: str,
    capacity: int,
    refill: int | None = None,
    window: str | int = "1 minute",
    watermark: str = "10 minutes",
    settled: bool = False,
) -> DataFrame:
    """The decisions of ``limits.token_bucket`` for a stream in time order.

    A second that is split over micro-batches gives one row in each.  With ``settled`` the requests of a second are
    counted by a stateful aggregation of their own, and the second is decided once the watermark has passed it: later, but
    the stream need not be in time order within the watermark, a second gives one row, and the processor gets a row per second
    of a busy key, however many requests it has.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    processor = TokenBucketProcessor(capacity, capacity if refill is None else refill, seconds(window))
    timed = stream.withWatermark("event_time", watermark).select(F.col(key).alias("key"), "event_time")
    if settled:
        counted = timed.groupBy("key", F.window("event_time", "1 second").alias("pane")).agg(F.count(F.lit(1)).alias("n"))
        timed = counted.select("key", F.window_time("pane").alias("event_time"), F.unix_seconds("pane.start").alias("second"), "n")
    else:
        timed = timed.select("*", F.unix_seconds("event_time").alias("second"), F.lit(1).cast("bigint").alias("n"))
    return (
        timed
        .groupBy("key")
        .transformWithStateInPandas(
            statefulProcessor=processor,
            outputStructType="key string, event_time timestamp, requests bigint, allowed bigint, rejected bigint",
            outputMode="append",
            timeMode="eventTime",
        )
        .withColumnRenamed("key", key)
    )


def start_token_bucket(
    stream: DataFrame,
    key: str,
    capacity: int,
    out: str,
    checkpoint: str,
    refill: int | None = None,
    window: str | int = "1 minute",
    watermark: str = "10 minutes",
    available_now: bool = False,
    interval: str = "10 seconds",
    partitions: int | None = None,
    settled: bool = False,
) -> StreamingQuery:
    """S7 into a Parquet folder; ``partitions`` is the number of state partitions."""
    decisions = bucket_decisions(stream, key, capacity, refill, window, watermark, settled)
    return start_append(decisions, out, checkpoint, available_now, interval, partitions=partitions)
