"""Watermarked windows and rates on a stream, and stateless filters.

These bound the state by a watermark; rows later than it are dropped, and counted in a table of their own
(``log_drops``).  ``streaming.rollups`` takes any lateness.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tallyforge.functions.rollup import Rollup, expressions, quantile_columns
from tallyforge.operators.rollups import ROLLUPS
from tallyforge.operators.series import seconds
from tallyforge.sources.requests import read_or_empty

_WIDTH = {"minute": "1 minute", "hour": "1 hour", "event_date": "1 day"}


@contextmanager
def state_partitions(spark: SparkSession, count: int | None) -> Iterator[None]:
    """Start queries with this many state partitions.

    A stream takes the number of shuffle partitions when it first starts and
    keeps it for the life of its checkpoint.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    if count is not None:
        spark.conf.set(name, str(count))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def start_append(
    result: DataFrame,
    out: str,
    checkpoint: str,
    available_now: bool,
    interval: str,
    partition: str | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Append the rows of a stream to a Parquet folder."""
    writer = result.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition:
        writer = writer.partitionBy(partition)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    with state_partitions(result.sparkSession, partitions):
        return writer.trigger(**trigger).start(out)


def start_filter(
    stream: DataFrame,
    operator: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    available_now: bool = False,
    interval: str = "1 minute",
) -> StreamingQuery:
    """A row-by-row operator (errors, expensive calls), one folder per day."""
    result = operator(stream).withColumn("event_date", F.to_date("event_time"))
    return start_append(result, out, checkpoint, available_now, interval, partition="event_date")


def windowed(stream: DataFrame, name: str, watermark: str = "10 minutes", approx: bool = False) -> DataFrame:
    """A rollup over tumbling windows, emitted once the watermark has passed.

    A rollup that counts members is summed by two stateful operators in a chain: first each member (and value) of a
    window once, a row of state each, then the windows.  So distinct counts are exact, the state of
    a busy window is spread over all tasks, and the watermark drops it.  ``approx`` counts members by sketch instead.
    """
    rollup, shape = ROLLUPS[name]
    time_key, *dimensions = rollup.keys
    inputs = stream.withWatermark("event_time", watermark)
    if rollup.members and not approx:
        return shape(_with_members(inputs, rollup, time_key, dimensions))
    aggregates = [F.sum(F.expr(e).cast("bigint")).alias(k) for k, e in rollup.sums.items()]
    aggregates += [F.max(F.expr(e).cast("bigint")).alias(k) for k, e in rollup.maxes.items()]
    aggregates += [
        F.percentile(F.expr(rollup.values[v]).cast("bigint"), [float(q) for q in qs]).alias(f"_q_{v}")
        for v, qs in rollup.quantiles.items()
    ]
    aggregates += [F.approx_count_distinct(F.expr(e)).alias(f"unique_{k}") for k, e in rollup.members.items()]
    window = F.window("event_time", _WIDTH[time_key]).alias("_window")
    done = inputs.groupBy(window, *[F.expr(rollup.keys[d]).alias(d) for d in dimensions]).agg(*aggregates)
    start = F.col("_window.start")
    finished = done.select(
        (start.cast("date") if time_key == "event_date" else start).alias(time_key),
        *dimensions,
        *rollup.sums,
        *rollup.maxes,
        *expressions(*quantile_columns(rollup.quantiles)),
        *[f"unique_{m}" for m in rollup.members],
    )
    return shape(finished)


def _with_members(inputs: DataFrame, rollup: Rollup, time_key: str, dimensions: Sequence[str]) -> DataFrame:
    rows = rollup.unfolded(inputs, "event_time").groupBy(
        F.window("event_time", _WIDTH[time_key]).alias("_first"), *dimensions, "facet", "value", "member"
    )
    once = rows.agg(F.sum("n").alias("n"), *rollup.measures())
    window = F.window(F.window_time("_first"), _WIDTH[time_key]).alias("_window")
    done = once.groupBy(window, *dimensions).agg(*rollup.measures(), *rollup.counted(rollup.quantiles, list(rollup.members)))
    start = F.col("_window.start")
    return done.select(
        (start.cast("date") if time_key == "event_date" else start).alias(time_key),
        *dimensions,
        *rollup.sums,
        *rollup.maxes,
        *expressions(*quantile_columns(rollup.quantiles)),
        *[f"unique_{m}" for m in rollup.members],
    )


def start_windowed(
    stream: DataFrame,
    name: str,
    out: str,
    checkpoint: str,
    watermark: str = "10 minutes",
    available_now: bool = False,
    interval: str = "1 minute",
    partitions: int | None = None,
    approx: bool = False,
) -> StreamingQuery:
    """S5 into a Parquet folder; ``partitions`` is the number of state partitions."""
    result = windowed(stream, name, watermark, approx)
    return start_append(result, out, checkpoint, available_now, interval, partitions=partitions)


def sliding_rate(
    stream: DataFrame,
    by: Sequence[str],
    window: str = "5 minutes",
    step: str = "1 minute",
    watermark: str = "10 minutes",
    threshold: float | None = None,
) -> DataFrame:
    """Requests per second over sliding windows; above ``threshold`` only, if given."""
    counted = (
        stream.withWatermark("event_time", watermark)
        .groupBy(F.window("event_time", window, step).alias("_window"), *by)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    value = F.col("_n").cast("double") / F.lit(float(seconds(window)))
    series = counted.select(F.col("_window.end").alias("eval_time"), *by, value.alias("value"))
    return series if threshold is None else series.where(F.col("value") > threshold)


def start_rates(
    stream: DataFrame,
    by: Sequence[str],
    out: str,
    checkpoint: str,
    window: str = "5 minutes",
    step: str = "1 minute",
    watermark: str = "10 minutes",
    threshold: float | None = None,
    available_now: bool = False,
    interval: str = "30 seconds",
    partitions: int | None = None,
) -> StreamingQuery:
    """S6 into a Parquet folder; ``series.hold_for`` on what is read gives the alert states."""
    result = sliding_rate(stream, by, window, step, watermark, threshold)
    return start_append(result, out, checkpoint, available_now, interval, partitions=partitions)


class DropLog(StreamingQueryListener):
    """Writes the rows that watermarks dropped, trigger by trigger, to a Parquet folder.

    A query's own progress only goes back a hundred triggers; this table keeps them all, over restarts.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        dropped = sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
        if dropped:
            row = (str(progress.id), str(progress.runId), progress.batchId, progress.timestamp, dropped)
            self.spark.createDataFrame([row], _DROPS).coalesce(1).write.mode("append").parquet(self.folder)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


_DROPS = "query_id string, run_id string, batch_id bigint, triggered_at string, dropped bigint"


def log_drops(spark: SparkSession, folder: str) -> DropLog:
    """Log the dropped rows of all queries of the session from now on; ``spark.streams.removeListener`` ends it."""
    listener = DropLog(spark, folder)
    spark.streams.addListener(listener)
    return listener


def late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """(query_id, triggers, dropped): the rows that watermarks dropped, over the whole life of each query.

    A trigger that was run again after a failure counts once, as it counted last.
    """
    logged = read_or_empty(spark, folder, _DROPS)
    last = logged.groupBy("query_id", "batch_id").agg(F.max_by("dropped", "triggered_at").alias("dropped"))
    return last.groupBy("query_id").agg(F.count(F.lit(1)).alias("triggers"), F.sum("dropped").alias("dropped"))
