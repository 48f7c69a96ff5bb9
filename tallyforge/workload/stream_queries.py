"""Queries that run a stream over the log to its end and read what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.operators import rollups
from tallyforge.operators.usage import usage_daily_state
from tallyforge.session import scratch_path
from tallyforge.sources.catalog import seed_method_units
from tallyforge.sources.requests import read_requests
from tallyforge.streaming import rollups as stream_rollups
from tallyforge.streaming import alerts, token_bucket, windows
from tallyforge.workload.fixtures import load, load_stream
from tallyforge.workload.registry import query
from tallyforge.workload.series_queries import _DECISIONS, _grid, _held, _rate, _share, _walk
from tallyforge.workload.usage_queries import _EXPENSIVE, _HEALTH, _METHODS, _POPULARITY, _TENANT, _USAGE


def _to_the_end(spark) -> dict:
    """Run to the end of the input, with a state partition per core of this session."""
    return {"available_now": True, "partitions": spark.sparkContext.defaultParallelism}


def _rolled_up(spark, sf_dir: str, name: str) -> str:
    out = scratch_path(spark, name)
    stream = stream_rollups.start_rollup(load_stream(spark, sf_dir), name, out, f"{out}-state", available_now=True)
    stream.awaitTermination()
    return out


@query("start_rollup", sql=_METHODS)
def _(spark, sf_dir):
    out = _rolled_up(spark, sf_dir, "chain_method_usage")
    return stream_rollups.read_rollup_table(spark, out, "chain_method_usage")


@query("start_rollup_cascade", sql=f"SELECT event_date, {_TENANT}, {_USAGE} FROM requests GROUP BY event_date, {_TENANT}")
def _(spark, sf_dir):
    rollup, shape = rollups.ROLLUPS["usage_daily"]
    hourly = stream_rollups.read_rollup(spark, _rolled_up(spark, sf_dir, "usage_hourly"), "usage_hourly")
    return shape(rollup.finish(usage_daily_state(hourly)))


@query("compact", sql=_HEALTH)
def _(spark, sf_dir):
    out = _rolled_up(spark, sf_dir, "chain_health")
    stream_rollups.compact(spark, out, "chain_health", upto=0)
    return stream_rollups.read_rollup_table(spark, out, "chain_health")


@query("compact_between_batches", sql=_HEALTH)
def _(spark, sf_dir):
    # The log in three deliveries, of two micro-batches each, with a compaction and a clean-up after every one.
    (log,) = load(spark, sf_dir, "requests")
    source, out, name = scratch_path(spark, "deliveries"), scratch_path(spark, "chain_health"), "chain_health"
    share = F.pmod(F.xxhash64("request_id"), F.lit(3))
    for delivery in range(3):
        log.where(share == delivery).repartition(2, "request_id").write.mode("append").parquet(source)
        stream = read_requests(spark, source, stream=True, files_per_batch=1)
        running = stream_rollups.start_rollup(stream, name, out, f"{out}-state", available_now=True)
        running.awaitTermination()
        stream_rollups.compact(spark, out, name, upto=running.lastProgress["batchId"])
        stream_rollups.clean_up(spark, out)
    return stream_rollups.read_rollup_table(spark, out, name)


@query("start_filter", sql=_EXPENSIVE)
def _(spark, sf_dir):
    out, units = scratch_path(spark, "expensive"), seed_method_units(spark)
    stream = windows.start_filter(
        load_stream(spark, sf_dir),
        lambda requests: rollups.expensive_method_usage(requests, units),
        out,
        f"{out}-state",
        available_now=True,
    )
    stream.awaitTermination()
    return spark.read.parquet(out).drop("event_date")


@query(
    "start_windowed",
    sql=f"""SELECT * FROM ({_HEALTH}) WHERE minute + INTERVAL '1 minute'
      <= (SELECT date_trunc('milliseconds', max(event_time)) FROM requests) - INTERVAL '10 minutes'""",
)
def _(spark, sf_dir):
    out = scratch_path(spark, "windowed")
    windows.start_windowed(
        load_stream(spark, sf_dir), "chain_health", out, f"{out}-state", **_to_the_end(spark)
    ).awaitTermination()
    return spark.read.parquet(out)


@query(
    "start_rates",
    sql=f"""SELECT eval_time, chain_slug, round(CAST(count(*) AS DOUBLE) / 7200, 6) AS value FROM {_grid("2 hours", "1 hour")}
    WHERE eval_time <= (SELECT max(event_time) FROM requests) - INTERVAL '10 minutes' GROUP BY eval_time, chain_slug""",
)
def _(spark, sf_dir):
    out = scratch_path(spark, "rates")
    windows.start_rates(
        load_stream(spark, sf_dir), ["chain_slug"], out, f"{out}-state", "2 hours", "1 hour", **_to_the_end(spark)
    ).awaitTermination()
    return spark.read.parquet(out)


@query(
    "start_windowed_members",
    sql=f"""SELECT * FROM ({_POPULARITY}) WHERE hour + INTERVAL '1 hour'
      <= (SELECT date_trunc('milliseconds', max(event_time)) FROM requests) - INTERVAL '10 minutes'""",
)
def _(spark, sf_dir):
    out = scratch_path(spark, "windowed")
    windows.start_windowed(
        load_stream(spark, sf_dir), "chain_popularity", out, f"{out}-state", **_to_the_end(spark)
    ).awaitTermination()
    return spark.read.parquet(out)


def _closed(sql: str) -> str:
    return f"SELECT * FROM ({sql}) WHERE eval_time <= (SELECT max(event_time) FROM requests) - INTERVAL '10 minutes'"


def _alerted(spark, sf_dir: str, name: str, threshold: float, window: str, step: str, hold: str):
    out = scratch_path(spark, name)
    changed = {"threshold": threshold, "window": window, "step": step, "hold": hold}
    alerts.start_alerts(load_stream(spark, sf_dir), name, out, f"{out}-state", **_to_the_end(spark), **changed).awaitTermination()
    return spark.read.parquet(out)


@query("start_alerts_rejection_rate", sql=_closed(_share("status_code = 429", "consumer_id", "2 days", "6 hours", "12 hours", 0.1)))
def _(spark, sf_dir):
    return _alerted(spark, sf_dir, "rejection_rate", 0.1, "2 days", "6 hours", "12 hours")


@query(
    "start_alerts_server_errors",
    sql=_closed(_share("status_code BETWEEN 500 AND 599", "route_name", "12 hours", "3 hours", "6 hours", 0.04)),
)
def _(spark, sf_dir):
    return _alerted(spark, sf_dir, "server_errors", 0.04, "12 hours", "3 hours", "6 hours")


@query(
    "start_alerts_compute_units",
    sql=_closed(
        _held(
            f"""SELECT * FROM ({_rate('consumer_id, plan_slug', '1 day', '6 hours', 86400, amount='sum(compute_units)')})
            WHERE value > 0.0005""",
            "consumer_id, plan_slug", "6 hours", "12 hours",
        )
    ),
)
def _(spark, sf_dir):
    return _alerted(spark, sf_dir, "compute_units", 0.0005, "1 day", "6 hours", "12 hours")


@query("start_token_bucket", sql=_walk(2, 2, 86400) + _DECISIONS)
def _(spark, sf_dir):
    out = scratch_path(spark, "buckets")
    token_bucket.start_token_bucket(
        load_stream(spark, sf_dir), "consumer_id", 2, out, f"{out}-state", window="1 day", **_to_the_end(spark)
    ).awaitTermination()
    decided = spark.read.parquet(out)
    sums = [F.sum(c).alias(c) for c in ("requests", "allowed", "rejected")]
    return decided.groupBy("consumer_id", "event_time").agg(*sums)
