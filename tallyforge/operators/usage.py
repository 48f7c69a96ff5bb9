"""Hourly and daily usage state (B1-B3) and the row-merging forms."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.measures import ratio
from tallyforge.functions.rollup import Rollup

_SUMS = {
    "request_count": "1",
    "error_count": "int(is_error = 1)",
    "compute_units_used": "compute_units",
    "status_2xx_count": "int(status_code >= 200 AND status_code < 300)",
    "status_4xx_count": "int(status_code >= 400 AND status_code < 500)",
    "status_5xx_count": "int(status_code >= 500)",
    "total_response_size": "response_size",
    "latency_sum": "latency_ms",
}
_TENANT = ["organization_id", "consumer_id", "api_key_prefix", "plan_slug", "chain_slug", "chain_type"]
QUANTILES = (0.50, 0.95, 0.99)
_MEASURED = {
    "sums": _SUMS,
    "maxes": {"latency_max": "latency_ms"},
    "values": {"latency": "latency_ms", "upstream": "upstream_latency_ms"},
    "quantiles": {"latency": QUANTILES, "upstream": QUANTILES},
}

USAGE_HOURLY = Rollup(
    name="usage_hourly",
    keys={
        "hour": "date_trunc('hour', event_time)",
        **{k: k for k in _TENANT},
        "route_name": "route_name",
        "rpc_method": "rpc_method",
    },
    day="to_date(hour)",
    **_MEASURED,
)
USAGE_DAILY = Rollup(
    name="usage_daily", keys={"event_date": "to_date(event_time)", **{k: k for k in _TENANT}}, **_MEASURED
)


def usage_hourly_state(requests: DataFrame, facets: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """B1: one row of usage state per hour, tenant, key, plan, chain, route and method."""
    if approx:
        return USAGE_HOURLY.sketch_state(requests)
    return USAGE_HOURLY.state(requests, facets)


def usage_daily_state(hourly_state: DataFrame) -> DataFrame:
    """B2: daily usage from hourly usage; drops route and method."""
    days = hourly_state.withColumn("event_date", F.to_date("hour"))
    if "latency_kll" in hourly_state.columns:
        return USAGE_DAILY.sketch_merge(days, list(USAGE_DAILY.keys))
    return USAGE_DAILY.merge(days)


def usage_daily_state_from_log(requests: DataFrame, facets: Sequence[str] | None = None) -> DataFrame:
    """The same rows as B2 in one pass over the log, where no hourly state is stored."""
    return USAGE_DAILY.state(requests, facets)


def finalize(
    state: DataFrame, keys: Sequence[str], quantiles: Sequence[float] = QUANTILES, upstream: bool = False
) -> DataFrame:
    """Readable usage at ``keys``, which may be any subset of the state's keys."""
    wanted = {}
    if quantiles:
        wanted["latency"] = quantiles
        if upstream:
            wanted["upstream"] = quantiles
    if "latency_kll" in state.columns:
        return _with_average(USAGE_DAILY.sketch_finish(USAGE_DAILY.sketch_merge(state, list(keys)), keys, wanted))
    return _with_average(USAGE_DAILY.finalize(state, keys, wanted))


def _with_average(done: DataFrame) -> DataFrame:
    return done.withColumn("latency_avg", ratio(F.col("latency_sum"), F.col("request_count")))


def usage_shape(rollup: Rollup) -> Callable[[DataFrame], DataFrame]:
    """From finished metrics to the columns of the hourly or daily table."""
    counters = [k for k in _SUMS if k != "latency_sum"]
    points = ["p50", "p95", "p99"]
    columns = [
        *rollup.keys,
        *counters,
        "latency_avg",
        *[f"latency_{p}" for p in points],
        "latency_max",
        *[f"upstream_{p}" for p in points],
    ]
    return lambda done: _with_average(done).select(*columns)


def usage_hourly(requests: DataFrame) -> DataFrame:
    """B1 finalised."""
    return usage_shape(USAGE_HOURLY)(USAGE_HOURLY.compute(requests))


def usage_daily(requests: DataFrame) -> DataFrame:
    """B2 finalised, straight from the log (``usage_daily_state`` goes through the hourly state)."""
    return usage_shape(USAGE_DAILY)(USAGE_DAILY.compute(requests))


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` columns per key.

    A maximum over a struct combines on the map side, so a hot key sends one
    row per map task.  Rows equal in ``order`` are told apart by the other
    columns, which must therefore be orderable (no maps).
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    latest = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_row"))
    return latest.select(*keys, "_row.*").select(*df.columns)


def collapse_sum(df: DataFrame, keys: Sequence[str], additive: Sequence[str]) -> DataFrame:
    """Add up the additive columns of rows that share a key."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in additive])
