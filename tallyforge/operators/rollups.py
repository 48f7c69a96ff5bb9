"""Error, latency, health, method, organisation, popularity and expensive-call rollups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.measures import percent, ratio
from tallyforge.functions.rollup import Rollup
from tallyforge.operators.usage import USAGE_DAILY, USAGE_HOURLY, usage_shape

_LATENCY = {"latency": "latency_ms"}

LATENCY_METRICS = Rollup(
    name="latency_metrics",
    keys={
        "minute": "date_trunc('minute', event_time)",
        "route_name": "route_name",
        "upstream_host": "upstream_host",
    },
    # The bucket bounds in milliseconds.
    sums={
        "latency_0_10ms": "int(latency_ms < 10)",
        "latency_10_50ms": "int(latency_ms >= 10 AND latency_ms < 50)",
        "latency_50_100ms": "int(latency_ms >= 50 AND latency_ms < 100)",
        "latency_100_500ms": "int(latency_ms >= 100 AND latency_ms < 500)",
        "latency_500_1000ms": "int(latency_ms >= 500 AND latency_ms < 1000)",
        "latency_1000ms_plus": "int(latency_ms >= 1000)",
    },
    values=_LATENCY,
    quantiles={"latency": (0.5, 0.95, 0.99, 0.999)},
    day="to_date(minute)",
)

CHAIN_HEALTH = Rollup(
    name="chain_health",
    keys={
        "minute": "date_trunc('minute', event_time)",
        "chain_slug": "chain_slug",
        "upstream_host": "upstream_host",
    },
    sums={
        "below_500": "int(status_code < 500)",
        "health_check_failures": "int(status_code >= 500)",
        "latency_sum": "latency_ms",
        "request_count": "1",
        "error_count": "int(is_error = 1)",
    },
    values=_LATENCY,
    quantiles={"latency": (0.95, 0.99)},
    day="to_date(minute)",
)

CHAIN_METHOD_USAGE = Rollup(
    name="chain_method_usage",
    keys={"event_date": "to_date(event_time)", "chain_slug": "chain_slug", "rpc_method": "rpc_method"},
    sums={
        "request_count": "1",
        "total_compute_units": "compute_units",
        "latency_sum": "latency_ms",
        "error_count": "int(is_error = 1)",
    },
    values=_LATENCY,
    quantiles={"latency": (0.95,)},
    members={"consumers": "consumer_id", "organizations": "organization_id"},
)

CHAIN_ORG_USAGE = Rollup(
    name="chain_org_usage",
    keys={
        "event_date": "to_date(event_time)",
        "organization_id": "organization_id",
        "chain_slug": "chain_slug",
        "plan_slug": "plan_slug",
    },
    sums={"request_count": "1", "compute_units_used": "compute_units", "total_response_size": "response_size"},
)

CHAIN_POPULARITY = Rollup(
    name="chain_popularity",
    keys={"hour": "date_trunc('hour', event_time)", "chain_slug": "chain_slug"},
    sums={
        "request_count": "1",
        "latency_sum": "latency_ms",
        "status_2xx_count": "int(status_code >= 200 AND status_code < 300)",
    },
    members={"users": "consumer_id"},
    day="to_date(hour)",
)

EXPENSIVE_FROM_UNITS = 10


def errors(requests: DataFrame) -> DataFrame:
    """Failed requests as error rows."""
    optional = [c for c in ("client_ip", "metadata") if c in requests.columns]
    return requests.where(F.col("is_error") == 1).select(
        "event_time",
        "event_time_ms",
        "request_id",
        "organization_id",
        "consumer_id",
        "chain_slug",
        F.lit("http_error").alias("error_type"),
        "error_message",
        F.lit("").alias("error_stack"),
        "method",
        "path",
        "status_code",
        "rpc_method",
        *optional,
    )


def _latency_columns(done: DataFrame) -> DataFrame:
    points = [F.col(f"latency_{p}").alias(p) for p in ("p50", "p95", "p99", "p999")]
    return done.select(*LATENCY_METRICS.keys, *LATENCY_METRICS.sums, *points)


def latency_metrics(requests: DataFrame) -> DataFrame:
    """Latency buckets and percentiles per minute, route and upstream."""
    return _latency_columns(LATENCY_METRICS.compute(requests))


def _health_columns(done: DataFrame) -> DataFrame:
    return done.select(
        *CHAIN_HEALTH.keys,
        F.when(F.col("below_500") > 0, 1).otherwise(0).alias("is_healthy"),
        "health_check_failures",
        ratio(F.col("latency_sum"), F.col("request_count")).alias("avg_latency_ms"),
        F.col("latency_p95").alias("p95_latency_ms"),
        F.col("latency_p99").alias("p99_latency_ms"),
        "request_count",
        "error_count",
        percent(F.col("error_count"), F.col("request_count")).alias("error_rate"),
        F.lit(0).cast("bigint").alias("latest_block"),
    )


def chain_health(requests: DataFrame) -> DataFrame:
    """Health of each chain upstream per minute."""
    return _health_columns(CHAIN_HEALTH.compute(requests))


def _method_columns(done: DataFrame) -> DataFrame:
    return done.select(
        *CHAIN_METHOD_USAGE.keys,
        "request_count",
        "unique_consumers",
        "unique_organizations",
        "total_compute_units",
        ratio(F.col("total_compute_units"), F.col("request_count")).alias("avg_compute_units"),
        ratio(F.col("latency_sum"), F.col("request_count")).alias("avg_latency_ms"),
        F.col("latency_p95").alias("p95_latency_ms"),
        "error_count",
        percent(F.col("error_count"), F.col("request_count")).alias("error_rate"),
    )


def chain_method_usage(requests: DataFrame, approx: bool = False) -> DataFrame:
    """Usage of each method per chain and day; ``approx`` uses sketches."""
    if approx:
        return _method_columns(CHAIN_METHOD_USAGE.sketch_finish(CHAIN_METHOD_USAGE.sketch_state(requests)))
    return _method_columns(CHAIN_METHOD_USAGE.compute(requests))


def _org_columns(done: DataFrame, prices: DataFrame | None = None) -> DataFrame:
    if prices is None:
        return done.withColumn("estimated_cost", F.lit(0.0))
    unit_price = F.coalesce(F.col("price_per_unit").cast("double"), F.lit(0.0))
    priced = done.join(prices.select("plan_slug", "price_per_unit"), "plan_slug", "left")
    return priced.withColumn("estimated_cost", F.col("compute_units_used") * unit_price).select(
        *done.columns, "estimated_cost"
    )


def chain_org_usage(requests: DataFrame, prices: DataFrame | None = None) -> DataFrame:
    """Usage of each organisation per chain, plan and day.

    ``prices`` has plan_slug and price_per_unit; without it the cost is 0.
    """
    return _org_columns(CHAIN_ORG_USAGE.compute(requests), prices)


def _popularity_columns(done: DataFrame) -> DataFrame:
    return done.select(
        *CHAIN_POPULARITY.keys,
        "request_count",
        "unique_users",
        ratio(F.col("latency_sum"), F.col("request_count")).alias("avg_latency_ms"),
        percent(F.col("status_2xx_count"), F.col("request_count")).alias("success_rate"),
    )


def chain_popularity(requests: DataFrame, approx: bool = False) -> DataFrame:
    """Traffic, users and success of each chain per hour."""
    if approx:
        return _popularity_columns(CHAIN_POPULARITY.sketch_finish(CHAIN_POPULARITY.sketch_state(requests)))
    return _popularity_columns(CHAIN_POPULARITY.compute(requests))


def expensive_method_usage(requests: DataFrame, units: DataFrame) -> DataFrame:
    """Calls of at least ten compute units, with the method's access flags.

    ``units`` is the method table, one row per method known to the product.
    """
    flags = units.select(
        "chain_type",
        F.col("method_name").alias("rpc_method"),
        F.coalesce(F.col("requires_archive"), F.lit(False)).cast("int").alias("_archive"),
        F.coalesce(F.col("requires_trace"), F.lit(False)).cast("int").alias("_trace"),
    )
    costly = requests.where(F.col("compute_units") >= EXPENSIVE_FROM_UNITS)
    return costly.join(flags, ["chain_type", "rpc_method"], "left").select(
        "event_time",
        "consumer_id",
        "organization_id",
        "chain_slug",
        "rpc_method",
        "compute_units",
        "latency_ms",
        F.coalesce("_archive", F.lit(0)).alias("requires_archive"),
        F.coalesce("_trace", F.lit(0)).alias("requires_trace"),
        "status_code",
    )


# Each rollup with the function from its finished metrics to its table's columns.
ROLLUPS: dict[str, tuple[Rollup, Callable[[DataFrame], DataFrame]]] = {
    "latency_metrics": (LATENCY_METRICS, _latency_columns),
    "chain_health": (CHAIN_HEALTH, _health_columns),
    "chain_method_usage": (CHAIN_METHOD_USAGE, _method_columns),
    "chain_org_usage": (CHAIN_ORG_USAGE, _org_columns),
    "chain_popularity": (CHAIN_POPULARITY, _popularity_columns),
    "usage_hourly": (USAGE_HOURLY, usage_shape(USAGE_HOURLY)),
    "usage_daily": (USAGE_DAILY, usage_shape(USAGE_DAILY)),
}
