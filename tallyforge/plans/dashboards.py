"""Dashboard queries over the rollups.

Each covers a span that ends at ``as_of``; nothing later is counted, so a
past ``as_of`` gives what was shown then.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.measures import ago, at, gigabytes, megabytes, percent, ratio, within
from tallyforge.operators.usage import finalize

Moment = datetime | str


def _since(df: DataFrame, column: str, as_of: Moment, interval: str) -> DataFrame:
    return within(df, column, ago(as_of, interval), at(as_of))


def _last_days(df: DataFrame, as_of: Moment, days: int) -> DataFrame:
    today = at(as_of).cast("date")
    return within(df, "event_date", F.date_sub(today, days), today)


def _this_month(df: DataFrame, as_of: Moment) -> DataFrame:
    today = at(as_of).cast("date")
    return within(df, "event_date", F.trunc(today, "month"), today)


def top_consumers(hourly_state: DataFrame, as_of: Moment, n: int = 10, hours: int = 24) -> DataFrame:
    """The busiest consumers of the last day."""
    recent = _since(hourly_state, "hour", as_of, f"{hours} HOURS")
    done = finalize(recent, ["organization_id", "consumer_id"], ())
    return (
        done.select("organization_id", "consumer_id", F.col("request_count").alias("total_requests"))
        .orderBy(F.col("total_requests").desc(), "organization_id", "consumer_id")
        .limit(n)
    )


def error_rate_by_org(daily_state: DataFrame, as_of: Moment, days: int = 7) -> DataFrame:
    """Error share per day and organisation."""
    done = finalize(_last_days(daily_state, as_of, days), ["event_date", "organization_id"], ())
    return done.select(
        "event_date",
        "organization_id",
        percent(F.col("error_count"), F.col("request_count")).alias("error_rate_pct"),
    ).orderBy(F.col("event_date").desc(), F.col("error_rate_pct").desc(), "organization_id")


def latency_over_time(latency: DataFrame, as_of: Moment, hours: int = 1) -> DataFrame:
    """Latency percentiles per minute, route and upstream of the last hour."""
    return (
        _since(latency, "minute", as_of, f"{hours} HOURS")
        .select("minute", "route_name", "upstream_host", "p50", "p95", "p99")
        .orderBy(F.col("minute").desc(), "route_name", "upstream_host")
    )


def usage_by_plan(daily_state: DataFrame, as_of: Moment) -> DataFrame:
    """C4: month-to-date requests and traffic by organisation and plan."""
    done = finalize(_this_month(daily_state, as_of), ["organization_id", "plan_slug"], ())
    return done.select(
        "organization_id",
        "plan_slug",
        F.col("request_count").alias("total_requests"),
        gigabytes(F.col("total_response_size")).alias("total_gb"),
    ).orderBy(F.col("total_requests").desc(), "organization_id", "plan_slug")


def top_chains(popularity: DataFrame, as_of: Moment, weighted: bool = False, hours: int = 24) -> DataFrame:
    """Chains by requests; the means are of the hourly figures unless ``weighted``."""
    recent = _since(popularity, "hour", as_of, f"{hours} HOURS")
    requests = F.sum("request_count")

    def mean(column: str) -> Column:
        if weighted:
            return ratio(F.sum(F.col(column) * F.col("request_count")), requests)
        return F.avg(column)

    return (
        recent.groupBy("chain_slug")
        .agg(
            requests.alias("total_requests"),
            mean("avg_latency_ms").alias("avg_latency"),
            mean("success_rate").alias("success_rate_pct"),
        )
        .orderBy(F.col("total_requests").desc(), "chain_slug")
    )


def org_usage_by_chain(org_usage: DataFrame, as_of: Moment) -> DataFrame:
    """Month-to-date usage by organisation and chain."""
    return (
        _this_month(org_usage, as_of)
        .groupBy("organization_id", "chain_slug")
        .agg(
            F.sum("request_count").alias("requests"),
            F.sum("compute_units_used").alias("cu_used"),
            megabytes(F.sum("total_response_size")).alias("mb_transferred"),
        )
        .orderBy(F.col("requests").desc(), "organization_id", "chain_slug")
    )


def popular_methods(method_usage: DataFrame, as_of: Moment, days: int = 7, weighted: bool = False) -> DataFrame:
    """Methods per chain of the last week; the mean is of the daily figures unless ``weighted``."""
    requests = F.sum("request_count")
    mean = F.avg("avg_latency_ms")
    if weighted:
        mean = ratio(F.sum(F.col("avg_latency_ms") * F.col("request_count")), requests)
    return (
        _last_days(method_usage, as_of, days)
        .groupBy("chain_slug", "rpc_method")
        .agg(
            requests.alias("total_requests"),
            mean.alias("avg_latency"),
            percent(F.sum("error_count"), requests).alias("error_rate_pct"),
        )
        .orderBy("chain_slug", F.col("total_requests").desc(), "rpc_method")
    )


def upstream_health(health: DataFrame, as_of: Moment, minutes: int = 5) -> DataFrame:
    """The latest health rows of each upstream."""
    return (
        _since(health, "minute", as_of, f"{minutes} MINUTES")
        .select("minute", "chain_slug", "upstream_host", "is_healthy", "avg_latency_ms", "error_rate", "request_count")
        .orderBy("chain_slug", "upstream_host", "minute")
    )


def expensive_abusers(
    expensive: DataFrame, as_of: Moment, min_count: int = 100, n: int = 20, hours: int = 1
) -> DataFrame:
    """Who called one expensive method more than ``min_count`` times in the last hour."""
    keys = ["consumer_id", "organization_id", "chain_slug", "rpc_method"]
    return (
        _since(expensive, "event_time", as_of, f"{hours} HOURS")
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("usage_count"),
            F.sum("compute_units").alias("total_cu"),
            F.avg("latency_ms").alias("avg_latency"),
        )
        .where(F.col("usage_count") > min_count)
        .orderBy(F.col("total_cu").desc(), *keys)
        .limit(n)
    )


def chain_volume(requests: DataFrame, as_of: Moment, hours: int = 24) -> DataFrame:
    """Requests and mean latency per chain of the last day."""
    return (
        _since(requests, "event_time", as_of, f"{hours} HOURS")
        .groupBy("chain_slug")
        .agg(F.count(F.lit(1)).alias("requests"), F.round(F.avg("latency_ms"), 2).alias("avg_latency_ms"))
        .orderBy(F.col("requests").desc(), "chain_slug")
    )


def billing_usage(daily_state: DataFrame, as_of: Moment, org: str | None = None) -> DataFrame:
    """C11: month-to-date billing figures per organisation and chain."""
    month = _this_month(daily_state, as_of)
    if org is not None:
        month = month.where(F.col("organization_id") == org)
    done = finalize(month, ["organization_id", "chain_slug"], (0.95,))
    return done.select(
        "organization_id",
        "chain_slug",
        F.col("request_count").alias("total_requests"),
        F.col("compute_units_used").alias("total_compute_units"),
        gigabytes(F.col("total_response_size")).alias("total_egress_gb"),
        "latency_p95",
    )
