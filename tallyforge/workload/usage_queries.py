"""Queries over rollups, reports and dashboards."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.operators import rollups, usage
from tallyforge.plans import dashboards, reports
from tallyforge.session import scratch_path
from tallyforge.sources import requests as sources
from tallyforge.sources.catalog import seed_method_units
from tallyforge.workload.fixtures import AS_OF, load, load_catalog
from tallyforge.workload.registry import query

START, END = "2024-01-01 00:00:00", "2024-01-31 23:59:59"
WEEK = (datetime(2024, 1, 23, 0, 0, 0), datetime(2024, 1, 29, 23, 59, 59))


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "requests")[0]


def _daily(spark: SparkSession, sf_dir: str, *values: str) -> DataFrame:
    return usage.usage_daily_state_from_log(_log(spark, sf_dir), values)


def _hourly(spark: SparkSession, sf_dir: str, *values: str) -> DataFrame:
    return usage.usage_hourly_state(_log(spark, sf_dir), values)


def _count(condition: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT)"


def _sum(column: str) -> str:
    return f"CAST(sum({column}) AS BIGINT)"


def _pct(condition: str) -> str:
    return f"round(CAST(count(*) FILTER (WHERE {condition}) AS DOUBLE) / count(*) * 100, 6)"


def _quantile(q: float, column: str = "latency_ms") -> str:
    return f"round(quantile_cont({column}, {q}), 4)"


_GB = "round(CAST(sum(response_size) AS DOUBLE) / 1073741824e0, 6)"

_TENANT = "organization_id, consumer_id, api_key_prefix, plan_slug, chain_slug, chain_type"
_USAGE = f"""
  CAST(count(*) AS BIGINT) AS request_count,
  {_count("is_error = 1")} AS error_count,
  {_sum("compute_units")} AS compute_units_used,
  {_count("status_code BETWEEN 200 AND 299")} AS status_2xx_count,
  {_count("status_code BETWEEN 400 AND 499")} AS status_4xx_count,
  {_count("status_code >= 500")} AS status_5xx_count,
  {_sum("response_size")} AS total_response_size,
  round(avg(latency_ms), 6) AS latency_avg,
  {_quantile(0.5)} AS latency_p50, {_quantile(0.95)} AS latency_p95, {_quantile(0.99)} AS latency_p99,
  CAST(max(latency_ms) AS BIGINT) AS latency_max,
  {_quantile(0.5, "upstream_latency_ms")} AS upstream_p50, {_quantile(0.95, "upstream_latency_ms")} AS upstream_p95,
  {_quantile(0.99, "upstream_latency_ms")} AS upstream_p99
"""

# Sources and sinks


@query(
    "read_requests",
    sql="""SELECT event_time, request_id, route_name, consumer_id, status_code, latency_ms, rpc_method, event_date
    FROM requests WHERE event_time BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-31 00:00:00'""",
)
def _(spark, sf_dir):
    path = scratch_path(spark, "requests")
    sources.write_table(_log(spark, sf_dir), path, "requests")
    log = sources.read_requests(spark, path, start="2024-01-05 06:00:00", end="2024-01-31 00:00:00")
    return log.select(
        "event_time", "request_id", "route_name", "consumer_id", "status_code", "latency_ms", "rpc_method", "event_date"
    )


@query(
    "write_rollup",
    sql="""SELECT strftime(event_date, '%Y%m') AS event_month, event_date, organization_id, chain_slug, plan_slug,
      CAST(count(*) AS BIGINT) AS request_count, CAST(sum(compute_units) AS BIGINT) AS compute_units_used
    FROM requests GROUP BY ALL""",
)
def _(spark, sf_dir):
    path = scratch_path(spark, "chain_org_usage")
    sources.write_table(rollups.chain_org_usage(_log(spark, sf_dir)), path, "chain_org_usage")
    # The month is a folder name, which is read back as a number.
    return spark.read.parquet(path).select(
        F.col("event_month").cast("string").alias("event_month"),
        "event_date",
        "organization_id",
        "chain_slug",
        "plan_slug",
        "request_count",
        "compute_units_used",
    )


@query(
    "apply_retention",
    sql="""SELECT request_id, event_time FROM requests
    WHERE event_time + INTERVAL 14 DAY > TIMESTAMP '2024-01-31 00:00:00'""",
)
def _(spark, sf_dir):
    kept = sources.apply_retention(_log(spark, sf_dir), "event_time", "requests", AS_OF)
    return kept.select("request_id", "event_time")


@query(
    "expired_partitions",
    sql="""SELECT DISTINCT event_date FROM requests
    WHERE event_date + INTERVAL 15 DAY <= TIMESTAMP '2024-01-31 00:00:00'""",
)
def _(spark, sf_dir):
    return sources.expired_partitions(_log(spark, sf_dir), "event_date", "requests", AS_OF)


@query(
    "table_counts",
    ["requests", "c_organizations", "c_subscriptions", "c_api_keys"],
    """SELECT 'requests' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM requests
    UNION ALL SELECT 'errors', CAST(count(*) AS BIGINT) FROM requests WHERE is_error = 1
    UNION ALL SELECT 'organizations', CAST(count(*) AS BIGINT) FROM c_organizations
    UNION ALL SELECT 'subscriptions', CAST(count(*) AS BIGINT) FROM c_subscriptions
    UNION ALL SELECT 'api_keys', CAST(count(*) AS BIGINT) FROM c_api_keys""",
)
def _(spark, sf_dir):
    log, catalog = _log(spark, sf_dir), load_catalog(spark, sf_dir)
    tables = {"requests": log, "errors": rollups.errors(log)}
    tables |= {name: catalog[name] for name in ("organizations", "subscriptions", "api_keys")}
    return sources.table_counts(tables)


# Rollups


@query(
    "usage_hourly",
    sql=f"""SELECT date_trunc('hour', event_time) AS hour, {_TENANT}, route_name, rpc_method, {_USAGE}
    FROM requests GROUP BY date_trunc('hour', event_time), {_TENANT}, route_name, rpc_method""",
)
def _(spark, sf_dir):
    return usage.usage_hourly(_log(spark, sf_dir))


@query("usage_daily", sql=f"SELECT event_date, {_TENANT}, {_USAGE} FROM requests GROUP BY event_date, {_TENANT}")
def _(spark, sf_dir):
    return usage.usage_daily(_log(spark, sf_dir))


@query(
    "usage_daily_state",
    sql=f"""SELECT event_date, {_TENANT}, {_USAGE} FROM requests GROUP BY event_date, {_TENANT}""",
)
def _(spark, sf_dir):
    daily = usage.usage_daily_state(_hourly(spark, sf_dir, "latency", "upstream"))
    return usage.usage_shape(usage.USAGE_DAILY)(usage.USAGE_DAILY.finish(daily))


@query(
    "usage_daily_state_from_log",
    sql=f"""SELECT event_date, {_TENANT}, 'latency' AS facet, CAST(latency_ms AS BIGINT) AS value, CAST(count(*) AS BIGINT) AS n
    FROM requests GROUP BY ALL
    UNION ALL SELECT event_date, {_TENANT}, 'upstream', CAST(upstream_latency_ms AS BIGINT), CAST(count(*) AS BIGINT)
    FROM requests GROUP BY event_date, {_TENANT}, upstream_latency_ms
    UNION ALL SELECT event_date, {_TENANT}, 'request_count', CAST(NULL AS BIGINT), CAST(count(*) AS BIGINT)
    FROM requests GROUP BY event_date, {_TENANT}
    UNION ALL SELECT event_date, {_TENANT}, 'latency_max', CAST(NULL AS BIGINT), CAST(max(latency_ms) AS BIGINT)
    FROM requests GROUP BY event_date, {_TENANT}""",
)
def _(spark, sf_dir):
    state = usage.usage_daily_state_from_log(_log(spark, sf_dir))
    rows = usage.USAGE_DAILY.unfold(state)
    keys = list(usage.USAGE_DAILY.keys)
    pairs = rows.where("facet <> 'total'").select(*keys, "facet", "value", "n")
    for measure in ("request_count", "latency_max"):
        total = rows.where("facet = 'total'").select(*keys, F.lit(measure).alias("facet"), "value", F.col(measure).alias("n"))
        pairs = pairs.unionByName(total)
    return pairs


@query(
    "finalize",
    sql=f"SELECT organization_id, chain_slug, {_USAGE} FROM requests GROUP BY organization_id, chain_slug",
)
def _(spark, sf_dir):
    keys = ["organization_id", "chain_slug"]
    done = usage.finalize(_daily(spark, sf_dir, "latency", "upstream"), keys, upstream=True)
    return done.drop("latency_sum")


@query(
    "errors",
    sql="""SELECT event_time, event_time_ms, request_id, organization_id, consumer_id, chain_slug,
      'http_error' AS error_type, error_message, '' AS error_stack, method, path, status_code, rpc_method, metadata
    FROM requests WHERE is_error = 1""",
)
def _(spark, sf_dir):
    return rollups.errors(_log(spark, sf_dir))


@query(
    "latency_metrics",
    sql=f"""SELECT date_trunc('minute', event_time) AS minute, route_name, upstream_host,
      {_count("latency_ms < 10")} AS latency_0_10ms,
      {_count("latency_ms >= 10 AND latency_ms < 50")} AS latency_10_50ms,
      {_count("latency_ms >= 50 AND latency_ms < 100")} AS latency_50_100ms,
      {_count("latency_ms >= 100 AND latency_ms < 500")} AS latency_100_500ms,
      {_count("latency_ms >= 500 AND latency_ms < 1000")} AS latency_500_1000ms,
      {_count("latency_ms >= 1000")} AS latency_1000ms_plus,
      {_quantile(0.5)} AS p50, {_quantile(0.95)} AS p95, {_quantile(0.99)} AS p99, {_quantile(0.999)} AS p999
    FROM requests GROUP BY ALL""",
)
def _(spark, sf_dir):
    return rollups.latency_metrics(_log(spark, sf_dir))


_HEALTH = f"""SELECT date_trunc('minute', event_time) AS minute, chain_slug, upstream_host,
  CASE WHEN count(*) FILTER (WHERE status_code < 500) > 0 THEN 1 ELSE 0 END AS is_healthy,
  {_count("status_code >= 500")} AS health_check_failures,
  round(avg(latency_ms), 6) AS avg_latency_ms, {_quantile(0.95)} AS p95_latency_ms, {_quantile(0.99)} AS p99_latency_ms,
  CAST(count(*) AS BIGINT) AS request_count, {_count("is_error = 1")} AS error_count,
  {_pct("is_error = 1")} AS error_rate, CAST(0 AS BIGINT) AS latest_block
FROM requests GROUP BY date_trunc('minute', event_time), chain_slug, upstream_host"""


@query("chain_health", sql=_HEALTH)
def _(spark, sf_dir):
    return rollups.chain_health(_log(spark, sf_dir))


_METHODS = f"""SELECT event_date, chain_slug, rpc_method, CAST(count(*) AS BIGINT) AS request_count,
  CAST(count(DISTINCT consumer_id) AS BIGINT) AS unique_consumers,
  CAST(count(DISTINCT organization_id) AS BIGINT) AS unique_organizations,
  {_sum("compute_units")} AS total_compute_units, round(avg(compute_units), 6) AS avg_compute_units,
  round(avg(latency_ms), 6) AS avg_latency_ms, {_quantile(0.95)} AS p95_latency_ms,
  {_count("is_error = 1")} AS error_count, {_pct("is_error = 1")} AS error_rate
FROM requests GROUP BY event_date, chain_slug, rpc_method"""


@query("chain_method_usage", sql=_METHODS)
def _(spark, sf_dir):
    return rollups.chain_method_usage(_log(spark, sf_dir))


@query(
    "chain_org_usage",
    sql=f"""SELECT event_date, organization_id, chain_slug, plan_slug, CAST(count(*) AS BIGINT) AS request_count,
      {_sum("compute_units")} AS compute_units_used, {_sum("response_size")} AS total_response_size,
      CAST(0 AS DOUBLE) AS estimated_cost
    FROM requests GROUP BY event_date, organization_id, chain_slug, plan_slug""",
)
def _(spark, sf_dir):
    return rollups.chain_org_usage(_log(spark, sf_dir))


@query(
    "chain_org_usage_priced",
    ["requests", "price_book"],
    f"""SELECT event_date, organization_id, chain_slug, r.plan_slug, CAST(count(*) AS BIGINT) AS request_count,
      {_sum("compute_units")} AS compute_units_used, {_sum("response_size")} AS total_response_size,
      round({_sum("compute_units")} * CAST(max(overage_rate) AS DOUBLE), 6) AS estimated_cost
    FROM requests r JOIN price_book p ON r.plan_slug = p.plan_slug
    GROUP BY event_date, organization_id, chain_slug, r.plan_slug""",
)
def _(spark, sf_dir):
    log, prices = load(spark, sf_dir, "requests", "price_book")
    return rollups.chain_org_usage(log, prices.withColumnRenamed("overage_rate", "price_per_unit"))


_POPULARITY = f"""SELECT date_trunc('hour', event_time) AS hour, chain_slug, CAST(count(*) AS BIGINT) AS request_count,
  CAST(count(DISTINCT consumer_id) AS BIGINT) AS unique_users, round(avg(latency_ms), 6) AS avg_latency_ms,
  {_pct("status_code BETWEEN 200 AND 299")} AS success_rate
FROM requests GROUP BY date_trunc('hour', event_time), chain_slug"""


@query("chain_popularity", sql=_POPULARITY)
def _(spark, sf_dir):
    return rollups.chain_popularity(_log(spark, sf_dir))


@query("chain_method_usage_approx")
def _(spark, sf_dir):
    return rollups.chain_method_usage(_log(spark, sf_dir), approx=True)


@query("usage_daily_approx")
def _(spark, sf_dir):
    hourly = usage.usage_hourly_state(_log(spark, sf_dir), approx=True)
    return usage.finalize(usage.usage_daily_state(hourly), ["event_date", "organization_id"])


_EXPENSIVE = """SELECT event_time, consumer_id, organization_id, chain_slug, r.rpc_method, r.compute_units, latency_ms,
  CASE WHEN m.requires_archive THEN 1 ELSE 0 END AS requires_archive,
  CASE WHEN m.requires_trace THEN 1 ELSE 0 END AS requires_trace, status_code
FROM requests r LEFT JOIN method_units m ON r.chain_type = m.chain_type AND r.rpc_method = m.rpc_method
WHERE r.compute_units >= 10"""


@query("expensive_method_usage", sql=_EXPENSIVE)
def _(spark, sf_dir):
    return rollups.expensive_method_usage(_log(spark, sf_dir), seed_method_units(spark))


@query(
    "keep_last",
    sql="""SELECT consumer_id, chain_slug, event_time_ms, request_id, status_code FROM (
      SELECT *, row_number() OVER (PARTITION BY consumer_id, chain_slug ORDER BY event_time_ms DESC, request_id DESC) AS rn
      FROM requests) WHERE rn = 1""",
)
def _(spark, sf_dir):
    rows = _log(spark, sf_dir).select("consumer_id", "chain_slug", "event_time_ms", "request_id", "status_code")
    return usage.keep_last(rows, ["consumer_id", "chain_slug"], ["event_time_ms", "request_id"])


@query(
    "collapse_sum",
    sql=f"""SELECT organization_id, chain_slug, CAST(count(*) AS BIGINT) AS request_count,
      {_sum("compute_units")} AS compute_units_used, {_sum("response_size")} AS total_response_size
    FROM requests GROUP BY organization_id, chain_slug""",
)
def _(spark, sf_dir):
    rows = rollups.chain_org_usage(_log(spark, sf_dir))
    return usage.collapse_sum(
        rows, ["organization_id", "chain_slug"], ["request_count", "compute_units_used", "total_response_size"]
    )


# Dashboards


@query(
    "top_consumers",
    sql="""SELECT organization_id, consumer_id, CAST(count(*) AS BIGINT) AS total_requests FROM requests
    WHERE date_trunc('hour', event_time) BETWEEN TIMESTAMP '2024-01-30 00:00:00' AND TIMESTAMP '2024-01-31 00:00:00'
    GROUP BY organization_id, consumer_id ORDER BY total_requests DESC, organization_id, consumer_id LIMIT 10""",
)
def _(spark, sf_dir):
    return dashboards.top_consumers(_hourly(spark, sf_dir), AS_OF)


@query(
    "error_rate_by_org",
    sql=f"""SELECT event_date, organization_id, {_pct("is_error = 1")} AS error_rate_pct FROM requests
    WHERE event_date BETWEEN DATE '2024-01-24' AND DATE '2024-01-31' GROUP BY event_date, organization_id""",
)
def _(spark, sf_dir):
    return dashboards.error_rate_by_org(_daily(spark, sf_dir), AS_OF)


@query(
    "latency_over_time",
    sql=f"""SELECT date_trunc('minute', event_time) AS minute, route_name, upstream_host,
      {_quantile(0.5)} AS p50, {_quantile(0.95)} AS p95, {_quantile(0.99)} AS p99 FROM requests
    WHERE date_trunc('minute', event_time) BETWEEN TIMESTAMP '2024-01-30 23:00:00' AND TIMESTAMP '2024-01-31 00:00:00'
    GROUP BY ALL""",
)
def _(spark, sf_dir):
    return dashboards.latency_over_time(rollups.latency_metrics(_log(spark, sf_dir)), AS_OF)


@query(
    "usage_by_plan",
    sql=f"""SELECT organization_id, plan_slug, CAST(count(*) AS BIGINT) AS total_requests, {_GB} AS total_gb
    FROM requests WHERE event_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' GROUP BY organization_id, plan_slug""",
)
def _(spark, sf_dir):
    return dashboards.usage_by_plan(_daily(spark, sf_dir), AS_OF)


_RECENT_HOURS = "WHERE hour BETWEEN TIMESTAMP '2024-01-30 00:00:00' AND TIMESTAMP '2024-01-31 00:00:00'"
_EXACT_POPULARITY = """SELECT date_trunc('hour', event_time) AS hour, chain_slug, count(*) AS n, avg(latency_ms) AS latency,
  CAST(count(*) FILTER (WHERE status_code BETWEEN 200 AND 299) AS DOUBLE) / count(*) * 100 AS success
FROM requests GROUP BY date_trunc('hour', event_time), chain_slug"""


@query(
    "top_chains",
    sql=f"""SELECT chain_slug, CAST(sum(n) AS BIGINT) AS total_requests, round(avg(latency), 6) AS avg_latency,
      round(avg(success), 6) AS success_rate_pct FROM ({_EXACT_POPULARITY}) {_RECENT_HOURS} GROUP BY chain_slug""",
)
def _(spark, sf_dir):
    return dashboards.top_chains(rollups.chain_popularity(_log(spark, sf_dir)), AS_OF)


@query(
    "top_chains_weighted",
    sql=f"""SELECT chain_slug, CAST(count(*) AS BIGINT) AS total_requests, round(avg(latency_ms), 6) AS avg_latency,
      {_pct("status_code BETWEEN 200 AND 299")} AS success_rate_pct
    FROM (SELECT *, date_trunc('hour', event_time) AS hour FROM requests) {_RECENT_HOURS} GROUP BY chain_slug""",
)
def _(spark, sf_dir):
    return dashboards.top_chains(rollups.chain_popularity(_log(spark, sf_dir)), AS_OF, weighted=True)


@query(
    "org_usage_by_chain",
    sql=f"""SELECT organization_id, chain_slug, CAST(count(*) AS BIGINT) AS requests, {_sum("compute_units")} AS cu_used,
      round(CAST(sum(response_size) AS DOUBLE) / 1048576e0, 6) AS mb_transferred
    FROM requests WHERE event_date >= DATE '2024-01-01' GROUP BY organization_id, chain_slug""",
)
def _(spark, sf_dir):
    return dashboards.org_usage_by_chain(rollups.chain_org_usage(_log(spark, sf_dir)), AS_OF)


@query(
    "popular_methods",
    sql="""SELECT chain_slug, rpc_method, CAST(sum(n) AS BIGINT) AS total_requests, round(avg(latency), 6) AS avg_latency,
      round(CAST(sum(e) AS DOUBLE) / sum(n) * 100, 6) AS error_rate_pct
    FROM (SELECT event_date, chain_slug, rpc_method, count(*) AS n, avg(latency_ms) AS latency, sum(is_error) AS e
      FROM requests GROUP BY event_date, chain_slug, rpc_method)
    WHERE event_date BETWEEN DATE '2024-01-24' AND DATE '2024-01-31' GROUP BY chain_slug, rpc_method""",
)
def _(spark, sf_dir):
    return dashboards.popular_methods(rollups.chain_method_usage(_log(spark, sf_dir)), AS_OF)


@query(
    "upstream_health",
    sql=f"""SELECT minute, chain_slug, upstream_host, is_healthy, avg_latency_ms, error_rate, request_count FROM ({_HEALTH})
    WHERE minute BETWEEN TIMESTAMP '2024-01-30 23:55:00' AND TIMESTAMP '2024-01-31 00:00:00'""",
)
def _(spark, sf_dir):
    return dashboards.upstream_health(rollups.chain_health(_log(spark, sf_dir)), AS_OF)


@query(
    "expensive_abusers",
    sql=f"""SELECT consumer_id, organization_id, chain_slug, rpc_method, CAST(count(*) AS BIGINT) AS usage_count,
      {_sum("compute_units")} AS total_cu, round(avg(latency_ms), 6) AS avg_latency FROM ({_EXPENSIVE})
    WHERE event_time BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-01-31 00:00:00'
    GROUP BY consumer_id, organization_id, chain_slug, rpc_method HAVING count(*) > 1
    ORDER BY total_cu DESC, consumer_id, organization_id, chain_slug, rpc_method LIMIT 20""",
)
def _(spark, sf_dir):
    # The test log has a few calls a day per consumer: the span is the month.
    calls = rollups.expensive_method_usage(_log(spark, sf_dir), seed_method_units(spark))
    return dashboards.expensive_abusers(calls, AS_OF, min_count=1, hours=30 * 24)


@query(
    "chain_volume",
    sql="""SELECT chain_slug, CAST(count(*) AS BIGINT) AS requests, round(avg(latency_ms), 2) AS avg_latency_ms FROM requests
    WHERE event_time BETWEEN TIMESTAMP '2024-01-30 00:00:00' AND TIMESTAMP '2024-01-31 00:00:00' GROUP BY chain_slug""",
)
def _(spark, sf_dir):
    return dashboards.chain_volume(_log(spark, sf_dir), AS_OF)


@query(
    "billing_usage",
    sql=f"""SELECT organization_id, chain_slug, CAST(count(*) AS BIGINT) AS total_requests,
      {_sum("compute_units")} AS total_compute_units, {_GB} AS total_egress_gb, {_quantile(0.95)} AS latency_p95
    FROM requests WHERE event_date >= DATE '2024-01-01' GROUP BY organization_id, chain_slug""",
)
def _(spark, sf_dir):
    return dashboards.billing_usage(_daily(spark, sf_dir, "latency"), AS_OF)


# Reports

_SUMMARY = f"""CAST(count(*) AS BIGINT) AS total_requests, coalesce({_sum("compute_units")}, 0) AS total_compute_units,
  coalesce({_GB}, 0) AS total_egress_gb, {_count("is_error = 1")} AS error_count,
  {_pct("is_error = 1")} AS error_rate_pct, {_quantile(0.95)} AS latency_p95"""
_SUCCESS = "round(100 - CAST(count(*) FILTER (WHERE is_error = 1) AS DOUBLE) / count(*) * 100, 6) AS success_rate_pct"
_BY_CHAIN = f"""chain_slug, chain_type, CAST(count(*) AS BIGINT) AS requests, {_sum("compute_units")} AS compute_units,
  {_GB} AS egress_gb, {_count("is_error = 1")} AS error_count, {_pct("is_error = 1")} AS error_rate_pct,
  {_quantile(0.95)} AS latency_p95"""
_BY_METHOD = f"""rpc_method AS method, CAST(count(*) AS BIGINT) AS requests, {_sum("compute_units")} AS compute_units,
  {_count("is_error = 1")} AS error_count, {_quantile(0.5)} AS latency_p50"""
_BY_DAY = f"""event_date, CAST(count(*) AS BIGINT) AS requests, {_sum("compute_units")} AS compute_units, {_GB} AS egress_gb,
  {_count("is_error = 1")} AS error_count, {_pct("is_error = 1")} AS error_rate_pct,
  {_pct("status_code BETWEEN 200 AND 299")} AS success_rate_pct"""
_BY_HOUR = f"""date_trunc('hour', event_time) AS hour, chain_slug, CAST(count(*) AS BIGINT) AS requests,
  {_sum("compute_units")} AS compute_units, {_GB} AS egress_gb, {_count("is_error = 1")} AS error_count,
  {_quantile(0.5)} AS latency_p50, {_quantile(0.95)} AS latency_p95, {_quantile(0.99)} AS latency_p99"""


@query("usage_summary", sql=f"SELECT {_SUMMARY}, {_quantile(0.99)} AS latency_p99, {_SUCCESS} FROM requests")
def _(spark, sf_dir):
    return reports.usage_summary(_daily(spark, sf_dir, "latency"), None, START, END)


@query(
    "usage_by_chain",
    sql=f"SELECT {_BY_CHAIN} FROM requests GROUP BY chain_slug, chain_type",
)
def _(spark, sf_dir):
    return reports.usage_by_chain(_daily(spark, sf_dir, "latency"), None, START, END)


@query(
    "usage_by_method",
    sql=f"SELECT {_BY_METHOD} FROM requests WHERE rpc_method <> '' GROUP BY rpc_method",
)
def _(spark, sf_dir):
    return reports.usage_by_method(_hourly(spark, sf_dir, "latency"), None, "2024-01-01", "2024-01-31")


@query("daily_usage", sql=f"SELECT {_BY_DAY} FROM requests GROUP BY event_date")
def _(spark, sf_dir):
    return reports.daily_usage(_daily(spark, sf_dir), None, START, END)


@query(
    "hourly_usage",
    sql=f"""SELECT {_BY_HOUR} FROM requests
    WHERE date_trunc('hour', event_time) BETWEEN TIMESTAMP '2024-01-23 00:00:00' AND TIMESTAMP '2024-01-29 23:59:59'
    GROUP BY date_trunc('hour', event_time), chain_slug""",
)
def _(spark, sf_dir):
    return reports.hourly_usage(_hourly(spark, sf_dir, "latency"), None, *WEEK)


@query(
    "api_key_usage",
    sql=f"""SELECT api_key_prefix AS key_prefix, min(organization_id) AS organization_id, {_SUMMARY}, {_SUCCESS}
    FROM requests GROUP BY api_key_prefix""",
)
def _(spark, sf_dir):
    return reports.api_key_usage(_daily(spark, sf_dir, "latency"), None, START, END)


@query(
    "usage_report",
    ["requests", "c_organizations", "c_plans", "c_subscriptions"],
    f""", plan_of AS (SELECT organization_id, slug FROM (
        SELECT s.organization_id, p.slug, row_number() OVER (PARTITION BY s.organization_id
          ORDER BY current_period_start DESC NULLS LAST, s.id) AS rn
        FROM c_subscriptions s JOIN c_plans p ON s.plan_id = p.id WHERE s.status = 'active') WHERE rn = 1),
      chains AS (SELECT organization_id, {_BY_CHAIN} FROM requests GROUP BY organization_id, chain_slug, chain_type),
      methods AS (SELECT organization_id, {_BY_METHOD} FROM requests WHERE rpc_method <> '' GROUP BY organization_id, rpc_method)
    SELECT o.id, o.name, coalesce(p.slug, '') AS plan_slug, s.total_requests, s.success_rate_pct,
      (SELECT string_agg(chain_slug || ':' || requests, ',' ORDER BY requests DESC, chain_slug) FROM chains c
        WHERE c.organization_id = o.id) AS chains,
      (SELECT string_agg(method || ':' || requests, ',' ORDER BY requests DESC, method) FROM methods m
        WHERE m.organization_id = o.id) AS methods
    FROM c_organizations o LEFT JOIN plan_of p ON o.id = p.organization_id
    JOIN (SELECT organization_id, count(*) AS total_requests, {_SUCCESS} FROM requests GROUP BY organization_id) s
      ON s.organization_id = o.id""",
)
def _(spark, sf_dir):
    daily, hourly = _daily(spark, sf_dir, "latency"), _hourly(spark, sf_dir, "latency")
    nested = reports.usage_report(daily, hourly, load_catalog(spark, sf_dir), None, START, END, breakdown=True)

    def listed(column, label):
        pair = lambda row: F.concat(row[label], F.lit(":"), row["requests"].cast("string"))
        return F.array_join(F.transform(column, pair), ",")

    return nested.select(
        "organization.id",
        "organization.name",
        "organization.plan_slug",
        "summary.total_requests",
        "summary.success_rate_pct",
        listed("by_chain", "chain_slug").alias("chains"),
        listed("top_methods", "method").alias("methods"),
    )


def _bulk(grain: str, *values: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # A grain reads one of the two states.
        state = (_hourly if grain in ("method", "hourly") else _daily)(spark, sf_dir, *values)
        return reports.usage_reports_all(state, state, START, END, grain)

    return run


query(
    "usage_reports_all_summary",
    sql=f"""SELECT organization_id, {_SUMMARY}, {_quantile(0.99)} AS latency_p99, {_SUCCESS}
    FROM requests GROUP BY organization_id""",
)(_bulk("summary", "latency"))
query(
    "usage_reports_all_chain",
    sql=f"SELECT organization_id, {_BY_CHAIN} FROM requests GROUP BY organization_id, chain_slug, chain_type",
)(_bulk("chain", "latency"))
query(
    "usage_reports_all_method",
    sql=f"SELECT organization_id, {_BY_METHOD} FROM requests WHERE rpc_method <> '' GROUP BY organization_id, rpc_method",
)(_bulk("method", "latency"))
query(
    "usage_reports_all_daily",
    sql=f"SELECT organization_id, {_BY_DAY} FROM requests GROUP BY organization_id, event_date",
)(_bulk("daily"))
query(
    "usage_reports_all_hourly",
    sql=f"SELECT organization_id, {_BY_HOUR} FROM requests GROUP BY organization_id, date_trunc('hour', event_time), chain_slug",
)(_bulk("hourly", "latency"))


@query(
    "page",
    sql=f"""SELECT organization_id, consumer_id, CAST(count(*) AS BIGINT) AS requests FROM requests
    GROUP BY organization_id, consumer_id ORDER BY requests DESC, organization_id, consumer_id LIMIT 25 OFFSET 10""",
)
def _(spark, sf_dir):
    from tallyforge.operators.catalog import page

    counted = _log(spark, sf_dir).groupBy("organization_id", "consumer_id").agg(F.count(F.lit(1)).alias("requests"))
    return page(counted, [F.col("requests").desc(), "organization_id", "consumer_id"], 25, 10)
