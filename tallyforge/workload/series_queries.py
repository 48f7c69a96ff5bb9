"""Queries over series, alerts, limits and billing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.operators import billing, ledger, limits, series
from tallyforge.operators.usage import usage_daily_state_from_log
from tallyforge.operators.currency import convert
from tallyforge.session import scratch_path
from tallyforge.workload.fixtures import load, load_catalog
from tallyforge.workload.registry import query


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "requests")[0]


def _grid(window: str, step: str, source: str = "requests") -> str:
    """Each request with every evaluation time whose window covers it."""
    bucket = f"time_bucket(INTERVAL '{step}', event_time, TIMESTAMP '1970-01-01 00:00:00')"
    times = f"generate_series({bucket} + INTERVAL '{step}', {bucket} + INTERVAL '{window}', INTERVAL '{step}')"
    return f"(SELECT *, unnest({times}) AS eval_time FROM {source})"


def _rate(by: str, window: str, step: str, seconds: int, source: str = "requests", amount: str = "count(*)") -> str:
    return f"""SELECT eval_time, {by}, round(CAST({amount} AS DOUBLE) / {seconds}, 6) AS value
    FROM {_grid(window, step, source)} GROUP BY eval_time, {by}"""


def _held(rows: str, by: str, step: str, hold: str) -> str:
    """Runs of consecutive steps, told by the gap to the row before."""
    return f"""SELECT eval_time, {by}, value, CASE WHEN eval_time - active_since >= INTERVAL '{hold}' THEN 'firing'
        ELSE 'pending' END AS state, active_since
    FROM (SELECT *, min(eval_time) OVER (PARTITION BY {by}, run) AS active_since
      FROM (SELECT *, sum(CASE WHEN gap THEN 1 ELSE 0 END) OVER (PARTITION BY {by} ORDER BY eval_time) AS run
        FROM (SELECT *, coalesce(eval_time - lag(eval_time) OVER (PARTITION BY {by} ORDER BY eval_time)
          > INTERVAL '{step}', true) AS gap FROM ({rows}))))"""


# Series.  The test log has about one request in five minutes, so windows are hours.


@query("rate", sql=_rate("consumer_id", "1 minute", "1 minute", 60))
def _(spark, sf_dir):
    return series.rate(_log(spark, sf_dir), ["consumer_id"])


@query("rate_sliding", sql=_rate("route_name, status_code", "6 hours", "1 hour", 21600))
def _(spark, sf_dir):
    return series.rate(_log(spark, sf_dir), ["route_name", "status_code"], "6 hours", "1 hour")


@query(
    "success_ratio",
    sql=f"""SELECT eval_time, consumer_id, round(CAST(count(*) FILTER (WHERE status_code BETWEEN 200 AND 299) AS DOUBLE)
      / count(*), 6) AS value FROM {_grid("12 hours", "6 hours")} GROUP BY eval_time, consumer_id""",
)
def _(spark, sf_dir):
    return series.success_ratio(_log(spark, sf_dir), ["consumer_id"], "12 hours", "6 hours")


@query(
    "topk",
    sql=f"""SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY eval_time
      ORDER BY value DESC, consumer_id) AS place FROM ({_rate("consumer_id", "6 hours", "1 hour", 21600)})) WHERE place <= 5""",
)
def _(spark, sf_dir):
    return series.topk(series.rate(_log(spark, sf_dir), ["consumer_id"], "6 hours", "1 hour"), 5)


@query("byte_rate", sql=_rate("route_name", "1 hour", "30 minutes", 3600, amount="sum(response_size)"))
def _(spark, sf_dir):
    return series.byte_rate(_log(spark, sf_dir), ["route_name"], "1 hour", "30 minutes")


@query(
    "histogram_quantile",
    sql=f""", counted AS (SELECT eval_time, route_name,
        CASE WHEN latency_ms <= 10 THEN 10 WHEN latency_ms <= 50 THEN 50 WHEN latency_ms <= 100 THEN 100
          WHEN latency_ms <= 500 THEN 500 WHEN latency_ms <= 1000 THEN 1000 ELSE 1e18 END AS le, count(*) AS n
        FROM {_grid("6 hours", "1 hour")} GROUP BY ALL),
      walked AS (SELECT *, sum(n) OVER (PARTITION BY eval_time, route_name ORDER BY le) AS through,
        0.95e0 * sum(n) OVER (PARTITION BY eval_time, route_name) AS target,
        CASE le WHEN 50 THEN 10 WHEN 100 THEN 50 WHEN 500 THEN 100 WHEN 1000 THEN 500 ELSE 0 END AS below FROM counted),
      hit AS (SELECT *, row_number() OVER (PARTITION BY eval_time, route_name ORDER BY le) AS place
        FROM walked WHERE through >= target)
    SELECT eval_time, route_name, round(CASE WHEN le = 1e18 THEN 1000
      ELSE below + (le - below) * (target - (through - n)) / n END, 6) AS value FROM hit WHERE place = 1""",
)
def _(spark, sf_dir):
    buckets = series.latency_buckets(_log(spark, sf_dir), ["route_name"], window="6 hours", step="1 hour")
    return series.histogram_quantile(buckets, 0.95, ["eval_time", "route_name"])


_WATCHED = "(SELECT * FROM requests WHERE regexp_full_match(rpc_method, '.*trace.*|.*debug.*|eth_getLogs'))"
_TRACES = "(SELECT * FROM requests WHERE regexp_full_match(rpc_method, 'debug_.*|trace_.*'))"


@query("filter_method", sql=_rate("rpc_method", "6 hours", "1 hour", 21600, _WATCHED))
def _(spark, sf_dir):
    watched = series.filter_method(_log(spark, sf_dir), series.WATCHED_METHODS)
    return series.rate(watched, ["rpc_method"], "6 hours", "1 hour")


@query(
    "hold_for",
    sql=_held(f"SELECT * FROM ({_rate('chain_slug', '2 hours', '1 hour', 7200)}) WHERE value > 0.0003", "chain_slug", "1 hour", "4 hours"),
)
def _(spark, sf_dir):
    rates = series.rate(_log(spark, sf_dir), ["chain_slug"], "2 hours", "1 hour")
    busy = rates.where(F.round("value", 6) > 0.0003)
    return series.hold_for(busy, ["chain_slug"], "1 hour", "4 hours")


@query(
    "alert_rejection_rate",
    sql=_held(
        f"""SELECT * FROM (SELECT eval_time, consumer_id, round(CAST(count(*) FILTER (WHERE status_code = 429) AS DOUBLE)
          / count(*), 6) AS value FROM {_grid("2 days", "6 hours")} GROUP BY eval_time, consumer_id) WHERE value > 0.1""",
        "consumer_id", "6 hours", "12 hours",
    ),
)
def _(spark, sf_dir):
    return series.alert_rejection_rate(_log(spark, sf_dir), 0.1, "2 days", "6 hours", "12 hours")


def _share(condition: str, by: str, window: str, step: str, hold: str, threshold: float) -> str:
    return _held(
        f"""SELECT * FROM (SELECT eval_time, {by}, round(CAST(count(*) FILTER (WHERE {condition}) AS DOUBLE) / count(*), 6) AS value
          FROM {_grid(window, step)} GROUP BY eval_time, {by}) WHERE value > {threshold}""",
        by, step, hold,
    )


@query("alert_server_errors", sql=_share("status_code BETWEEN 500 AND 599", "route_name", "12 hours", "3 hours", "6 hours", 0.04))
def _(spark, sf_dir):
    return series.alert_server_errors(_log(spark, sf_dir), 0.04, "12 hours", "3 hours", "6 hours")


@query(
    "alert_failing_upstreams",
    sql=_share("status_code BETWEEN 500 AND 599", "chain_slug, upstream_host", "6 hours", "2 hours", "4 hours", 0.1),
)
def _(spark, sf_dir):
    return series.alert_failing_upstreams(_log(spark, sf_dir), 0.1, "6 hours", "2 hours", "4 hours")


@query(
    "alert_expensive",
    sql=_held(
        f"SELECT * FROM ({_rate('consumer_id, rpc_method', '2 days', '12 hours', 172800, _TRACES)}) WHERE value > 0.000008",
        "consumer_id, rpc_method", "12 hours", "1 day",
    ),
)
def _(spark, sf_dir):
    return series.alert_expensive(_log(spark, sf_dir), 0.000008, "2 days", "12 hours", "1 day")


@query(
    "alert_429_spike",
    sql=_held(
        f"""SELECT * FROM ({_rate('route_name, consumer_id', '3 days', '1 day', 259200,
          "(SELECT * FROM requests WHERE status_code = 429)")}) WHERE value > 0.000003""",
        "route_name, consumer_id", "1 day", "2 days",
    ),
)
def _(spark, sf_dir):
    return series.alert_429_spike(_log(spark, sf_dir), 0.000003, "3 days", "1 day", "2 days")


@query(
    "alert_near_limit",
    ["requests", "low_limit_plans"],
    _held(
        """SELECT eval_time, consumer_id, plan_slug, CAST(n AS DOUBLE) AS value FROM (
          SELECT date_trunc('minute', event_time) + INTERVAL '1 minute' AS eval_time, consumer_id, plan_slug, count(*) AS n
          FROM requests GROUP BY ALL) JOIN low_limit_plans p ON plan_slug = p.slug WHERE n > 0.8 * rate_limit_per_minute""",
        "consumer_id, plan_slug", "1 minute", "5 minutes",
    ),
)
def _(spark, sf_dir):
    log, plans = load(spark, sf_dir, "requests", "low_limit_plans")
    return series.alert_near_limit(log, plans)


@query(
    "alert_plan_violation",
    sql=_held(
        _rate("consumer_id", "1 day", "6 hours", 86400, "(SELECT * FROM requests WHERE status_code = 403 AND plan_slug = 'free')"),
        "consumer_id", "6 hours", "12 hours",
    ),
)
def _(spark, sf_dir):
    return series.alert_plan_violation(_log(spark, sf_dir), "1 day", "6 hours", "12 hours")


@query(
    "alert_compute_units",
    sql=_held(
        f"""SELECT * FROM ({_rate('consumer_id, plan_slug', '1 day', '6 hours', 86400, amount='sum(compute_units)')})
        WHERE value > 0.0005""",
        "consumer_id, plan_slug", "6 hours", "12 hours",
    ),
)
def _(spark, sf_dir):
    return series.alert_compute_units(_log(spark, sf_dir), 0.0005, "1 day", "6 hours", "12 hours")


@query(
    "slo_report",
    sql="""SELECT *, latency_p95 < 300 AS latency_ok, error_rate_pct < 1 AS errors_ok, rejected_pct < 5 AS rejections_ok,
      availability_pct >= 99.9 AS availability_ok
    FROM (SELECT event_date, chain_slug, CAST(count(*) AS BIGINT) AS request_count,
      round(quantile_cont(latency_ms, 0.95), 4) AS latency_p95,
      round(CAST(sum(is_error) AS DOUBLE) / count(*) * 100, 6) AS error_rate_pct,
      round(CAST(count(*) FILTER (WHERE status_code = 429) AS DOUBLE) / count(*) * 100, 6) AS rejected_pct,
      round(CAST(count(*) FILTER (WHERE status_code < 500) AS DOUBLE) / count(*) * 100, 6) AS availability_pct
      FROM requests GROUP BY event_date, chain_slug)""",
)
def _(spark, sf_dir):
    return series.slo_report(_log(spark, sf_dir))


# Limits

_EVENT = "event_time, event_time_ms, organization_id, consumer_id, plan_slug, limit_type, limit_value, current_count"


def _ranked(unit: str, limit: str, scope: str = "consumer_id", amount: str = "count(*)", source: str = "requests") -> str:
    """Running use per scope and calendar unit."""
    return f"""SELECT event_time, event_time_ms, organization_id, consumer_id, plan_slug, '{unit}' AS limit_type,
      CAST({limit} AS BIGINT) AS limit_value,
      CAST({amount} OVER (PARTITION BY {scope}, date_trunc('{unit}', event_time) ORDER BY event_time_ms, request_id
        ROWS UNBOUNDED PRECEDING) AS BIGINT) AS current_count FROM {source}"""


def _beyond(*ranked: str) -> str:
    return f"SELECT {_EVENT} FROM ({' UNION ALL '.join(ranked)}) WHERE current_count > limit_value"


@query("fixed_window_limit", sql=_beyond(_ranked("hour", "1")))
def _(spark, sf_dir):
    return limits.fixed_window_limit(_log(spark, sf_dir), "consumer_id", 1, "hour")


@query(
    "fixed_window_limit_by_plan",
    ["requests", "test_limits"],
    _beyond(_ranked("day", "limit_per_day", source="requests JOIN test_limits USING (plan_slug)")),
)
def _(spark, sf_dir):
    log, daily = load(spark, sf_dir, "requests", "test_limits")
    return limits.fixed_window_limit(log, "consumer_id", daily.withColumnRenamed("limit_per_day", "limit_value"), "day")


def _plan_unit(unit: str) -> str:
    plan = "NULL" if unit == "second" else f"p.rate_limit_per_{unit}"
    source = f"""(SELECT r.*, coalesce(l.rate_limit_per_{unit}, {plan}) AS lim,
        CASE WHEN l.rate_limit_per_{unit} IS NOT NULL THEN chain_slug ELSE '' END AS scope
      FROM requests r JOIN low_limit_plans p ON r.plan_slug = p.slug
      LEFT JOIN c_plan_chain_limits l ON l.plan_id = p.id AND l.chain_id = 'chain-' || r.chain_slug)"""
    return _ranked(unit, "lim", "consumer_id, scope", source=f"{source} WHERE lim IS NOT NULL")


_PLAN_VIEWS = ["requests", "low_limit_plans", "c_plan_chain_limits"]
_PLAN_EVENTS = _beyond(*[_plan_unit(u) for u in ("second", "minute", "hour", "day")])


def _plan_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    log, plans = load(spark, sf_dir, "requests", "low_limit_plans")
    return log, {**load_catalog(spark, sf_dir), "plans": plans}


@query("plan_limit_events", _PLAN_VIEWS, _PLAN_EVENTS)
def _(spark, sf_dir):
    return limits.plan_limit_events(*_plan_inputs(spark, sf_dir))


@query("plan_limit_events_staged", _PLAN_VIEWS, _PLAN_EVENTS)
def _(spark, sf_dir):
    return limits.plan_limit_events(*_plan_inputs(spark, sf_dir), scratch_path(spark, "passed"))


def _quota_unit(unit: str) -> str:
    source = f"""(SELECT r.*, l.compute_units_per_{unit} AS lim FROM requests r
      JOIN c_plan_chain_limits l ON l.plan_id = 'plan-' || r.plan_slug AND l.chain_id = 'chain-' || r.chain_slug)"""
    return _ranked(unit, "lim", "consumer_id, chain_slug", "sum(compute_units)", f"{source} WHERE lim IS NOT NULL")


@query(
    "compute_quota", ["requests", "c_plan_chain_limits"], _beyond(*[_quota_unit(u) for u in ("second", "day")])
)
def _(spark, sf_dir):
    return limits.compute_quota(_log(spark, sf_dir), load_catalog(spark, sf_dir))


def _walk(capacity: int, refill: int, window: int) -> str:
    """The bucket walked second by second."""
    gained = f"(s.sec - w.refilled) // {window} * {refill}"
    tokens = f"CASE WHEN {gained} > 0 THEN least(w.tokens + {gained}, {capacity}) ELSE w.tokens END"
    return f""", s AS (SELECT consumer_id, event_time, CAST(epoch(event_time) AS BIGINT) AS sec, count(*) AS requests,
        row_number() OVER (PARTITION BY consumer_id ORDER BY event_time) AS rn FROM requests GROUP BY consumer_id, event_time),
      walk AS (SELECT consumer_id, event_time, rn, requests, least({capacity}, requests) AS allowed,
          {capacity} - least({capacity}, requests) AS tokens, sec AS refilled FROM s WHERE rn = 1
        UNION ALL
        SELECT s.consumer_id, s.event_time, s.rn, s.requests, least({tokens}, s.requests),
          ({tokens}) - least({tokens}, s.requests), CASE WHEN {gained} > 0 THEN s.sec ELSE w.refilled END
        FROM walk w JOIN s ON s.consumer_id = w.consumer_id AND s.rn = w.rn + 1)"""


_DECISIONS = """SELECT consumer_id, event_time, CAST(requests AS BIGINT) AS requests, CAST(allowed AS BIGINT) AS allowed,
  CAST(requests - allowed AS BIGINT) AS rejected FROM walk"""


@query("token_bucket", sql=_walk(2, 2, 86400) + _DECISIONS)
def _(spark, sf_dir):
    return limits.token_bucket(_log(spark, sf_dir), "consumer_id", 2, window="1 day")


@query("token_bucket_partial_refill", sql=_walk(5, 1, 43200) + _DECISIONS)
def _(spark, sf_dir):
    return limits.token_bucket(_log(spark, sf_dir), "consumer_id", 5, 1, "12 hours")


@query(
    "token_bucket_rejections",
    sql=_walk(2, 2, 86400)
    + """SELECT r.request_id, r.consumer_id, r.event_time FROM (SELECT *, row_number() OVER (
      PARTITION BY consumer_id, event_time ORDER BY event_time_ms, request_id) AS place FROM requests) r
    JOIN walk w ON r.consumer_id = w.consumer_id AND r.event_time = w.event_time WHERE place > allowed""",
)
def _(spark, sf_dir):
    log = _log(spark, sf_dir)
    decisions = limits.token_bucket(log, "consumer_id", 2, window="1 day")
    rejected = limits.token_bucket_rejections(log, decisions, "consumer_id", scratch_path(spark, "cut"))
    return rejected.select("request_id", "consumer_id", "event_time")


# Billing

_UNITS = "CAST(sum(compute_units) AS BIGINT) AS units"


def _metered(period: str = "month", where: str = "true") -> str:
    return f"""SELECT CAST(date_trunc('{period}', event_date) AS DATE) AS period_start, organization_id, plan_slug, chain_slug, {_UNITS}
    FROM requests WHERE {where} GROUP BY 1, organization_id, plan_slug, chain_slug"""


# The rule, not the code: weigh, take the included units off each organisation's plan once, share the rest by weight.
def _rated(period: str = "month") -> str:
    plan = "PARTITION BY period_start, organization_id, plan_slug"
    return f"""(SELECT * EXCLUDE (through, paid),
        CAST(through - coalesce(lag(through) OVER ({plan} ORDER BY chain_slug), 0) AS DECIMAL(18,4)) AS billable_units,
        CAST(paid - coalesce(lag(paid) OVER ({plan} ORDER BY chain_slug), 0) AS DECIMAL(18,2)) AS cost
      FROM (SELECT period_start, organization_id, plan_slug, chain_slug, units, weighted_units, through,
          CAST(round(through * overage_rate, 2) AS DECIMAL(18,2)) AS paid
        FROM (SELECT *, CASE WHEN whole > 0 THEN CAST(CAST((2 * CAST(so_far * 10000 AS HUGEINT)
              * CAST(greatest(whole - included_units, 0) * 10000 AS HUGEINT) + CAST(whole * 10000 AS HUGEINT))
              // (2 * CAST(whole * 10000 AS HUGEINT)) AS BIGINT) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(18,4)) ELSE 0 END AS through
          FROM (SELECT *, CAST(sum(weighted_units) OVER ({plan}) AS DECIMAL(18,4)) AS whole,
              CAST(sum(weighted_units) OVER ({plan} ORDER BY chain_slug) AS DECIMAL(18,4)) AS so_far
            FROM (SELECT m.*, CAST(p.included_units AS DECIMAL(18,4)) AS included_units, CAST(p.overage_rate AS DECIMAL(12,6)) AS overage_rate,
                CAST(m.units * CAST(coalesce(c.coefficient, 1) AS DECIMAL(9,4)) AS DECIMAL(18,4)) AS weighted_units
              FROM ({_metered(period)}) m JOIN price_book p ON m.plan_slug = p.plan_slug
              LEFT JOIN chain_coefficients c ON m.chain_slug = c.chain_slug)))))"""


_RATED_VIEWS = ["requests", "price_book", "chain_coefficients", "contracts", "fx_rates"]


def _meter_of(spark: SparkSession, sf_dir: str, period: str = "month", where: str = "true") -> DataFrame:
    return billing.meter(usage_daily_state_from_log(_log(spark, sf_dir).where(where), []), period)


def _rate_of(spark: SparkSession, sf_dir: str, period: str = "month") -> DataFrame:
    prices, coefficients = load(spark, sf_dir, "price_book", "chain_coefficients")
    return billing.rate_usage(_meter_of(spark, sf_dir, period), prices, coefficients)


@query("meter", sql=_metered("week"))
def _(spark, sf_dir):
    return _meter_of(spark, sf_dir, "week")


@query(
    "rate_usage",
    _RATED_VIEWS,
    f"""SELECT period_start, organization_id, plan_slug, chain_slug, units, CAST(weighted_units AS DOUBLE) AS weighted_units,
      CAST(billable_units AS DOUBLE) AS billable_units, CAST(cost AS DOUBLE) AS cost FROM {_rated()}""",
)
def _(spark, sf_dir):
    return _rate_of(spark, sf_dir)


def _written(df: DataFrame, label: str) -> DataFrame:
    """A table as a closed period keeps it: rated once, read by all that follows."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _owed(period: str = "month") -> str:
    return f"""(SELECT period_start, organization_id, coalesce(contract_type, 'METERED') AS contract_type,
      CASE WHEN contract_type IN ('FIXED', 'HYBRID') THEN CAST(price_fixed AS DECIMAL(18,2)) ELSE 0 END AS fixed_charge,
      CASE WHEN coalesce(contract_type, 'METERED') IN ('METERED', 'HYBRID') THEN coalesce(usage_cost, 0) ELSE 0 END AS usage_charge
    FROM (SELECT period_start, organization_id, CAST(sum(cost) AS DECIMAL(18,2)) AS usage_cost FROM {_rated(period)} GROUP BY ALL) u
    FULL JOIN (SELECT period_start, organization_id, contract_type, price_fixed FROM contracts, (SELECT DISTINCT period_start FROM ({_metered(period)}))
      WHERE period_start BETWEEN coalesce(start_date, DATE '0001-01-01') AND coalesce(end_date, DATE '9999-12-31')) c
      USING (period_start, organization_id)
    WHERE usage_cost IS NOT NULL OR contract_type <> 'METERED')"""


@query(
    "apply_contracts",
    _RATED_VIEWS,
    f"""SELECT period_start, organization_id, contract_type, CAST(fixed_charge AS DOUBLE) AS fixed_charge,
      CAST(usage_charge AS DOUBLE) AS usage_charge, CAST(fixed_charge + usage_charge AS DOUBLE) AS amount FROM {_owed()}""",
)
def _(spark, sf_dir):
    (contracts,) = load(spark, sf_dir, "contracts")
    return billing.apply_contracts(_rate_of(spark, sf_dir), contracts)


@query(
    "plan_charges",
    _RATED_VIEWS,
    f"""SELECT period_start, organization_id, plan_slug, CAST(base AS DOUBLE) AS base_fee, CAST(usage AS DOUBLE) AS usage_charge,
      CAST(base + usage AS DOUBLE) AS amount
    FROM (SELECT u.*, CASE WHEN contract_type = 'FIXED' THEN 0 ELSE included_units % 97 + 5 END AS base,
        CASE WHEN contract_type = 'FIXED' THEN 0 ELSE cost END AS usage
      FROM (SELECT period_start, organization_id, plan_slug, CAST(sum(cost) AS DECIMAL(18,2)) AS cost FROM {_rated()} GROUP BY ALL) u
      JOIN price_book USING (plan_slug) JOIN (SELECT period_start, organization_id, contract_type FROM {_owed()}) USING (period_start, organization_id))""",
)
def _(spark, sf_dir):
    prices, contracts = load(spark, sf_dir, "price_book", "contracts")
    prices = prices.withColumn("base_fee", F.expr("included_units % 97 + 5"))
    return billing.plan_charges(_written(_rate_of(spark, sf_dir), "rated"), prices, contracts)


def _invoiced(period: str, end: str) -> str:
    return f"""(SELECT 'INV-' || strftime(period_start, '%Y-%m-%d') || '-' || organization_id AS invoice_number, organization_id,
      period_start, {end} AS period_end, subtotal, tax, CAST(subtotal + tax AS DECIMAL(18,2)) AS total, contract_type, fixed_charge, usage_charge
    FROM (SELECT *, CAST(round(subtotal * CAST(0.20 AS DECIMAL(5,4)), 2) AS DECIMAL(18,2)) AS tax
      FROM (SELECT *, CAST(fixed_charge + usage_charge AS DECIMAL(18,2)) AS subtotal FROM {_owed(period)})))"""


@query(
    "build_invoices",
    _RATED_VIEWS,
    f""", lines AS (SELECT r.period_start, r.organization_id, string_agg(chain_slug || ' - ' || units || ' units='
        || CAST(CASE WHEN i.contract_type = 'FIXED' THEN CAST(0 AS DECIMAL(18,2)) ELSE cost END AS VARCHAR), ';' ORDER BY chain_slug, plan_slug) AS listed
      FROM {_rated()} r JOIN {_owed()} i ON r.organization_id = i.organization_id AND r.period_start = i.period_start GROUP BY ALL)
    SELECT invoice_number, i.organization_id, i.period_start, period_end, CAST(fixed_charge AS DOUBLE) AS fixed_charge,
      CAST(usage_charge AS DOUBLE) AS usage_charge, CAST(subtotal AS DOUBLE) AS subtotal,
      CAST(tax AS DOUBLE) AS tax, CAST(total AS DOUBLE) AS total, 'USD' AS currency,
      concat_ws(';', listed, CASE WHEN contract_type <> 'METERED' THEN 'fixed price=' || CAST(CAST(fixed_charge AS DECIMAL(18,2)) AS VARCHAR) END) AS line_items
    FROM {_invoiced("month", "last_day(period_start)")} i
    LEFT JOIN lines l ON i.organization_id = l.organization_id AND i.period_start = l.period_start""",
)
def _(spark, sf_dir):
    (contracts,) = load(spark, sf_dir, "contracts")
    invoices = billing.build_invoices(_written(_rate_of(spark, sf_dir), "rated"), contracts)
    listed = F.transform("line_items", lambda line: F.concat(line["description"], F.lit("="), line["amount"].cast("string")))
    return invoices.withColumn("line_items", F.array_join(listed, ";"))


@query(
    "close_period",
    sql=f"""SELECT *, sha256('{{"period_start":"' || CAST(period_start AS VARCHAR) || '","organization_id":"' || organization_id
      || '","plan_slug":"' || plan_slug || '","chain_slug":"' || chain_slug || '","units":' || units || '}}') AS row_hash
    FROM ({_metered()})""",
)
def _(spark, sf_dir):
    return billing.close_period(_meter_of(spark, sf_dir))


_RECONCILED = f"""SELECT period_start, organization_id,
      CASE WHEN organization_id <> 'org4' THEN CAST(fixed_charge + usage_charge + (organization_id = 'org5')::INT AS DOUBLE) END AS invoice_total,
      CASE WHEN organization_id <> 'org7' OR fixed_charge > 0 THEN CAST(fixed_charge + CASE WHEN organization_id = 'org7' THEN 0 ELSE usage_charge END AS DOUBLE) END
        AS snapshot_total,
      coalesce(invoice_total, 0) - coalesce(snapshot_total, 0) AS difference,
      CASE WHEN organization_id = 'org4' THEN 'missing_invoice' WHEN snapshot_total IS NULL THEN 'missing_snapshot'
        WHEN organization_id = 'org8' THEN 'broken_snapshot' WHEN abs(difference) > 0.001 THEN 'mismatch' ELSE 'match' END AS outcome
    FROM {_owed()}"""


def _reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One fault of each kind is planted: no invoice, a wrong amount, no usage kept, a row changed after closing.
    (contracts,) = load(spark, sf_dir, "contracts")
    rated = _written(_rate_of(spark, sf_dir), "rated")
    closed = billing.close_period(rated).where("organization_id <> 'org7'")
    closed = closed.withColumn("row_hash", F.when(F.col("organization_id") == "org8", F.lit("0")).otherwise(F.col("row_hash")))
    closed = _written(closed, "snapshot")
    wrong = F.when(F.col("organization_id") == "org5", 1).otherwise(0)
    invoices = billing.build_invoices(rated, contracts).where("organization_id <> 'org4'")
    invoices = invoices.withColumns({c: (F.col(c) + wrong).cast("decimal(18,2)") for c in ("usage_charge", "subtotal")})
    return billing.reconcile(_written(invoices, "invoices"), closed, contracts)


@query("reconcile", _RATED_VIEWS, _RECONCILED)
def _(spark, sf_dir):
    return _reconciled(spark, sf_dir)


@query(
    "credit_notes",
    _RATED_VIEWS,
    f"""SELECT 'CN-' || strftime(period_start, '%Y-%m-%d') || '-' || organization_id AS note_number, period_start, organization_id,
      CASE WHEN difference > 0 THEN 'credit' ELSE 'debit' END AS kind, difference AS amount, outcome AS reason
    FROM ({_RECONCILED}) WHERE abs(difference) > 0.001""",
)
def _(spark, sf_dir):
    return ledger.credit_notes(_reconciled(spark, sf_dir))


@query(
    "ledger_proofs",
    sql=f""", closed AS (SELECT period_start, organization_id, sha256('{{"period_start":"' || CAST(period_start AS VARCHAR)
        || '","organization_id":"' || organization_id || '","plan_slug":"' || plan_slug || '","chain_slug":"' || chain_slug
        || '","units":' || units || '}}') AS row_hash FROM ({_metered("day")})),
    leaves AS (SELECT period_start, organization_id, sha256(organization_id) AS key,
        sha256(organization_id || '|' || string_agg(row_hash, '|' ORDER BY row_hash)) AS leaf_hash
      FROM closed GROUP BY period_start, organization_id),
    buckets AS (SELECT period_start, substr(key, 1, 1) AS prefix, sha256(string_agg(key || ':' || leaf_hash, ',' ORDER BY key)) AS hash
      FROM leaves GROUP BY period_start, substr(key, 1, 1)),
    roots AS (SELECT period_start, sha256(string_agg(prefix || ':' || hash, ',' ORDER BY prefix)) AS root
      FROM buckets GROUP BY period_start)
    SELECT period_start, organization_id, leaf_hash, root, true AS holds FROM leaves JOIN roots USING (period_start)""",
)
def _(spark, sf_dir):
    found = _written(ledger.leaves(billing.close_period(_meter_of(spark, sf_dir, "day"))), "leaves")
    nodes = _written(ledger.hash_tree(found, 1), "nodes")
    proved = ledger.proofs(found, nodes, 1).withColumn("holds", ledger.proof_holds(1))
    return proved.select("period_start", "organization_id", "leaf_hash", "root", "holds")


@query(
    "convert_fx",
    _RATED_VIEWS,
    f"""SELECT invoice_number, CAST(total AS DOUBLE) AS total, CAST(fx AS DOUBLE) AS fx_rate,
      CAST(CAST(round(total * fx, 2) AS DECIMAL(18,2)) AS DOUBLE) AS converted_amount, quoted < period_start AS estimated
    FROM (SELECT i.*, (SELECT try_per_usd FROM fx_rates f WHERE f.rate_date <= i.period_start ORDER BY rate_date DESC LIMIT 1) AS fx,
        (SELECT max(rate_date) FROM fx_rates f WHERE f.rate_date <= i.period_start) AS quoted
      FROM {_invoiced("week", "period_start + 6")} i)""",
)
def _(spark, sf_dir):
    contracts, fx = load(spark, sf_dir, "contracts", "fx_rates")
    invoices = billing.build_invoices(_rate_of(spark, sf_dir, "week"), contracts, period="week")
    converted = billing.convert_fx(invoices, fx, day="period_start")
    return converted.select("invoice_number", "total", "fx_rate", "converted_amount", "estimated")


@query(
    "convert_currencies",
    [*_RATED_VIEWS, "fx_quotes"],
    f""", billed AS (SELECT invoice_number, total, period_end + INTERVAL '10 hours' AS issued_at,
        (['USD', 'EUR', 'TRY', 'GBP'])[CAST(length(organization_id) + CAST(day(period_start) AS BIGINT) AS BIGINT) % 4 + 1] AS currency
      FROM {_invoiced("week", "period_start + 6")})
    SELECT invoice_number, b.currency, CAST(total AS DOUBLE) AS total, CASE WHEN b.currency = 'USD' THEN 1e0 ELSE CAST(rate AS DOUBLE) END AS fx_rate,
      quoted_at, CAST(round(total * CASE WHEN b.currency = 'USD' THEN CAST(1 AS DECIMAL(18,8)) ELSE rate END, 2) AS DOUBLE) AS converted_amount
    FROM billed b ASOF LEFT JOIN (SELECT currency, quoted_at, max(rate) AS rate FROM fx_quotes GROUP BY ALL) q
      ON b.currency = q.currency AND b.issued_at >= q.quoted_at""",
)
def _(spark, sf_dir):
    contracts, quotes = load(spark, sf_dir, "contracts", "fx_quotes")
    invoices = billing.build_invoices(_rate_of(spark, sf_dir, "week"), contracts, period="week")
    place = (F.length("organization_id") + F.dayofmonth("period_start")) % 4 + 1
    issued = F.timestamp_seconds(F.unix_seconds(F.col("period_end").cast("timestamp")) + 36000)
    billed = invoices.select("invoice_number", "total", issued.alias("issued_at"), F.element_at(F.lit(["USD", "EUR", "TRY", "GBP"]), place).alias("currency"))
    converted = convert(billed, quotes, "USD", "issued_at", span=7 * 86400)
    return converted.select("invoice_number", "currency", "total", "fx_rate", "quoted_at", "converted_amount")


@query(
    "revenue",
    _RATED_VIEWS,
    f"""SELECT chain_slug, plan_slug, CAST(sum(cost) AS DOUBLE) AS revenue, CAST(sum(units) AS BIGINT) AS units
    FROM {_rated()} GROUP BY chain_slug, plan_slug""",
)
def _(spark, sf_dir):
    return billing.revenue(_rate_of(spark, sf_dir))


@query(
    "top_customers",
    _RATED_VIEWS,
    f"""SELECT organization_id, CAST(sum(units) AS BIGINT) AS units, CAST(sum(cost) AS DOUBLE) AS revenue
    FROM {_rated()} GROUP BY organization_id ORDER BY units DESC, organization_id LIMIT 10""",
)
def _(spark, sf_dir):
    return billing.top_customers(_rate_of(spark, sf_dir))


@query(
    "late_adjustments",
    sql=f"""SELECT period_start, organization_id, plan_slug, chain_slug, coalesce(b.units, 0) AS closed_units,
      a.units AS current_units, a.units - coalesce(b.units, 0) AS adjustment
    FROM ({_metered()}) a LEFT JOIN ({_metered(where="event_time < TIMESTAMP '2024-01-29 12:00:00'")}) b
      USING (period_start, organization_id, plan_slug, chain_slug) WHERE a.units <> coalesce(b.units, 0)""",
)
def _(spark, sf_dir):
    closed = billing.close_period(_meter_of(spark, sf_dir, where="event_time < TIMESTAMP '2024-01-29 12:00:00'"))
    return billing.late_adjustments(closed, _meter_of(spark, sf_dir))
