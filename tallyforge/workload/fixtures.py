"""Test inputs derived from the driver's ``events`` table.

Each view is one SQL text that Spark SQL and DuckDB both run unchanged, so the
same string builds the Spark input and heads the check query.  ``VIEWS`` is in
dependency order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyforge.sources.catalog import CHAINS, METHOD_UNITS, PLANS

AS_OF = "2024-01-31 00:00:00"

VIEWS: dict[str, str] = {}



def _values(rows) -> str:
    """The rows of a VALUES clause; text is quoted, None becomes NULL."""

    def cell(value) -> str:
        if isinstance(value, bool):
            return str(value).lower()
        return "NULL" if value is None else f"'{value}'" if isinstance(value, str) else str(value)

    return ", ".join(f"({', '.join(map(cell, row))})" for row in rows)


VIEWS["method_units"] = f"""
SELECT * FROM (VALUES {_values((i, "evm", *row) for i, row in enumerate(METHOD_UNITS))})
  AS t(i, chain_type, rpc_method, compute_units, is_expensive, requires_archive, requires_trace)
"""

_USED = ["eth-mainnet", "eth-sepolia", "arb-mainnet", "polygon-mainnet", "base-mainnet", "op-mainnet"]
_TESTNETS = {row[0]: row[4] for row in CHAINS}

VIEWS["fx_chains"] = f"""
SELECT * FROM (VALUES {_values((i, slug, _TESTNETS[slug]) for i, slug in enumerate(_USED))}) AS t(i, chain_slug, is_testnet)
"""

VIEWS["plans"] = f"""
SELECT plan_slug, rate_limit_per_minute, rate_limit_per_hour, rate_limit_per_day, CAST(price AS DECIMAL(10,2)) AS price_monthly,
  allowed_chains, archive_access, trace_access
FROM (VALUES {_values((slug, *limits, price, '["*"]', archive, trace) for slug, _, *limits, price, _, archive, trace in PLANS)})
  AS t(plan_slug, rate_limit_per_minute, rate_limit_per_hour, rate_limit_per_day, price, allowed_chains, archive_access, trace_access)
"""

VIEWS["requests"] = r"""
SELECT
  CAST(date_trunc('second', e.ts) AS TIMESTAMP) AS event_time,
  CAST(date_trunc('millisecond', e.ts) AS TIMESTAMP) AS event_time_ms,
  CAST(e.ts AS DATE) AS event_date,
  'req-' || CAST(e.event_id AS STRING) AS request_id,
  'POST' AS method,
  '/[REDACTED]/' || c.chain_slug AS path,
  c.chain_slug || '-route' AS route_name,
  'c' || CAST(e.user_id AS STRING) AS consumer_id,
  'org' || CAST(e.user_id % 20 AS STRING) AS organization_id,
  'sk_' || CAST(e.user_id AS STRING) AS api_key_prefix,
  CASE (e.user_id % 20) % 4 WHEN 0 THEN 'free' WHEN 1 THEN 'basic' WHEN 2 THEN 'pro' ELSE 'enterprise' END AS plan_slug,
  c.chain_slug,
  'evm' AS chain_type,
  CASE WHEN e.event_type <> 'error' THEN CASE WHEN e.k = 99 THEN 301 ELSE 200 END
       WHEN e.k % 5 = 0 THEN 500 WHEN e.k % 5 = 1 THEN 502 WHEN e.k % 5 = 2 THEN 429
       WHEN e.k % 5 = 3 THEN 403 ELSE 400 END AS status_code,
  CAST(floor(e.value * 1000) AS BIGINT) AS response_size,
  CAST(floor(e.value * 4) AS INT) AS latency_ms,
  CAST(floor(e.value * 3) AS INT) AS upstream_latency_ms,
  CAST(floor(e.value * 4) AS INT) - CAST(floor(e.value * 3) AS INT) AS gateway_latency_ms,
  c.chain_slug || '-' || CAST(e.event_id % 2 AS STRING) AS upstream_host,
  CASE WHEN e.event_id % 40 = 0 THEN '' ELSE m.rpc_method END AS rpc_method,
  CASE WHEN e.event_id % 40 = 0 THEN 1 ELSE m.compute_units END AS compute_units,
  CASE WHEN e.event_type = 'error' THEN 'err-' || CAST(e.k % 5 AS STRING) ELSE '' END AS error_message,
  CASE WHEN e.event_type = 'error' THEN 1 ELSE 0 END AS is_error,
  e.props AS metadata
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events) e
JOIN fx_chains c ON e.k % 6 = c.i
JOIN method_units m ON e.event_id % 25 = m.i
"""

VIEWS["organizations"] = r"""
SELECT DISTINCT
  'org' || CAST(user_id % 20 AS STRING) AS organization_id,
  'Org ' || CAST(user_id % 20 AS STRING) AS name,
  CASE WHEN user_id % 20 = 7 THEN 'suspended' ELSE 'active' END AS status,
  DATE '2023-01-01' + CAST(user_id % 20 AS INT) AS created_at
FROM events
"""

VIEWS["subscriptions"] = r"""
SELECT DISTINCT
  'sub' || CAST(user_id % 20 AS STRING) AS subscription_id,
  'org' || CAST(user_id % 20 AS STRING) AS organization_id,
  CASE (user_id % 20) % 4 WHEN 0 THEN 'free' WHEN 1 THEN 'basic' WHEN 2 THEN 'pro' ELSE 'enterprise' END AS plan_slug,
  CASE WHEN user_id % 20 = 5 THEN 'canceled' ELSE 'active' END AS status,
  DATE '2024-01-01' AS current_period_start,
  CASE WHEN user_id % 20 = 9 THEN DATE '2024-01-10' WHEN user_id % 20 = 11 THEN CAST(NULL AS DATE) ELSE DATE '2024-01-31' END AS current_period_end
FROM events
UNION ALL
SELECT 'sub3b', 'org3', 'pro', 'active', DATE '2023-12-01', DATE '2024-01-31'
"""

VIEWS["api_keys"] = r"""
SELECT DISTINCT
  'sk_' || CAST(user_id AS STRING) AS key_prefix,
  'c' || CAST(user_id AS STRING) AS consumer_id,
  'org' || CAST(user_id % 20 AS STRING) AS organization_id,
  CASE WHEN user_id % 25 = 0 THEN 'revoked' ELSE 'active' END AS status,
  CASE WHEN user_id % 17 = 0 THEN DATE '2024-01-15' ELSE CAST(NULL AS DATE) END AS expires_at,
  CASE WHEN user_id % 3 = 0 THEN '["eth-mainnet", "polygon-mainnet"]' ELSE '["*"]' END AS allowed_chains,
  CASE WHEN user_id % 10 = 0 THEN '["eth_getLogs"]' ELSE '[]' END AS restricted_methods
FROM events
"""

VIEWS["rpc_endpoints"] = r"""
SELECT c.chain_slug, c.chain_slug || '-' || CAST(n.n AS STRING) AS upstream_host,
  (c.i + n.n) % 5 <> 0 AS is_healthy, c.i <> 4 AS is_active, 20 + 7 * c.i + 3 * n.n AS avg_latency_ms
FROM fx_chains c CROSS JOIN (VALUES (0), (1)) AS n(n)
WHERE c.i <> 5
"""

VIEWS["test_limits"] = r"""
SELECT * FROM (VALUES ('free', 1), ('basic', 2), ('pro', 4), ('enterprise', 8)) AS t(plan_slug, limit_per_day)
"""

VIEWS["fx_rates"] = r"""
SELECT * FROM (VALUES (DATE '2024-01-01', CAST(29.50 AS DECIMAL(10,4))), (DATE '2024-01-02', CAST(29.75 AS DECIMAL(10,4))),
  (DATE '2024-01-05', CAST(29.90 AS DECIMAL(10,4))), (DATE '2024-01-22', CAST(30.10 AS DECIMAL(10,4)))) AS t(rate_date, try_per_usd)
"""

# Quotes at moments within days, one of each currency for every day and some more.
VIEWS["fx_quotes"] = r"""
SELECT DISTINCT CASE WHEN event_id % 3 = 0 THEN 'EUR' WHEN event_id % 3 = 1 THEN 'TRY' ELSE 'GBP' END AS currency,
  CAST(date_trunc('hour', ts) AS TIMESTAMP) AS quoted_at,
  CAST(CAST(extract(day FROM ts) AS DECIMAL(6,0))
    * CASE WHEN event_id % 3 = 0 THEN 1.012345 WHEN event_id % 3 = 1 THEN 0.033333 ELSE 1.271801 END AS DECIMAL(18,8)) AS rate
FROM events WHERE event_id % 7 = 0
"""

VIEWS["raw_access_log"] = r"""
SELECT e.event_id, e.ts,
  CASE WHEN e.event_id % 50 = 0 THEN '/eth-mainnet' ELSE '/sk_' || CAST(e.user_id AS STRING) || '_' || md5(CAST(e.user_id AS STRING)) || '/' || c.chain_slug END AS path,
  CASE WHEN e.event_id % 40 = 0 THEN '[]' WHEN e.event_id % 41 = 0 THEN 'not json'
       ELSE '{"jsonrpc":"2.0","method":"' || m.rpc_method || '","params":[],"id":' || CAST(e.event_id AS STRING) || '}' END AS body
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events) e
JOIN fx_chains c ON e.k % 6 = c.i
JOIN method_units m ON e.event_id % 25 = m.i
"""

# Catalog tables in the layout of ``schemas.CATALOG_DDL`` (the columns that the
# operators read).

VIEWS["c_organizations"] = r"""
SELECT organization_id AS id, name, 'org-' || substring(organization_id, 4) AS slug,
  organization_id || '@example.com' AS email, status, CAST(created_at AS TIMESTAMP) AS created_at
FROM organizations
"""

VIEWS["c_plans"] = r"""
SELECT 'plan-' || plan_slug AS id, upper(substring(plan_slug, 1, 1)) || substring(plan_slug, 2) AS name, plan_slug AS slug,
  rate_limit_per_minute, rate_limit_per_hour, rate_limit_per_day, price_monthly,
  CASE WHEN plan_slug = 'basic' THEN '["eth-mainnet", "arb-mainnet", "base-mainnet"]' ELSE allowed_chains END AS allowed_chains,
  archive_access, trace_access, true AS websocket_access, true AS is_active
FROM plans
"""

VIEWS["c_subscriptions"] = r"""
SELECT subscription_id AS id, organization_id, 'plan-' || plan_slug AS plan_id, status,
  CAST(current_period_start AS TIMESTAMP) AS current_period_start, CAST(current_period_end AS TIMESTAMP) AS current_period_end
FROM subscriptions
"""

VIEWS["c_consumers"] = r"""
SELECT DISTINCT 'c' || CAST(user_id AS STRING) AS id, 'org' || CAST(user_id % 20 AS STRING) AS organization_id,
  'gw_' || CAST(user_id AS STRING) AS gateway_consumer_id, 'ident_' || CAST(user_id AS STRING) AS identity_ref,
  'active' AS status
FROM events
"""

VIEWS["c_api_keys"] = r"""
SELECT 'key-' || consumer_id AS id, organization_id, consumer_id, 'ref-' || consumer_id AS key_ref, key_prefix, status,
  CAST(expires_at AS TIMESTAMP) AS expires_at, allowed_chains, restricted_methods
FROM api_keys
"""

VIEWS["c_chains"] = r"""
SELECT 'chain-' || chain_slug AS id, chain_slug AS name, chain_slug AS slug, 'evm' AS chain_type, CAST(i AS STRING) AS chain_id,
  i <> 1 AS is_active, is_testnet
FROM fx_chains
"""

VIEWS["c_rpc_endpoints"] = r"""
SELECT upstream_host AS id, 'chain-' || chain_slug AS chain_id, upstream_host AS name, 'http' AS endpoint_type,
  100 AS weight, is_healthy, is_active, avg_latency_ms
FROM rpc_endpoints
"""

VIEWS["c_plan_chain_limits"] = r"""
SELECT * FROM (VALUES
  ('pcl-1', 'plan-free', 'chain-eth-mainnet', CAST(NULL AS INT), 50, CAST(NULL AS INT), 1, 8, 60),
  ('pcl-2', 'plan-pro', 'chain-arb-mainnet', CAST(NULL AS INT), 20000, 1, CAST(NULL AS INT), 60, 100),
  ('pcl-3', 'plan-basic', 'chain-eth-mainnet', 1, CAST(NULL AS INT), 2, 3, 40, 120)
) AS t(id, plan_id, chain_id, rate_limit_per_second, rate_limit_per_minute, rate_limit_per_hour, rate_limit_per_day,
  compute_units_per_second, compute_units_per_day)
"""

VIEWS["c_method_compute_units"] = r"""
SELECT 'mcu-' || CAST(i AS STRING) AS id, chain_type, rpc_method AS method_name, compute_units, is_expensive, requires_archive, requires_trace
FROM method_units
"""

# Limits low enough to be reached by the test log.
VIEWS["low_limit_plans"] = r"""
SELECT * FROM (VALUES ('plan-free', 'free', 1, 1, 1), ('plan-basic', 'basic', 1, 1, 2), ('plan-pro', 'pro', 1, 2, 3),
  ('plan-enterprise', 'enterprise', 1, 2, 4)) AS t(id, slug, rate_limit_per_minute, rate_limit_per_hour, rate_limit_per_day)
"""

VIEWS["price_book"] = r"""
SELECT * FROM (VALUES ('free', 100, 0.000000), ('basic', 500, 0.002000), ('pro', 300, 0.001500), ('enterprise', 0, 0.001250))
  AS t(plan_slug, included_units, overage_rate)
"""

VIEWS["chain_coefficients"] = r"""
SELECT * FROM (VALUES ('eth-mainnet', 1.5000), ('polygon-mainnet', 0.7500), ('arb-mainnet', 1.2500)) AS t(chain_slug, coefficient)
"""

VIEWS["contracts"] = r"""
SELECT DISTINCT 'org' || CAST(user_id % 20 AS STRING) AS organization_id,
  CASE (user_id % 20) % 3 WHEN 0 THEN 'FIXED' WHEN 1 THEN 'METERED' ELSE 'HYBRID' END AS contract_type,
  CASE WHEN (user_id % 20) % 3 = 1 THEN CAST(NULL AS DECIMAL(10,2)) ELSE CAST(500.50 AS DECIMAL(10,2)) END AS price_fixed,
  CASE WHEN user_id % 20 = 2 THEN DATE '2024-01-10' ELSE CAST(NULL AS DATE) END AS start_date,
  CASE WHEN user_id % 20 = 3 THEN DATE '2024-01-12' ELSE CAST(NULL AS DATE) END AS end_date
FROM events WHERE user_id % 20 <> 13
UNION ALL
SELECT DISTINCT 'idle' || CAST(user_id % 7 AS STRING), CASE WHEN user_id % 7 < 5 THEN 'FIXED' ELSE 'METERED' END,
  CAST(120.25 AS DECIMAL(10,2)), DATE '2023-06-01', CASE WHEN user_id % 7 = 3 THEN DATE '2023-12-31' ELSE CAST(NULL AS DATE) END
FROM events
"""

VIEWS["spans"] = r"""
SELECT request_id AS trace_id, event_time, latency_ms AS duration_ms,
  rpc_method, chain_slug, plan_slug, organization_id, compute_units, CAST(substring(request_id, 5) AS BIGINT) AS n
FROM requests
"""

CATALOG_VIEWS = [name for name in VIEWS if name.startswith("c_")]

_NEEDS = {
    "requests": ["fx_chains", "method_units"],
    "rpc_endpoints": ["fx_chains"],
    "raw_access_log": ["fx_chains", "method_units"],
    "spans": ["fx_chains", "method_units", "requests"],
    "c_organizations": ["organizations"],
    "c_plans": ["plans"],
    "c_subscriptions": ["subscriptions"],
    "c_api_keys": ["api_keys"],
    "c_chains": ["fx_chains"],
    "c_rpc_endpoints": ["fx_chains", "rpc_endpoints"],
    "c_method_compute_units": ["method_units"],
}


def common_tables(*names: str) -> str:
    """``name AS (...)`` clauses for the views and all they read."""
    wanted: list[str] = []
    for name in names:
        for view in [*_NEEDS.get(name, []), name]:
            if view not in wanted:
                wanted.append(view)
    ordered = [v for v in VIEWS if v in wanted]
    return ",\n".join(f"{v} AS ({VIEWS[v].strip()})" for v in ordered)


def check_sql(names: list[str], body: str) -> str:
    """A check query: the views as common tables, then ``body``.

    ``body`` may start with further common tables, after a comma.
    """
    return f"WITH RECURSIVE {common_tables(*names)}\n{body.strip()}"


# Views already built, by application, folder and name.  A DataFrame is only a
# plan, so it may be shared by queries; this spares reading footers and parsing
# the view texts for each of them.
_LOADED: dict[tuple[str, str, str], DataFrame] = {}


def load(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    """The named views over the Parquet tables of ``sf_dir``."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    application = spark.sparkContext.applicationId
    missing = [name for name in names if (application, sf_dir, name) not in _LOADED]
    if missing:
        source = "tallyforge_events"
        spark.read.parquet(f"{sf_dir}/events.parquet").createOrReplaceTempView(source)
        for name in missing:
            _LOADED[application, sf_dir, name] = view_of(spark, source, name)
    return [_LOADED[application, sf_dir, name] for name in names]


def view_of(spark: SparkSession, source: str, name: str) -> DataFrame:
    """A view with ``source`` (a temp view, batch or stream) in the place of ``events``."""
    text = f"WITH {common_tables(name)}\nSELECT * FROM {name}"
    return spark.sql(text.replace("FROM events", f"FROM {source}"))


def load_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The request log as a stream over the Parquet files of ``events``."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet").createOrReplaceTempView("tallyforge_stream")
    return view_of(spark, "tallyforge_stream", "requests")


def load_catalog(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    frames = load(spark, sf_dir, *CATALOG_VIEWS)
    return {name[2:]: frame for name, frame in zip(CATALOG_VIEWS, frames, strict=True)}
