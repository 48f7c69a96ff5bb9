"""Column layouts of the request log and of the catalog tables, as Spark DDL."""

from __future__ import annotations

from pyspark.sql import types as T

# Request log. One row per served call; '' stands for "absent" in text columns.
REQUESTS_DDL = """
    event_time timestamp, event_time_ms timestamp, request_id string,
    method string, path string, route_name string,
    consumer_id string, organization_id string, api_key_prefix string, plan_slug string,
    chain_slug string, chain_type string, chain_id string,
    status_code int, response_size bigint,
    latency_ms int, upstream_latency_ms int, gateway_latency_ms int,
    upstream_host string, upstream_status int,
    client_ip string, user_agent string,
    rpc_method string, rpc_id string, compute_units int,
    error_message string, is_error int, metadata string,
    event_date date
"""

_AUDIT = "created_at timestamp, updated_at timestamp"

CATALOG_DDL: dict[str, str] = {
    "organizations": f"id string, name string, slug string, email string, status string, metadata string, {_AUDIT}",
    "users": f"id string, organization_id string, email string, name string, role string, status string, metadata string, {_AUDIT}",
    "plans": (
        "id string, name string, slug string, description string,"
        " rate_limit_per_minute int, rate_limit_per_hour int, rate_limit_per_day int,"
        " burst_multiplier decimal(3,2), price_monthly decimal(10,2), price_yearly decimal(10,2), currency string,"
        " features string, allowed_chains string, archive_access boolean, trace_access boolean,"
        f" websocket_access boolean, is_active boolean, is_public boolean, {_AUDIT}"
    ),
    "subscriptions": (
        "id string, organization_id string, plan_id string, status string, billing_period string,"
        " current_period_start timestamp, current_period_end timestamp, trial_start timestamp, trial_end timestamp,"
        f" cancel_at_period_end boolean, canceled_at timestamp, metadata string, {_AUDIT}"
    ),
    "consumers": (
        "id string, organization_id string, gateway_consumer_id string, identity_ref string,"
        f" status string, metadata string, {_AUDIT}"
    ),
    "api_keys": (
        "id string, organization_id string, consumer_id string, key_ref string, key_prefix string,"
        " name string, description string, status string, last_used_at timestamp, usage_count bigint,"
        " expires_at timestamp, allowed_chains string, restricted_methods string, metadata string,"
        f" {_AUDIT}, revoked_at timestamp"
    ),
    "invoices": (
        "id string, organization_id string, subscription_id string, invoice_number string,"
        " subtotal decimal(10,2), tax decimal(10,2), total decimal(10,2), currency string, status string,"
        " period_start timestamp, period_end timestamp, due_date timestamp, paid_at timestamp,"
        f" line_items string, metadata string, {_AUDIT}"
    ),
    "webhooks": (
        "id string, organization_id string, url string, secret string, events array<string>, is_active boolean,"
        " max_retries int, retry_backoff int, last_triggered_at timestamp, success_count int, failure_count int,"
        f" metadata string, {_AUDIT}"
    ),
    "webhook_deliveries": (
        "id string, webhook_id string, event_type string, payload string, status string, response_status_code int,"
        " response_body string, attempts int, next_retry_at timestamp, created_at timestamp, delivered_at timestamp"
    ),
    "audit_logs": (
        "id string, organization_id string, user_id string, action string, resource_type string, resource_id string,"
        " changes string, metadata string, ip_address string, user_agent string, created_at timestamp"
    ),
    "chains": (
        "id string, name string, slug string, chain_type string, chain_id string, display_name string, icon_url string,"
        " color string, block_time_seconds int, native_currency string, supports_websocket boolean,"
        " supports_archive boolean, supports_trace boolean, is_active boolean, is_testnet boolean,"
        f" documentation_url string, metadata string, {_AUDIT}"
    ),
    "rpc_endpoints": (
        "id string, chain_id string, name string, url string, endpoint_type string, is_archive boolean,"
        " supports_trace boolean, weight int, priority int, is_healthy boolean, last_health_check timestamp,"
        " health_check_failures int, avg_latency_ms int, is_active boolean, operator string, metadata string,"
        f" {_AUDIT}"
    ),
    "plan_chain_limits": (
        "id string, plan_id string, chain_id string, rate_limit_per_second int, rate_limit_per_minute int,"
        " rate_limit_per_hour int, rate_limit_per_day int, compute_units_per_second int, compute_units_per_day int,"
        f" is_override boolean, {_AUDIT}"
    ),
    "method_compute_units": (
        "id string, chain_type string, method_name string, compute_units int, is_expensive boolean,"
        f" requires_archive boolean, requires_trace boolean, description string, {_AUDIT}"
    ),
}


def request_schema() -> T.StructType:
    return T.StructType.fromDDL(REQUESTS_DDL)


def catalog_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(CATALOG_DDL[table])
