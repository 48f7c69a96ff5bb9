"""From raw access records to request rows (A5-A10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.measures import lookup

# Span attribute -> request column, type and default.
SPAN_ATTRIBUTES = [
    ("http.request.header.x-rpc-method", "rpc_method", "string", "unknown"),
    ("http.request.header.x-chain", "chain_slug", "string", ""),
    ("http.request.header.x-plan", "plan_slug", "string", "free"),
    ("http.request.header.x-organization-id", "organization_id", "string", ""),
    ("http.request.header.x-compute-units", "compute_units", "int", 1),
]


def normalize_spans(spans: DataFrame) -> DataFrame:
    """A5: request columns from a span's ``attributes`` map<string,string>."""
    columns = [
        F.coalesce(F.expr(f"try_cast(attributes['{attribute}'] AS {kind})"), F.lit(default)).alias(name)
        for attribute, name, kind, default in SPAN_ATTRIBUTES
    ]
    return spans.select(*[c for c in spans.columns if c != "attributes"], *columns)


def parse_access_path(df: DataFrame, col: str = "path") -> DataFrame:
    """``/<key>/<chain>`` -> api_key, chain_slug; other paths keep nulls and path_valid = false."""
    pattern = r"^/([^/]+)/([^/]+)$"
    valid = F.coalesce(F.col(col).rlike(pattern), F.lit(False))
    return df.withColumns(
        {
            "api_key": F.when(valid, F.regexp_extract(col, pattern, 1)),
            "chain_slug": F.when(valid, F.regexp_extract(col, pattern, 2)),
            "path_valid": valid,
        }
    )


def mask_api_key(df: DataFrame, col: str = "api_key", prefix_len: int = 20, path_col: str | None = "path") -> DataFrame:
    """Drop the key, keep its prefix and MD5 digest, and mask it in the path.

    The first segment of any path may be a key, also where no chain follows.
    """
    masked = df.withColumns(
        {"api_key_prefix": F.substring(col, 1, prefix_len), "api_key_digest": F.md5(F.col(col))}
    )
    if path_col and path_col in df.columns:
        masked = masked.withColumn(path_col, F.regexp_replace(path_col, r"^/*[^/]+", "/[REDACTED]"))
    return masked.drop(col)


def parse_rpc_body(df: DataFrame, col: str = "body") -> DataFrame:
    """Method and id of a JSON-RPC object; anything else gives nulls."""
    # A JSON array would be read as its first element, so only objects are parsed.
    is_object = F.ltrim(F.col(col)).startswith("{")
    parsed = F.from_json(F.when(is_object, F.col(col)), "method string, id string")
    return df.withColumns({"rpc_method": parsed["method"], "rpc_id": parsed["id"]})


def assign_compute_units(requests: DataFrame, units: DataFrame) -> DataFrame:
    """Compute units by chain type and method; an unknown method costs 1."""
    known = units.select("chain_type", F.col("method_name").alias("rpc_method"), F.col("compute_units").alias("_units"))
    return (
        requests.drop("compute_units")
        .join(known, ["chain_type", "rpc_method"], "left")
        .withColumn("compute_units", F.coalesce("_units", F.lit(1)))
        .drop("_units")
    )


def _newest_first(moment: str) -> Column:
    """Ascending order on this column is newest first, nulls last."""
    return F.coalesce(-F.unix_micros(moment), F.lit(2**63 - 1))


def current_subscription(catalog: dict[str, DataFrame]) -> DataFrame:
    """One active subscription per organisation: newest period start, then smallest id."""
    active = catalog["subscriptions"].where(F.col("status") == "active")
    first = F.min(F.struct(_newest_first("current_period_start").alias("_age"), "id", "plan_id"))
    return active.groupBy("organization_id").agg(first.alias("_first")).select("organization_id", "_first.plan_id")


def organization_plans(catalog: dict[str, DataFrame]) -> DataFrame:
    """organization_id and plan_slug of the current subscription."""
    plans = catalog["plans"].select(F.col("id").alias("plan_id"), F.col("slug").alias("plan_slug"))
    return current_subscription(catalog).join(plans, "plan_id").select("organization_id", "plan_slug")


def one_key_per_prefix(keys: DataFrame) -> DataFrame:
    """Prefixes are not unique: take an active key first, then the smallest id."""
    rest = [c for c in keys.columns if c not in ("key_prefix", "id")]
    best = F.min(F.struct((F.col("status") != "active").alias("_inactive"), "id", *rest))
    # Grouped by a struct, so that a join on the prefix shuffles both sides anew and adaptive execution can split them.
    grouped = keys.groupBy(F.struct("key_prefix").alias("_prefix")).agg(best.alias("_key"))
    return grouped.select("_prefix.key_prefix", "_key.*").drop("_inactive")


def enrich_tenant(requests: DataFrame, catalog: dict[str, DataFrame]) -> DataFrame:
    """A10: consumer, organisation and plan of each request by its key prefix.

    Unknown keys get '' and the plan ``free``.  The tenant table is one row
    per key prefix and may be large (see ``lookup``).
    """
    keys = one_key_per_prefix(catalog["api_keys"].select("key_prefix", "id", "status", "consumer_id", "organization_id"))
    tenants = keys.join(organization_plans(catalog), "organization_id", "left").select(
        F.col("key_prefix").alias("api_key_prefix"), "consumer_id", "organization_id", "plan_slug"
    )
    tenant_columns = ["consumer_id", "organization_id", "plan_slug"]
    bare = requests.drop(*tenant_columns)
    return lookup(bare, tenants, ["api_key_prefix"]).withColumns(
        {
            "consumer_id": F.coalesce("consumer_id", F.lit("")),
            "organization_id": F.coalesce("organization_id", F.lit("")),
            "plan_slug": F.coalesce("plan_slug", F.lit("free")),
        }
    )
