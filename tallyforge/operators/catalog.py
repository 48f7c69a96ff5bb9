"""Organisation, key, subscription, chain and plan views and their audits."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.measures import at, chain_allowed, parsed_list, lookup
from tallyforge.operators.ingest import organization_plans

Catalog = dict[str, DataFrame]

#: Page size of a web listing.
DEFAULT_PAGE = 50


def _profiles(catalog: Catalog) -> DataFrame:
    orgs = catalog["organizations"].withColumnRenamed("id", "organization_id")
    return orgs.join(organization_plans(catalog), "organization_id", "left").select(
        "organization_id",
        "name",
        "slug",
        F.coalesce("plan_slug", F.lit("")).alias("plan_slug"),
        "status",
        "created_at",
    )


def org_profile(catalog: Catalog, org_id: str | None = None, slug: str | None = None) -> DataFrame:
    """Organisation and current plan, by id or slug; of every organisation if neither is given."""
    profiles = _profiles(catalog)
    if org_id is not None:
        profiles = profiles.where(F.col("organization_id") == org_id)
    if slug is not None:
        profiles = profiles.where(F.col("slug") == slug)
    return profiles


def page(df: DataFrame, order: Sequence[str | Column], limit: int | None = None, offset: int = 0) -> DataFrame:
    """Rows from ``offset`` on of a total order, ``limit`` of them if given."""
    rows = df.orderBy(*order)
    rows = rows.offset(offset) if offset > 0 else rows
    return rows if limit is None else rows.limit(limit)


def list_orgs(catalog: Catalog, limit: int | None = None, offset: int = 0) -> DataFrame:
    """Active organisations, newest first; all, or a page such as DEFAULT_PAGE."""
    active = _profiles(catalog).where(F.col("status") == "active")
    return page(active, [F.col("created_at").desc(), F.col("organization_id")], limit, offset)


def valid_keys(catalog: Catalog, as_of: datetime | str) -> DataFrame:
    """Keys that are active and not expired."""
    unexpired = F.col("expires_at").isNull() | (F.col("expires_at") > at(as_of))
    return catalog["api_keys"].where((F.col("status") == "active") & unexpired)


def flag_key_validity(requests: DataFrame, keys: DataFrame) -> DataFrame:
    """Every request with ``key_valid``; ``keys`` are the valid ones."""
    known = keys.select(F.col("key_prefix").alias("api_key_prefix")).distinct().withColumn("_known", F.lit(True))
    flagged = lookup(requests, known, ["api_key_prefix"])
    return flagged.withColumn("key_valid", F.coalesce("_known", F.lit(False))).drop("_known")


def split_by_key(requests: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(requests with a valid key, the others)."""
    flagged = flag_key_validity(requests, keys)
    return flagged.where("key_valid").drop("key_valid"), flagged.where("NOT key_valid").drop("key_valid")


def active_subscriptions(catalog: Catalog, as_of: datetime | str) -> DataFrame:
    """Running subscriptions of active organisations with plan limits."""
    subscriptions = catalog["subscriptions"].where(F.col("status") == "active")
    running = subscriptions.where(F.col("current_period_end").isNull() | (F.col("current_period_end") > at(as_of)))
    orgs = (
        catalog["organizations"]
        .where(F.col("status") == "active")
        .select(
            F.col("id").alias("organization_id"),
            F.col("name").alias("organization_name"),
            F.col("slug").alias("organization_slug"),
        )
    )
    plans = catalog["plans"].select(
        F.col("id").alias("plan_id"),
        F.col("name").alias("plan_name"),
        F.col("slug").alias("plan_slug"),
        "rate_limit_per_minute",
        "rate_limit_per_hour",
        "rate_limit_per_day",
    )
    joined = running.join(orgs, "organization_id").join(plans, "plan_id")
    added = [*orgs.columns[1:], *plans.columns[1:]]
    return joined.select(*catalog["subscriptions"].columns, *added)


def api_keys_detailed(catalog: Catalog) -> DataFrame:
    """E5: keys with their organisation and consumer."""
    orgs = catalog["organizations"].select(
        F.col("id").alias("organization_id"),
        F.col("name").alias("organization_name"),
        F.col("slug").alias("organization_slug"),
    )
    consumers = catalog["consumers"].select(F.col("id").alias("consumer_id"), "gateway_consumer_id", "identity_ref")
    joined = catalog["api_keys"].join(orgs, "organization_id").join(consumers, "consumer_id")
    added = ["organization_name", "organization_slug", "gateway_consumer_id", "identity_ref"]
    return joined.select(*catalog["api_keys"].columns, *added)


def chains_status(catalog: Catalog) -> DataFrame:
    """Active chains with the number, health and mean latency of their endpoints."""
    endpoints = (
        catalog["rpc_endpoints"]
        .groupBy(F.col("chain_id").alias("id"))
        .agg(
            F.count("id").alias("endpoint_count"),
            F.count_if(F.col("is_active") & F.col("is_healthy")).alias("healthy_endpoint_count"),
            F.avg("avg_latency_ms").alias("avg_latency_ms"),
        )
    )
    chains = catalog["chains"].where("is_active")
    return chains.join(endpoints, "id", "left").select(
        *chains.columns,
        F.coalesce("endpoint_count", F.lit(0)).alias("endpoint_count"),
        F.coalesce("healthy_endpoint_count", F.lit(0)).alias("healthy_endpoint_count"),
        "avg_latency_ms",
    )


def _plan_chain_matrix(catalog: Catalog) -> DataFrame:
    """Every plan with every active chain; access is null for plans no longer offered.

    The chain list is one small configuration row, read once as a scalar
    subquery and unfolded per plan.
    """
    active = catalog["chains"].where("is_active")
    listed = active.agg(F.collect_list(F.struct("id", "slug", "chain_type"))).scalar()
    plans = catalog["plans"]
    pairs = plans.select(
        F.col("id").alias("plan_id"),
        F.col("slug").alias("plan_slug"),
        F.col("is_active").alias("_offered"),
        parsed_list("allowed_chains").alias("allowed_chains"),
        F.col("rate_limit_per_minute").alias("_plan_limit"),
        "archive_access",
        "trace_access",
        "websocket_access",
        F.explode(listed).alias("_chain"),
    ).select("*", F.col("_chain.id").alias("chain_id"), F.col("_chain.slug").alias("chain_slug"), "_chain.chain_type")
    limits = catalog["plan_chain_limits"].select(
        "plan_id", "chain_id", F.col("rate_limit_per_minute").alias("_chain_limit")
    )
    offered = F.coalesce("_offered", F.lit(False))
    matrix = pairs.join(limits, ["plan_id", "chain_id"], "left")
    return matrix.select(
        "plan_id",
        "plan_slug",
        "chain_id",
        "chain_slug",
        "chain_type",
        offered.alias("_offered"),
        F.when(offered, chain_allowed("allowed_chains", "chain_slug")).alias("has_access"),
        F.when(offered, F.coalesce("_chain_limit", "_plan_limit")).alias("rate_limit_per_minute"),
        *[F.when(offered, F.col(c)).alias(c) for c in ("archive_access", "trace_access", "websocket_access")],
    )


def plan_chain_access(catalog: Catalog) -> DataFrame:
    """Which offered plan may use which active chain, and the limit that holds there."""
    return _plan_chain_matrix(catalog).where("_offered").drop("_offered", "chain_type")


def consumer_chain_access(catalog: Catalog) -> DataFrame:
    """The access row of each consumer, subscribed plan and active chain.

    Tests only subscription and chain status, as its definition does.
    """
    consumers = catalog["consumers"].select(F.col("id").alias("consumer_id"), "organization_id", "identity_ref")
    subscribed = catalog["subscriptions"].where(F.col("status") == "active").select("organization_id", "plan_id")
    matrix = _plan_chain_matrix(catalog).drop("_offered")
    return (
        consumers.join(subscribed, "organization_id")
        .join(matrix, "plan_id")
        .select(
            "consumer_id",
            "identity_ref",
            "plan_id",
            "plan_slug",
            "chain_id",
            "chain_slug",
            "chain_type",
            "has_access",
            "rate_limit_per_minute",
            "archive_access",
            "trace_access",
            "websocket_access",
        )
    )


def subscription_listing(catalog: Catalog) -> DataFrame:
    """Organisation, plan, status and period end, by organisation name."""
    orgs = catalog["organizations"].select(F.col("id").alias("organization_id"), F.col("name").alias("organization"))
    plans = catalog["plans"].select(F.col("id").alias("plan_id"), F.col("name").alias("plan"))
    joined = catalog["subscriptions"].join(orgs, "organization_id").join(plans, "plan_id")
    return joined.select("organization", "plan", "status", "current_period_end").orderBy(
        "organization", "plan", "status", "current_period_end"
    )


def active_chains(catalog: Catalog) -> DataFrame:
    """Active chains, main networks first."""
    chains = catalog["chains"].where("is_active").orderBy("is_testnet", "name")
    return chains.select("slug", "chain_type", "chain_id", "is_testnet")


# The catalog's constraints.
ALLOWED_VALUES = [
    ("organizations", "status", ["active", "suspended", "deleted"]),
    ("users", "role", ["owner", "admin", "member"]),
    ("users", "status", ["active", "inactive", "suspended"]),
    ("subscriptions", "status", ["active", "past_due", "canceled", "suspended"]),
    ("subscriptions", "billing_period", ["monthly", "yearly"]),
    ("consumers", "status", ["active", "inactive", "suspended"]),
    ("api_keys", "status", ["active", "revoked", "expired"]),
    ("invoices", "status", ["draft", "open", "paid", "void", "uncollectible"]),
    ("webhook_deliveries", "status", ["pending", "success", "failed", "retrying"]),
    ("rpc_endpoints", "endpoint_type", ["http", "https", "ws", "wss"]),
]
RANGES = [("rpc_endpoints", "weight", 0, 1000)]
UNIQUE = [
    ("organizations", ["slug"]),
    ("users", ["email"]),
    ("plans", ["name"]),
    ("plans", ["slug"]),
    ("consumers", ["gateway_consumer_id"]),
    ("consumers", ["identity_ref"]),
    ("api_keys", ["key_ref"]),
    ("invoices", ["invoice_number"]),
    ("chains", ["name"]),
    ("chains", ["slug"]),
    ("plan_chain_limits", ["plan_id", "chain_id"]),
    ("method_compute_units", ["chain_type", "method_name"]),
]
REFERENCES = [
    ("users", "organization_id", "organizations"),
    ("subscriptions", "organization_id", "organizations"),
    ("subscriptions", "plan_id", "plans"),
    ("consumers", "organization_id", "organizations"),
    ("api_keys", "organization_id", "organizations"),
    ("api_keys", "consumer_id", "consumers"),
    ("invoices", "organization_id", "organizations"),
    ("invoices", "subscription_id", "subscriptions"),
    ("webhooks", "organization_id", "organizations"),
    ("webhook_deliveries", "webhook_id", "webhooks"),
    ("audit_logs", "organization_id", "organizations"),
    ("audit_logs", "user_id", "users"),
    ("rpc_endpoints", "chain_id", "chains"),
    ("plan_chain_limits", "plan_id", "plans"),
    ("plan_chain_limits", "chain_id", "chains"),
]


def _rules(catalog: Catalog) -> list[tuple[str, list[str], str, str | None, Column | None]]:
    """(table, columns, rule, parent, what offends) of the rules whose tables and columns are there."""
    found = [(t, [c], "allowed_values", None, ~F.col(c).isin(allowed)) for t, c, allowed in ALLOWED_VALUES]
    found += [(t, [c], "range", None, ~F.col(c).between(low, high)) for t, c, low, high in RANGES]
    found += [(t, columns, "unique", None, None) for t, columns in UNIQUE]
    found += [(t, [c], "foreign_key", parent, None) for t, c, parent in REFERENCES]

    def present(table: str, columns: Sequence[str]) -> bool:
        return table in catalog and all(c in catalog[table].columns for c in columns)

    return [r for r in found if present(r[0], r[1]) and (r[3] is None or present(r[3], ["id"]))]


def audit_catalog(catalog: Catalog) -> DataFrame:
    """(table_name, column_name, rule, value, violations), one row per offending value.

    Only tables and columns present in ``catalog`` are audited.  As in SQL
    constraints, a null value violates nothing.

    Each table is read once: a row unfolds into an entry per rule that its values concern, and one for its id if other tables refer to
    it.  Entries are counted per value with map-side combine, so a hot value is one row per task; references to one
    table meet its ids, and each other, in the same group.
    """
    rules = _rules(catalog)
    parents = {parent for _, _, _, parent, _ in rules if parent}
    parts = []
    for table, df in catalog.items():
        entry = lambda scope, rule, columns: F.struct(
            F.lit(scope).alias("scope"), F.lit(rule).alias("rule"), F.array(*[F.col(c).cast("string") for c in columns]).alias("values")
        )
        entries = []
        for number, (of, columns, _, parent, offends) in enumerate(rules):
            if of == table:
                concerned = reduce(and_, [F.col(c).isNotNull() for c in columns])
                concerned = concerned if offends is None else concerned & F.coalesce(offends, F.lit(False))
                entries.append(F.when(concerned, entry(parent or str(number), number, columns)))
        if table in parents:
            entries.append(F.when(F.col("id").isNotNull(), entry(table, -1, ["id"])))
        if entries:
            parts.append(df.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*"))
    if not parts:
        raise ValueError("no table of the catalog has a rule")
    references = [n for n, rule in enumerate(rules) if rule[3]]
    counted = reduce(DataFrame.unionByName, parts).groupBy("scope", "values").agg(
        F.max("rule").alias("_rule"),
        F.count(F.lit(1)).alias("_rows"),
        F.max(F.col("rule") == -1).alias("_known"),
        *[F.count_if(F.col("rule") == n).alias(f"_n{n}") for n in references],
    )
    # Scopes of references hold the entries of several rules, all others those of one.
    unique = F.lit([n for n, rule in enumerate(rules) if rule[2] == "unique"] or [-2])
    own = F.when(~F.array_contains(unique, F.col("_rule")) | (F.col("_rows") > 1), F.struct(F.col("_rule").alias("rule"), F.col("_rows").alias("n")))
    dangling = [F.when(F.col(f"_n{n}") > 0, F.struct(F.lit(n).alias("rule"), F.col(f"_n{n}").alias("n"))) for n in references]
    listed = F.when(~F.col("scope").isin(*(parents or [""])), F.array(own))
    if references:
        listed = listed.when(~F.col("_known"), F.array(*dangling))
    name = lambda i: F.element_at(F.lit([",".join(r[i]) if i == 1 else r[i] for r in rules]), F.col("f.rule") + 1)
    return counted.select("values", F.explode(F.array_compact(listed)).alias("f")).select(
        name(0).alias("table_name"),
        name(1).alias("column_name"),
        name(2).alias("rule"),
        F.array_join("values", "|").alias("value"),
        F.col("f.n").cast("bigint").alias("violations"),
    )


UUID_PATTERN = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\z"
CHAIN_SLUG_PATTERN = r"^[a-z0-9-]+\z"


def flag_malformed(requests: DataFrame, uuid_columns: Sequence[str] = ("organization_id",)) -> DataFrame:
    """``malformed`` names the first column of wrong shape, null if none."""
    checks = [(c, UUID_PATTERN) for c in uuid_columns] + [("chain_slug", CHAIN_SLUG_PATTERN)]
    reasons = [F.when(~F.coalesce(F.col(c).rlike(p), F.lit(False)), F.lit(c)) for c, p in checks]
    return requests.withColumn("malformed", F.coalesce(*reasons))


def quarantine_malformed(
    requests: DataFrame, uuid_columns: Sequence[str] = ("organization_id",)
) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows, quarantined rows with the reason)."""
    flagged = flag_malformed(requests, uuid_columns)
    good = flagged.where(F.col("malformed").isNull()).drop("malformed")
    return good, flagged.where(F.col("malformed").isNotNull())
