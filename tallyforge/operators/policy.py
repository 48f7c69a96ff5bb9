"""Plan and scope gating and outcome classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.measures import chain_allowed, parsed_list, lookup
from tallyforge.operators.ingest import one_key_per_prefix

# Compute units from which a method counts as trace or archive.
TRACE_UNITS, ARCHIVE_UNITS = 50, 5
TRACE_PLANS = ["pro", "enterprise"]


def _gated(requests: DataFrame, trace_denied: Column, archive_denied: Column) -> DataFrame:
    required = F.when(trace_denied, "pro").when(archive_denied, "basic")
    gated = requests.withColumn("required_plan", required)
    return gated.select(*requests.columns, F.col("required_plan").isNull().alias("allowed"), "required_plan")


def plan_gate(
    requests: DataFrame, units: DataFrame | None = None, mode: str = "compute_units", plans: DataFrame | None = None
) -> DataFrame:
    """May the request's plan make this call, and if not, which plan may.

    ``compute_units`` is the live rule: 50 units need pro or enterprise, 5 to
    49 any plan but free.  ``flags`` is the catalog's rule: the method's
    archive and trace flags against the plan's access; a denied call needs pro.
    """
    if mode == "compute_units":
        cost, plan = F.col("compute_units"), F.col("plan_slug")
        trace_denied = (cost >= TRACE_UNITS) & ~plan.isin(TRACE_PLANS)
        archive_denied = (cost >= ARCHIVE_UNITS) & (cost < TRACE_UNITS) & (plan == "free")
        return _gated(requests, trace_denied, archive_denied)
    if mode != "flags" or units is None or plans is None:
        raise ValueError("mode is 'compute_units', or 'flags' with the method and plan tables")
    needs = units.select(
        "chain_type",
        F.col("method_name").alias("rpc_method"),
        F.col("requires_archive").alias("_needs_archive"),
        F.col("requires_trace").alias("_needs_trace"),
    )
    grants = plans.select(
        F.col("slug").alias("plan_slug"),
        F.col("archive_access").alias("_has_archive"),
        F.col("trace_access").alias("_has_trace"),
    )
    joined = requests.join(needs, ["chain_type", "rpc_method"], "left").join(grants, "plan_slug", "left")

    def denied(kind: str) -> Column:
        return F.coalesce(f"_needs_{kind}", F.lit(False)) & ~F.coalesce(f"_has_{kind}", F.lit(False))

    required = F.when(denied("trace") | denied("archive"), "pro")
    gated = joined.withColumn("required_plan", required)
    return gated.select(*requests.columns, F.col("required_plan").isNull().alias("allowed"), "required_plan")


def scope_gate(requests: DataFrame, catalog: dict[str, DataFrame]) -> DataFrame:
    """``scope_violation`` is 'chain', 'method', 'unknown_key' or null.

    The lists are parsed once per key, not per request.
    """
    keys = one_key_per_prefix(
        catalog["api_keys"].select("key_prefix", "id", "status", "allowed_chains", "restricted_methods")
    ).select(
        F.col("key_prefix").alias("api_key_prefix"),
        F.col("id").alias("_key"),
        parsed_list("allowed_chains").alias("_chains"),
        parsed_list("restricted_methods").alias("_methods"),
    )
    joined = lookup(requests, keys, ["api_key_prefix"])
    restricted = F.coalesce(F.array_contains("_methods", F.col("rpc_method")), F.lit(False))
    violation = (
        F.when(F.col("_key").isNull(), "unknown_key")
        .when(~chain_allowed("_chains", "chain_slug"), "chain")
        .when(restricted, "method")
    )
    return joined.withColumn("scope_violation", violation).select(*requests.columns, "scope_violation")


def outcome_class(requests: DataFrame) -> DataFrame:
    """Each request with its outcome: error from 500, warn from 400, else info."""
    status = F.col("status_code")
    return requests.withColumn("outcome", F.when(status >= 500, "error").when(status >= 400, "warn").otherwise("info"))


def outcome_counts(requests: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Requests per outcome class."""
    return outcome_class(requests).groupBy(*by, "outcome").agg(F.count(F.lit(1)).alias("requests"))
