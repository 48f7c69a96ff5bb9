"""Metering, rating, contracts, invoices, closing, reconciliation, currency and revenue.

The documents behind these name the jobs but not every formula; what is our
assumption is said in the docstring.  Money is decimal throughout.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.operators.usage import finalize

MONEY = "decimal(18,2)"
QUANTITY = "decimal(18,4)"
METER_KEYS = ["period_start", "organization_id", "plan_slug", "chain_slug"]

_METERS = {
    "compute_units": "compute_units_used",
    "requests": "request_count",
    "egress_bytes": "total_response_size",
}


def meter(daily_state: DataFrame, period: str = "month", value: str = "compute_units") -> DataFrame:
    """H1: usage per period, organisation, plan and chain, as ``units``."""
    if value not in _METERS:
        raise ValueError(f"unknown meter {value!r}")
    dated = daily_state.withColumn("period_start", F.date_trunc(period, "event_date").cast("date"))
    done = finalize(dated, METER_KEYS, ())
    return done.select(*METER_KEYS, F.col(_METERS[value]).alias("units"))


def rate_usage(metered: DataFrame, prices: DataFrame, coefficients: DataFrame) -> DataFrame:
    """H2: cost of each metered row.

    Units are weighed by the coefficient of their chain (1 where it is missing).  A plan's
    included units are free once per organisation, plan and period; what is beyond them is
    billable and is shared by the chains in proportion to their weighted units.
    Shares and costs are differences of rounded running totals in the order of the chain, so they
    add up to the plan's.  ``prices`` has plan_slug, included_units and overage_rate;
    ``coefficients`` has chain_slug and coefficient.  An unpriced plan costs nothing.
    """
    rates = prices.select(
        "plan_slug",
        F.col("included_units").cast(QUANTITY).alias("_included"),
        F.col("overage_rate").cast("decimal(12,6)").alias("_rate"),
    )
    weights = coefficients.select("chain_slug", F.col("coefficient").cast("decimal(9,4)").alias("_weight"))
    joined = metered.join(rates, "plan_slug", "left").join(weights, "chain_slug", "left")
    weight = F.coalesce("_weight", F.lit(1).cast("decimal(9,4)"))
    weighted = (F.col("units").cast("decimal(18,0)") * weight).cast(QUANTITY)
    none = F.lit(0).cast(QUANTITY)
    # A group holds one row per chain, so these windows are bounded by the catalog.
    plan = Window.partitionBy("period_start", "organization_id", "plan_slug")
    chains = plan.orderBy("chain_slug")
    # Ten-thousandths as whole numbers, so that shares are exact: running * beyond / total, halves rounded up.
    whole = lambda x: (x * 10000).cast("decimal(18,0)")
    total = F.sum("weighted_units").over(plan).cast(QUANTITY)
    beyond = whole(F.greatest(total - F.coalesce("_included", none), none))
    running = whole(F.sum("weighted_units").over(chains).cast(QUANTITY))
    halved = F.call_function("div", running * beyond * 2 + whole(total), whole(total) * 2)
    shared = F.when(total > 0, (halved.cast("decimal(18,0)") / 10000).cast(QUANTITY)).otherwise(none)
    cost = F.round(F.col("_billable") * F.coalesce("_rate", F.lit(0).cast("decimal(12,6)")), 2).cast(MONEY)
    return (
        joined.withColumn("weighted_units", weighted)
        .withColumn("_billable", shared)
        .withColumn("_cost", cost)
        .select(
            *metered.columns,
            "weighted_units",
            (F.col("_billable") - F.coalesce(F.lag("_billable").over(chains), none)).cast(QUANTITY).alias("billable_units"),
            (F.col("_cost") - F.coalesce(F.lag("_cost").over(chains), F.lit(0).cast(MONEY))).cast(MONEY).alias("cost"),
        )
    )


def contract_terms(contracts: DataFrame, periods: DataFrame) -> DataFrame:
    """The contract of each organisation in each period.

    A contract holds in a period if it holds on its first day; ``start_date`` and ``end_date``
    may be missing or null.  Of several the latest start counts, then the highest price.
    ``periods`` is a short list of period_start.
    """
    dated = contracts
    for column in ("start_date", "end_date"):
        if column not in contracts.columns:
            dated = dated.withColumn(column, F.lit(None).cast("date"))
    starts = periods.agg(F.collect_set("period_start").alias("_periods"))
    every = dated.crossJoin(starts).withColumn("period_start", F.explode("_periods"))
    holds = F.coalesce(F.col("start_date") <= F.col("period_start"), F.lit(True))
    holds &= F.coalesce(F.col("end_date") >= F.col("period_start"), F.lit(True))
    price = F.col("price_fixed").cast(MONEY).alias("_price")
    latest = F.max(F.struct(F.coalesce("start_date", F.lit("0001-01-01").cast("date")), price, "contract_type")).alias("_terms")
    kept = every.where(holds).groupBy("period_start", "organization_id").agg(latest)
    return kept.select("period_start", "organization_id", "_terms.contract_type", "_terms._price")


def apply_contracts(rated: DataFrame, contracts: DataFrame, periods: DataFrame | None = None) -> DataFrame:
    """H3: what each organisation owes per period.

    FIXED charges the price only, METERED the usage only, HYBRID (assumption)
    both; an organisation without a contract is metered.  A price is owed in every period in
    which the contract holds, with usage or without.  ``contracts`` has organization_id,
    contract_type, price_fixed and, if they end, start_date and end_date; ``periods`` are
    those of ``rated`` unless given.
    """
    usage = rated.groupBy("period_start", "organization_id").agg(F.sum("cost").cast(MONEY).alias("usage_cost"))
    terms = contract_terms(contracts, rated if periods is None else periods)
    kind = F.coalesce("contract_type", F.lit("METERED"))
    nothing = F.lit(0).cast(MONEY)
    fixed = F.when(kind.isin("FIXED", "HYBRID"), F.coalesce("_price", nothing)).otherwise(nothing)
    metered = F.when(kind.isin("METERED", "HYBRID"), F.coalesce("usage_cost", nothing)).otherwise(nothing)
    owing = usage.join(terms, ["period_start", "organization_id"], "full")
    return owing.where(F.col("usage_cost").isNotNull() | (kind != "METERED")).select(
        "period_start",
        "organization_id",
        kind.alias("contract_type"),
        fixed.cast(MONEY).alias("fixed_charge"),
        metered.cast(MONEY).alias("usage_charge"),
        (fixed + metered).cast(MONEY).alias("amount"),
    )


def plan_charges(
    rated: DataFrame, prices: DataFrame, contracts: DataFrame | None = None, held: DataFrame | None = None
) -> DataFrame:
    """H2, H3: base fee and usage of each plan that an organisation has in a period.

    A plan's ``base_fee`` (in ``prices``; none if missing) is owed once per organisation and period, however many
    chains are used, and before any overage.  ``held`` lists period_start, organization_id and plan_slug of plans that
    are owed without usage too, as subscriptions; plans with usage are owed anyway.  A FIXED contract charges neither
    (see ``apply_contracts`` for its price).
    """
    keys = ["period_start", "organization_id", "plan_slug"]
    plans = rated.groupBy(*keys).agg(F.sum("cost").cast(MONEY).alias("_usage"))
    if held is not None:
        idle = held.select(*keys, F.lit(0).cast(MONEY).alias("_usage"))
        plans = plans.unionByName(idle).groupBy(*keys).agg(F.sum("_usage").cast(MONEY).alias("_usage"))
    charged = F.lit(True)
    rows = plans.join(prices.select("plan_slug", F.col("base_fee").cast(MONEY).alias("_base")), "plan_slug", "left")
    if contracts is not None:
        terms = contract_terms(contracts, plans).select("period_start", "organization_id", "contract_type")
        rows = rows.join(terms, ["period_start", "organization_id"], "left")
        charged = F.coalesce(F.col("contract_type") != "FIXED", F.lit(True))
    nothing = F.lit(0).cast(MONEY)
    base = F.when(charged, F.coalesce("_base", nothing)).otherwise(nothing).cast(MONEY)
    usage = F.when(charged, F.coalesce("_usage", nothing)).otherwise(nothing).cast(MONEY)
    return rows.select(*keys, base.alias("base_fee"), usage.alias("usage_charge"), (base + usage).cast(MONEY).alias("amount"))


_PERIOD_END = {
    "month": F.last_day,
    "week": lambda start: F.date_add(start, 6),
    "day": lambda start: start,
}


def build_invoices(
    rated: DataFrame,
    contracts: DataFrame | None = None,
    tax_rate: str = "0.20",
    currency: str = "USD",
    period: str = "month",
) -> DataFrame:
    """H4: one invoice per organisation and period, with its lines as an array.

    There is one line per chain and plan used, and one for a fixed price, which is
    billed also without usage; the number of lines is bounded by the catalog, not by usage.
    """
    if contracts is None:
        charges = rated.groupBy("period_start", "organization_id").agg(F.sum("cost").cast(MONEY).alias("amount"))
        charges = charges.withColumns(
            {"fixed_charge": F.lit(0).cast(MONEY), "usage_charge": F.col("amount"), "contract_type": F.lit("METERED")}
        )
    else:
        charges = apply_contracts(rated, contracts)
    lines = rated.groupBy("period_start", "organization_id").agg(
        F.array_sort(
            F.collect_list(F.struct("chain_slug", "plan_slug", "units", F.col("cost").alias("amount")))
        ).alias("_lines")
    )
    usage_billed = F.col("contract_type") != "FIXED"
    nothing = F.lit(0).cast(MONEY)
    usage_lines = F.transform(
        F.coalesce("_lines", F.array().cast(lines.schema["_lines"].dataType)),
        lambda line: F.struct(
            F.concat(line["chain_slug"], F.lit(" - "), line["units"].cast("string"), F.lit(" units")).alias("description"),
            F.when(usage_billed, line["amount"]).otherwise(nothing).cast(MONEY).alias("amount"),
        ),
    )
    fixed_line = F.array(
        F.struct(F.lit("fixed price").alias("description"), F.col("fixed_charge").cast(MONEY).alias("amount"))
    )
    subtotal = F.col("amount").cast(MONEY)
    tax = F.round(subtotal * F.lit(tax_rate).cast("decimal(5,4)"), 2).cast(MONEY)
    return charges.join(lines, ["period_start", "organization_id"], "left").select(
        F.concat_ws("-", F.lit("INV"), F.date_format("period_start", "yyyy-MM-dd"), "organization_id").alias(
            "invoice_number"
        ),
        "organization_id",
        "period_start",
        _PERIOD_END[period](F.col("period_start")).alias("period_end"),
        F.col("fixed_charge").cast(MONEY).alias("fixed_charge"),
        F.col("usage_charge").cast(MONEY).alias("usage_charge"),
        subtotal.alias("subtotal"),
        tax.alias("tax"),
        (subtotal + tax).cast(MONEY).alias("total"),
        F.lit(currency).alias("currency"),
        F.when(F.col("contract_type") == "METERED", usage_lines)
        .otherwise(F.concat(usage_lines, fixed_line))
        .alias("line_items"),
    )


def close_period(metered: DataFrame) -> DataFrame:
    """H5: the snapshot of a period, each row with the SHA-256 of its JSON."""
    return metered.withColumn("row_hash", F.sha2(F.to_json(F.struct(*metered.columns)), 256))


def broken_rows(snapshot: DataFrame) -> DataFrame:
    """The rows of a closed period whose hash is not that of their other columns."""
    columns = [c for c in snapshot.columns if c != "row_hash"]
    return snapshot.where(~F.col("row_hash").eqNullSafe(F.sha2(F.to_json(F.struct(*columns)), 256)))


def reconcile(invoices: DataFrame, snapshot: DataFrame, contracts: DataFrame | None = None) -> DataFrame:
    """H6: invoices against what the closed period owes, per organisation and period.

    ``snapshot`` is the rated usage as ``close_period`` keeps it.  Its charges are worked out
    again with the ``contracts``; usage is compared with usage and the fixed price with the
    contract's.  Outcomes: missing_invoice, missing_snapshot, broken_snapshot (a hash does
    not fit), mismatch, match.
    """
    keys = ["period_start", "organization_id"]
    billed = invoices.groupBy(*keys).agg(
        F.sum("usage_charge").cast(MONEY).alias("_usage"),
        F.sum("fixed_charge").cast(MONEY).alias("_fixed"),
        F.sum("subtotal").cast(MONEY).alias("invoice_total"),
    )
    if contracts is None:
        contracts = snapshot.sparkSession.createDataFrame(
            [], "organization_id string, contract_type string, price_fixed decimal(10,2)"
        )
    periods = snapshot.select("period_start").unionByName(invoices.select("period_start"))
    owed = apply_contracts(snapshot, contracts, periods).select(
        *keys, F.col("usage_charge").alias("_usage_owed"), F.col("fixed_charge").alias("_fixed_owed"), F.col("amount").alias("snapshot_total")
    )
    broken = broken_rows(snapshot).select(*keys).distinct().withColumn("_broken", F.lit(True))
    both = billed.join(owed, keys, "full").join(broken, keys, "left")
    nothing = F.lit(0).cast(MONEY)
    difference = (F.coalesce("invoice_total", nothing) - F.coalesce("snapshot_total", nothing)).cast(MONEY)
    differs = (F.col("_usage") != F.col("_usage_owed")) | (F.col("_fixed") != F.col("_fixed_owed")) | (difference != 0)
    outcome = (
        F.when(F.col("invoice_total").isNull(), "missing_invoice")
        .when(F.col("snapshot_total").isNull(), "missing_snapshot")
        .when(F.coalesce("_broken", F.lit(False)), "broken_snapshot")
        .when(differs, "mismatch")
        .otherwise("match")
    )
    return both.select(*keys, "invoice_total", "snapshot_total", difference.alias("difference"), outcome.alias("outcome"))


def daily_rates(fx: DataFrame, until: date | str, rate: str = "try_per_usd") -> DataFrame:
    """The rate that holds on each day from the first quote to ``until``.

    A calendar of days: its size is the number of days, whatever the usage.
    """
    following = F.lead("rate_date").over(Window.partitionBy(F.lit(rate)).orderBy("rate_date"))
    end = F.lit(str(until)).cast("date")
    spans = fx.withColumn("_next", F.coalesce(following, F.date_add(F.greatest(end, F.col("rate_date")), 1)))
    days = F.explode(F.sequence(F.col("rate_date"), F.date_sub("_next", 1)))
    return spans.select(days.alias("day"), F.col(rate).alias("fx_rate"), (F.col("rate_date")).alias("quoted_on"))


def convert_fx(
    invoices: DataFrame,
    fx: DataFrame,
    until: date | str | None = None,
    amount: str = "total",
    day: str = "period_end",
    rate: str = "try_per_usd",
) -> DataFrame:
    """H7: amount at the rate of its day, else at the last known rate, marked estimated.

    ``until`` bounds the calendar of days, the day of the last quote if not given; on days
    after it the last quote holds.
    """
    last = fx.agg(F.max(F.struct(F.col("rate_date").alias("on"), F.col(rate).alias("at"))).alias("_last"))
    rates = daily_rates(fx, until or "0001-01-01", rate).withColumnRenamed("day", day)
    after = F.col("fx_rate").isNull() & (F.col(day) > F.col("_last.on"))
    held = invoices.join(rates, day, "left").crossJoin(last)
    held = held.withColumn("quoted_on", F.when(after, F.col("_last.on")).otherwise(F.col("quoted_on")))
    held = held.withColumn("fx_rate", F.when(after, F.col("_last.at")).otherwise(F.col("fx_rate")))
    converted = F.round(F.col(amount) * F.col("fx_rate"), 2).cast(MONEY)
    return held.select(
        *invoices.columns,
        "fx_rate",
        converted.alias("converted_amount"),
        (F.col("quoted_on") < F.col(day)).alias("estimated"),
    )


def revenue(rated: DataFrame) -> DataFrame:
    """H8: revenue per chain and plan."""
    return rated.groupBy("chain_slug", "plan_slug").agg(
        F.sum("cost").cast(MONEY).alias("revenue"), F.sum("units").alias("units")
    )


def top_customers(rated: DataFrame, n: int = 10) -> DataFrame:
    """H8: the customers with the most usage."""
    totals = rated.groupBy("organization_id").agg(F.sum("units").alias("units"), F.sum("cost").cast(MONEY).alias("revenue"))
    return totals.orderBy(F.col("units").desc(), "organization_id").limit(n)


def late_adjustments(
    snapshot: DataFrame, metered: DataFrame, keys: Sequence[str] = tuple(METER_KEYS), value: str = "units"
) -> DataFrame:
    """What arrived after a period was closed, as differences to bill in the next cycle."""
    before = snapshot.groupBy(*keys).agg(F.sum(value).alias("closed_units"))
    after = metered.groupBy(*keys).agg(F.sum(value).alias("current_units"))
    nothing = F.lit(0)
    delta = F.coalesce("current_units", nothing) - F.coalesce("closed_units", nothing)
    same = [after[k].eqNullSafe(before[k]) for k in keys]
    return (
        after.join(before, same, "full")
        .select(
            *[F.coalesce(after[k], before[k]).alias(k) for k in keys],
            F.coalesce("closed_units", nothing).alias("closed_units"),
            F.coalesce("current_units", nothing).alias("current_units"),
            delta.alias("adjustment"),
        )
        .where(F.col("adjustment") != 0)
    )
