"""Usage reports over stored usage state.

``daily_state`` and ``hourly_state`` are the state rows of
``operators.usage``.  With ``org=None`` a report covers all traffic.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.measures import at, gigabytes, last_moment, percent, within
from tallyforge.operators.catalog import org_profile
from tallyforge.operators.usage import finalize

Moment = date | datetime | str

# Sizes of a web response; a report has all its rows unless it is given a limit.
TOP_CHAINS, TOP_METHODS, NESTED_METHODS, HOURLY_ROWS = 50, 20, 10, 500
MAX_RANGE = timedelta(days=365)
MAX_HOURLY_RANGE = timedelta(days=7)


@dataclass(frozen=True)
class Range:
    """Report bounds, inclusive at both ends."""

    start: datetime
    end: datetime


def resolve_range(
    as_of: datetime, start: date | None = None, end: date | None = None, hourly: bool = False
) -> Range:
    """Defaults: first of the month to ``as_of``; a given end date means its last second."""
    begin = datetime.combine(start, datetime.min.time()) if start else datetime(as_of.year, as_of.month, 1)
    finish = datetime.combine(end, datetime.min.time()) + timedelta(days=1, seconds=-1) if end else as_of
    if finish < begin:
        raise ValueError("end_date must be after start_date")
    if finish - begin > MAX_RANGE:
        raise ValueError("date range cannot exceed 1 year")
    if hourly and finish - begin > MAX_HOURLY_RANGE:
        raise ValueError("hourly data limited to 7 days maximum")
    return Range(begin, finish)


def wants_breakdown(text: str | None) -> bool:
    """Only the exact text ``true`` turns the breakdown on."""
    return text == "true"


def _days(state: DataFrame, start: Moment, end: Moment) -> DataFrame:
    return within(state, "event_date", at(start).cast("date"), last_moment(end).cast("date"))


def _hours(state: DataFrame, start: Moment, end: Moment) -> DataFrame:
    return within(state, "hour", at(start), last_moment(end))


def _first(rows: DataFrame, limit: int | None) -> DataFrame:
    return rows if limit is None else rows.limit(limit)


def _of(state: DataFrame, column: str, wanted: str | None) -> DataFrame:
    return state if wanted is None else state.where(F.col(column) == wanted)


def _error_pct() -> Column:
    return percent(F.col("error_count"), F.col("request_count"))


def _summary(state: DataFrame, by: Sequence[str], quantiles: Sequence[float]) -> DataFrame:
    done = finalize(state, list(by), quantiles)
    count = F.coalesce("request_count", F.lit(0))
    return done.select(
        *by,
        count.alias("total_requests"),
        F.coalesce("compute_units_used", F.lit(0)).alias("total_compute_units"),
        gigabytes(F.coalesce("total_response_size", F.lit(0))).alias("total_egress_gb"),
        F.coalesce("error_count", F.lit(0)).alias("error_count"),
        _error_pct().alias("error_rate_pct"),
        *[f"latency_p{round(q * 100)}" for q in quantiles],
        F.when(count > 0, F.lit(100.0) - _error_pct()).otherwise(0.0).alias("success_rate_pct"),
    )


def usage_summary(daily_state: DataFrame, org: str | None, start: Moment, end: Moment) -> DataFrame:
    """One row, also when there was no traffic."""
    return _summary(_of(_days(daily_state, start, end), "organization_id", org), [], (0.95, 0.99))


def _by_chain(state: DataFrame, by: Sequence[str]) -> DataFrame:
    done = finalize(state, [*by, "chain_slug", "chain_type"], (0.95,))
    return done.select(
        *by,
        "chain_slug",
        "chain_type",
        F.col("request_count").alias("requests"),
        F.col("compute_units_used").alias("compute_units"),
        gigabytes(F.col("total_response_size")).alias("egress_gb"),
        "error_count",
        _error_pct().alias("error_rate_pct"),
        "latency_p95",
    )


_CHAIN_ORDER = ["chain_slug", "chain_type"]


def _busiest(*ties: str) -> list[Column]:
    return [F.col("requests").desc(), *[F.col(t) for t in ties]]


def usage_by_chain(
    daily_state: DataFrame, org: str | None, start: Moment, end: Moment, limit: int | None = None
) -> DataFrame:
    """Chains, busiest first; ``limit`` of them (such as TOP_CHAINS) if given."""
    state = _of(_days(daily_state, start, end), "organization_id", org)
    return _first(_by_chain(state, []).orderBy(*_busiest(*_CHAIN_ORDER)), limit)


def _by_method(state: DataFrame, by: Sequence[str]) -> DataFrame:
    named = state.where(F.col("rpc_method") != "")
    return finalize(named, [*by, "rpc_method"], (0.5,)).select(
        *by,
        F.col("rpc_method").alias("method"),
        F.col("request_count").alias("requests"),
        F.col("compute_units_used").alias("compute_units"),
        "error_count",
        "latency_p50",
    )


def usage_by_method(
    hourly_state: DataFrame, org: str | None, start: Moment, end: Moment, limit: int | None = None
) -> DataFrame:
    """D3: methods, busiest first; ``limit`` of them (such as TOP_METHODS) if given.  Calls without a method are left out."""
    state = _of(_hours(hourly_state, start, end), "organization_id", org)
    return _first(_by_method(state, []).orderBy(*_busiest("method")), limit)


def _daily(state: DataFrame, by: Sequence[str]) -> DataFrame:
    return finalize(state, [*by, "event_date"], ()).select(
        *by,
        "event_date",
        F.col("request_count").alias("requests"),
        F.col("compute_units_used").alias("compute_units"),
        gigabytes(F.col("total_response_size")).alias("egress_gb"),
        "error_count",
        _error_pct().alias("error_rate_pct"),
        # Unlike the summary, success here is the 2xx share.
        percent(F.col("status_2xx_count"), F.col("request_count")).alias("success_rate_pct"),
    )


def daily_usage(daily_state: DataFrame, org: str | None, start: Moment, end: Moment) -> DataFrame:
    """One row per day with traffic."""
    return _daily(_of(_days(daily_state, start, end), "organization_id", org), []).orderBy("event_date")


def _hourly(state: DataFrame, by: Sequence[str]) -> DataFrame:
    return finalize(state, [*by, "hour", "chain_slug"], (0.5, 0.95, 0.99)).select(
        *by,
        "hour",
        "chain_slug",
        F.col("request_count").alias("requests"),
        F.col("compute_units_used").alias("compute_units"),
        gigabytes(F.col("total_response_size")).alias("egress_gb"),
        "error_count",
        "latency_p50",
        "latency_p95",
        "latency_p99",
    )


def hourly_usage(
    hourly_state: DataFrame,
    org: str | None,
    start: Moment,
    end: Moment,
    chain: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Hour by chain; ``limit`` rows (such as HOURLY_ROWS) if given.  ``resolve_range`` has the seven days of a web request."""
    state = _of(_of(_hours(hourly_state, start, end), "organization_id", org), "chain_slug", chain or None)
    return _first(_hourly(state, []).orderBy("hour", "chain_slug"), limit)


def api_key_usage(daily_state: DataFrame, key_prefix: str | None, start: Moment, end: Moment) -> DataFrame:
    """Summary of one key, or of every key seen when ``key_prefix`` is None.

    The owner is looked up over all days, as a key may have no traffic in the
    range; a key never seen raises when the report is read.
    """
    state = _of(daily_state, "api_key_prefix", key_prefix)
    owner = F.min("organization_id").alias("organization_id")
    if key_prefix is None:
        owners = state.groupBy(F.col("api_key_prefix").alias("key_prefix")).agg(owner)
    else:
        known = F.coalesce("organization_id", F.raise_error(F.lit(f"unknown API key {key_prefix}")).cast("string"))
        owners = state.agg(owner).select(
            F.lit(key_prefix).alias("key_prefix"), known.alias("organization_id")
        )
    summary = _summary(_days(state, start, end), ["api_key_prefix"], (0.95,)).withColumnRenamed(
        "api_key_prefix", "key_prefix"
    )
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("total_requests", "total_compute_units", "error_count")}
    zero |= {c: F.coalesce(c, F.lit(0.0)) for c in ("total_egress_gb", "success_rate_pct")}
    return owners.join(summary, "key_prefix", "left").withColumns(zero)


def usage_report(
    daily_state: DataFrame,
    hourly_state: DataFrame,
    catalog: dict[str, DataFrame],
    org: str | None,
    start: Moment,
    end: Moment,
    breakdown: bool = False,
    chain_limit: int | None = None,
    method_limit: int | None = None,
) -> DataFrame:
    """Organisation, period and summary as nested rows, with chains and methods
    as arrays, busiest first, if asked for; at most ``chain_limit`` (such as TOP_CHAINS) and
    ``method_limit`` (such as NESTED_METHODS) of them if given.

    One row for ``org`` (none if it is unknown), or one per organisation.
    """
    daily = _of(_days(daily_state, start, end), "organization_id", org)
    by = ["organization_id"]
    quantiles = (0.95, 0.99)
    summary = _summary(daily, by, quantiles)
    zero = [
        F.coalesce("total_requests", F.lit(0)).alias("total_requests"),
        F.coalesce("total_compute_units", F.lit(0)).alias("total_compute_units"),
        F.coalesce("total_egress_gb", F.lit(0.0)).alias("total_egress_gb"),
        F.coalesce("error_count", F.lit(0)).alias("error_count"),
        "error_rate_pct",
        "latency_p95",
        "latency_p99",
        F.coalesce("success_rate_pct", F.lit(0.0)).alias("success_rate_pct"),
    ]
    profile = org_profile(catalog, org).select("organization_id", "name", "plan_slug")
    report = profile.join(summary, by, "left").select(
        *by,
        F.struct(F.col("organization_id").alias("id"), "name", "plan_slug").alias("organization"),
        F.struct(at(start).alias("start"), last_moment(end).alias("end")).alias("period"),
        F.struct(*zero).alias("summary"),
    )
    if breakdown:
        hourly = _of(_hours(hourly_state, start, end), "organization_id", org)
        chains = _listed(_top(_by_chain(daily, by), chain_limit, *_CHAIN_ORDER), "by_chain")
        methods = _listed(_top(_by_method(hourly, by), method_limit, "method"), "top_methods")
        report = report.join(chains, by, "left").join(methods, by, "left")
        for column in ("by_chain", "top_methods"):
            report = report.withColumn(column, F.coalesce(column, F.array().cast(report.schema[column].dataType)))
    return report.drop("organization_id")


def _top(report: DataFrame, limit: int | None, *ties: str) -> DataFrame:
    """The busiest rows of each organisation, all without ``limit``; Spark cuts groups down before the shuffle."""
    if limit is None:
        return report
    rank = F.row_number().over(Window.partitionBy("organization_id").orderBy(*_busiest(*ties)))
    return report.withColumn("_rank", rank).where(F.col("_rank") <= limit).drop("_rank")


def _listed(report: DataFrame, name: str) -> DataFrame:
    """Each organisation's rows as an array, busiest first; there are no more than chains or methods."""
    columns = [c for c in report.columns if c != "organization_id"]
    entry = F.struct((-F.col("requests")).alias("_order"), F.struct(*columns).alias("row"))
    ordered = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["row"])
    return report.groupBy("organization_id").agg(ordered.alias(name))


GRAINS = ("summary", "chain", "method", "daily", "hourly", "api_key")


def usage_reports_all(
    daily_state: DataFrame,
    hourly_state: DataFrame,
    start: Moment,
    end: Moment,
    grain: str = "summary",
    limit: int | None = None,
) -> DataFrame:
    """The report of every organisation in one job.

    ``limit`` (such as TOP_CHAINS or TOP_METHODS) holds per organisation, for the
    grains chain and method; ranking uses a windowed row number, which Spark cuts
    down before the shuffle.  All grains cover the same requests, but calls without a
    method have no row by method.
    """
    by = ["organization_id"]

    if grain == "summary":
        return _summary(_days(daily_state, start, end), by, (0.95, 0.99))
    if grain == "chain":
        return _top(_by_chain(_days(daily_state, start, end), by), limit, *_CHAIN_ORDER)
    if grain == "method":
        return _top(_by_method(_hours(hourly_state, start, end), by), limit, "method")
    if grain == "daily":
        return _daily(_days(daily_state, start, end), by)
    if grain == "hourly":
        return _hourly(_hours(hourly_state, start, end), by)
    if grain == "api_key":
        return api_key_usage(daily_state, None, start, end)
    raise ValueError(f"unknown grain {grain!r}")
