"""Rates, ratios, top series, bucket quantiles and alerts over the request log.

The value of a series at time t covers [t - window, t); t runs over the
multiples of the step, and a window without requests gives no row.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce
from math import gcd
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.measures import percent, quantile_label, ratio
from tallyforge.functions.rollup import Rollup

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds(span: str | int | timedelta) -> int:
    """'5 minutes', 300 or a timedelta as whole seconds."""
    if isinstance(span, timedelta):
        return int(span.total_seconds())
    if isinstance(span, int):
        return span
    amount, unit = span.split()
    return int(amount) * _UNIT_SECONDS[unit.rstrip("s")]


def sliding(
    requests: DataFrame, by: Sequence[str], sums: dict[str, Column], window: str | int, step: str | int
) -> DataFrame:
    """(eval_time, by..., sums...) over sliding windows.

    Requests are first summed per grain, the largest span of which window and step
    are multiples, so only one row per series and grain, not every request, is
    copied into the windows that cover it.  A window shorter than the step leaves
    requests between windows out, as it must.
    """
    width, stride = seconds(window), seconds(step)
    grain = gcd(width, stride)
    moment = F.unix_seconds("event_time")
    start = moment - F.pmod(moment, F.lit(grain))
    per_step = requests.groupBy(*by, start.alias("_start")).agg(*[F.sum(c).alias(k) for k, c in sums.items()])
    if width == stride:
        return per_step.select(F.timestamp_seconds(F.col("_start") + stride).alias("eval_time"), *by, *sums)
    # The ends are the multiples of the step in (start, start + width].
    first = F.col("_start") - F.pmod(F.col("_start"), F.lit(stride)) + stride
    last = F.col("_start") + width
    ends = F.when(first <= last, F.sequence(first, last, F.lit(stride).cast("bigint")))
    covering = per_step.select(*by, *sums, F.explode(ends).alias("_end"))
    return (
        covering.groupBy("_end", *by)
        .agg(*[F.sum(k).alias(k) for k in sums])
        .select(F.timestamp_seconds("_end").alias("eval_time"), *by, *sums)
    )


def _per_second(
    requests: DataFrame, by: Sequence[str], amount: Column, window: str | int, step: str | int
) -> DataFrame:
    totals = sliding(requests, by, {"_amount": amount}, window, step)
    value = (F.col("_amount").cast("double") / F.lit(float(seconds(window)))).alias("value")
    return totals.select("eval_time", *by, value)


def rate(
    requests: DataFrame, by: Sequence[str], window: str | int = "1 minute", step: str | int = "1 minute"
) -> DataFrame:
    """requests per second by any labels."""
    return _per_second(requests, by, F.lit(1), window, step)


def success_ratio(
    requests: DataFrame, by: Sequence[str], window: str | int = "5 minutes", step: str | int = "1 minute"
) -> DataFrame:
    """share of 2xx responses."""
    good = F.col("status_code").between(200, 299).cast("int")
    totals = sliding(requests, by, {"_good": good, "_all": F.lit(1)}, window, step)
    return totals.select("eval_time", *by, ratio(F.col("_good"), F.col("_all")).alias("value"))


def topk(series: DataFrame, k: int) -> DataFrame:
    """the k greatest series at each time; ties go to the smaller labels."""
    labels = [c for c in series.columns if c not in ("eval_time", "value")]
    rank = F.row_number().over(Window.partitionBy("eval_time").orderBy(F.col("value").desc(), *labels))
    return series.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def byte_rate(
    requests: DataFrame, by: Sequence[str], window: str | int = "1 minute", step: str | int = "1 minute"
) -> DataFrame:
    """response bytes per second."""
    return _per_second(requests, by, F.col("response_size"), window, step)


# The latency bucket bounds in milliseconds.
LATENCY_BOUNDS = (10.0, 50.0, 100.0, 500.0, 1000.0)


def latency_buckets(
    requests: DataFrame,
    by: Sequence[str],
    bounds: Sequence[float] = LATENCY_BOUNDS,
    latency: str = "latency_ms",
    window: str | int = "1 minute",
    step: str | int = "1 minute",
) -> DataFrame:
    """(eval_time, by..., le, n): requests per latency bucket; the last bound is infinite."""
    le = F.lit(float("inf"))
    for bound in sorted(bounds, reverse=True):
        le = F.when(F.col(latency) <= bound, F.lit(float(bound))).otherwise(le)
    return sliding(requests.withColumn("le", le), [*by, "le"], {"n": F.lit(1)}, window, step)


def histogram_quantile(
    buckets: DataFrame, q: float, by: Sequence[str], bounds: Sequence[float] = LATENCY_BOUNDS
) -> DataFrame:
    """quantile from bucket counts, linear within a bucket.

    ``buckets`` has ``by``, ``le`` (upper bound) and ``n`` (requests in the
    bucket itself); buckets without requests may be missing, so the finite
    ``bounds`` are given.  A quantile in the infinite bucket gives the
    greatest of them.  The windows hold one row per bound, never requests.
    """
    finite = sorted(float(b) for b in bounds)
    below = F.lit(0.0)
    for bound in finite:
        # The greatest bound is tested first.
        below = F.when(F.col("le") > bound, F.lit(bound)).otherwise(below)
    counted = buckets.groupBy(*by, "le").agg(F.sum("n").alias("n"))
    series = Window.partitionBy(*by)
    through = F.sum("n").over(series.orderBy("le").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    walked = counted.withColumns({"_through": through, "_rank": F.sum("n").over(series) * F.lit(float(q))})
    inside = below + (F.col("le") - below) * ((F.col("_rank") - (F.col("_through") - F.col("n"))) / F.col("n"))
    value = F.when(F.col("le") == float("inf"), F.lit(finite[-1])).otherwise(inside)
    # The first bucket that reaches the rank.
    reached = walked.where((F.col("_through") >= F.col("_rank")) & (F.col("n") > 0))
    return reached.groupBy(*by).agg(F.min_by(value, F.col("le")).alias("value"))


def filter_method(requests: DataFrame, pattern: str) -> DataFrame:
    """requests whose whole method name matches the pattern."""
    return requests.where(F.col("rpc_method").rlike(f"^(?:{pattern})\\z"))


EXPENSIVE_METHODS = "debug_.*|trace_.*"
WATCHED_METHODS = ".*trace.*|.*debug.*|eth_getLogs"


def hold_for(
    series: DataFrame, keys: Sequence[str], step: str | int, duration: str | int, steps: int = 1024
) -> DataFrame:
    """state of a condition that holds at the rows of ``series``.

    Consecutive steps form a run; a run turns from pending to firing once it
    has lasted for ``duration``.

    A series is cut into ranges of ``steps`` steps, and runs are found within each, so neither a long series nor a condition
    without keys is one task.  Runs that reach over the ends of ranges are stitched over a row per range: the run at
    the head of a range began where the one at the tail of the range before did, and a range that is one run hands that on.
    """
    stride = seconds(step)
    span = stride * steps
    moment = F.unix_seconds("eval_time")
    first, last = F.col("_range") * span, F.col("_range") * span + span - stride
    ranged = series.withColumn("_range", F.floor(moment / F.lit(span)).cast("bigint"))
    inside = [*keys, "_range"]
    order = Window.partitionBy(*inside).orderBy("eval_time")
    runs = ranged.withColumn("_run", moment - F.row_number().over(order) * F.lit(stride))
    runs = runs.withColumn("_began", F.min(moment).over(Window.partitionBy(*inside, "_run")))

    ends = runs.groupBy(*inside).agg(
        F.max(moment == first).alias("_head"), F.max(F.when(moment == last, F.col("_began"))).alias("_tail")
    )
    line = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_range")
    before = F.lag(F.struct("_range", "_tail")).over(line)
    joined = F.col("_head") & F.coalesce((before["_range"] == F.col("_range") - 1) & before["_tail"].isNotNull(), F.lit(False))
    ends = ends.withColumn("_joined", joined)
    # Where the run at the tail began: a range that is one run takes it from the range before.
    handed_on = F.col("_joined") & (F.col("_tail") == first)
    began = F.last(F.when(~handed_on, F.col("_tail")), ignorenulls=True).over(line)
    ends = ends.withColumn("_reached", began).withColumn("_origin", F.lag("_reached").over(line)).where("_joined")
    origins = ends.select(*[F.col(c).alias(f"_of_{c}") for c in inside], "_origin")
    met = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in inside])
    since = F.when(F.col("_began") == first, F.coalesce("_origin", "_began")).otherwise(F.col("_began"))
    return (
        runs.join(origins, met, "left")
        .withColumn("active_since", F.timestamp_seconds(since))
        .withColumn("state", F.when(moment - since >= seconds(duration), "firing").otherwise("pending"))
        .select("eval_time", *keys, "value", "state", "active_since")
    )


def alert_share(
    requests: DataFrame,
    condition: Column,
    by: Sequence[str],
    threshold: float,
    window: str | int,
    step: str | int,
    hold: str | int,
) -> DataFrame:
    """Share of the requests for which ``condition`` holds, per series, above the threshold."""
    totals = sliding(requests, by, {"_met": condition.cast("int"), "_all": F.lit(1)}, window, step)
    share = totals.select("eval_time", *by, ratio(F.col("_met"), F.col("_all")).alias("value"))
    return hold_for(share.where(F.col("value") > threshold), list(by), step, hold)


def alert_server_errors(
    requests: DataFrame,
    threshold: float = 0.05,
    window: str | int = "5 minutes",
    step: str | int = "1 minute",
    hold: str | int = "5 minutes",
    by: Sequence[str] = ("route_name",),
) -> DataFrame:
    """A spike of 5xx responses: their share per series."""
    return alert_share(requests, F.col("status_code") >= 500, list(by), threshold, window, step, hold)


def alert_failing_upstreams(
    requests: DataFrame,
    threshold: float = 0.5,
    window: str | int = "5 minutes",
    step: str | int = "1 minute",
    hold: str | int = "2 minutes",
) -> DataFrame:
    """Upstream hosts of a chain that answer most requests with 5xx."""
    return alert_server_errors(requests, threshold, window, step, hold, ("chain_slug", "upstream_host"))


def alert_rejection_rate(
    requests: DataFrame,
    threshold: float = 0.1,
    window: str | int = "5 minutes",
    step: str | int = "1 minute",
    hold: str | int = "5 minutes",
) -> DataFrame:
    """share of 429 responses per consumer above the threshold."""
    return alert_share(requests, F.col("status_code") == 429, ["consumer_id"], threshold, window, step, hold)


def alert_expensive(
    requests: DataFrame,
    threshold: float = 10.0,
    window: str | int = "5 minutes",
    step: str | int = "30 seconds",
    hold: str | int = "10 minutes",
) -> DataFrame:
    """F8: rate of debug and trace calls per consumer and method."""
    keys = ["consumer_id", "rpc_method"]
    series = rate(filter_method(requests, EXPENSIVE_METHODS), keys, window, step)
    return hold_for(series.where(F.col("value") > threshold), keys, step, hold)


def alert_429_spike(
    requests: DataFrame,
    threshold: float = 50.0,
    window: str | int = "1 minute",
    step: str | int = "30 seconds",
    hold: str | int = "2 minutes",
    by: Sequence[str] = ("route_name", "consumer_id"),
) -> DataFrame:
    """rate of 429 responses per series."""
    series = rate(requests.where(F.col("status_code") == 429), list(by), window, step)
    return hold_for(series.where(F.col("value") > threshold), list(by), step, hold)


def alert_near_limit(
    requests: DataFrame,
    plans: DataFrame,
    share: float = 0.8,
    step: str | int = "1 minute",
    hold: str | int = "5 minutes",
) -> DataFrame:
    """requests per minute above a share of the plan's limit.

    ``plans`` has slug and rate_limit_per_minute.
    """
    keys = ["consumer_id", "plan_slug"]
    per_minute = sliding(requests, keys, {"value": F.lit(1)}, "1 minute", step)
    limits = plans.select(F.col("slug").alias("plan_slug"), F.col("rate_limit_per_minute").alias("_limit"))
    near = per_minute.join(limits, "plan_slug").where(F.col("value") > F.lit(share) * F.col("_limit"))
    series = near.select("eval_time", *keys, F.col("value").cast("double").alias("value"))
    return hold_for(series, keys, step, hold)


def alert_plan_violation(
    requests: DataFrame,
    window: str | int = "1 minute",
    step: str | int = "1 minute",
    hold: str | int = "1 minute",
) -> DataFrame:
    """forbidden calls on the free plan, per consumer."""
    forbidden = requests.where((F.col("status_code") == 403) & (F.col("plan_slug") == "free"))
    return hold_for(rate(forbidden, ["consumer_id"], window, step), ["consumer_id"], step, hold)


def alert_compute_units(
    requests: DataFrame,
    threshold: float = 1000.0,
    window: str | int = "5 minutes",
    step: str | int = "1 minute",
    hold: str | int = "10 minutes",
) -> DataFrame:
    """compute units per second by consumer and plan."""
    keys = ["consumer_id", "plan_slug"]
    series = _per_second(requests, keys, F.col("compute_units"), window, step)
    return hold_for(series.where(F.col("value") > threshold), keys, step, hold)


SLO = Rollup(
    name="slo",
    keys={"event_date": "to_date(event_time)", "chain_slug": "chain_slug"},
    sums={
        "request_count": "1",
        "error_count": "int(is_error = 1)",
        "rejected_count": "int(status_code = 429)",
        "available_count": "int(status_code < 500)",
    },
    values={"latency": "latency_ms"},
    quantiles={"latency": (0.95,)},
)

# The targets.
SLO_P95_MS, SLO_ERROR_PCT, SLO_REJECTED_PCT, SLO_AVAILABLE_PCT = 300.0, 1.0, 5.0, 99.9


def slo_report(requests: DataFrame) -> DataFrame:
    """service levels per chain and day.

    Availability is the share of responses below 500, our definition.
    """
    done = SLO.compute(requests)
    total = F.col("request_count")
    error_pct, rejected_pct, available_pct = (
        percent(F.col(c), total) for c in ("error_count", "rejected_count", "available_count")
    )
    p95 = F.col(f"latency_{quantile_label(0.95)}")
    return done.select(
        *SLO.keys,
        "request_count",
        p95.alias("latency_p95"),
        error_pct.alias("error_rate_pct"),
        rejected_pct.alias("rejected_pct"),
        available_pct.alias("availability_pct"),
        (p95 < SLO_P95_MS).alias("latency_ok"),
        (error_pct < SLO_ERROR_PCT).alias("errors_ok"),
        (rejected_pct < SLO_REJECTED_PCT).alias("rejections_ok"),
        (available_pct >= SLO_AVAILABLE_PCT).alias("availability_ok"),
    )
