"""Rate limits, quotas and token buckets replayed over the log."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.marks import marks_of, only_marked
from tallyforge.functions.measures import literal_rows
from tallyforge.operators.buckets import MOST_SECONDS, PIECE, Rule, decisions, entries, exits
from tallyforge.operators.series import seconds

EVENT_COLUMNS = [
    "event_time",
    "event_time_ms",
    "organization_id",
    "consumer_id",
    "plan_slug",
    "limit_type",
    "limit_value",
    "current_count",
]
CONSTANT_LIMIT = 10000


def _kept(df: DataFrame, staging: str | None, label: str) -> DataFrame:
    """``df``, by way of a table in the folder ``staging`` if there is one."""
    if staging is None:
        return df
    path = f"{staging.rstrip('/')}/{label}-{uuid.uuid4().hex}"  # of this call alone
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_PASSED = "_used > _least"


def _totals(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What was used per key, and the least limit that held."""
    return rows.groupBy(*keys).agg(F.sum("_amount").alias("_used"), F.min("limit_value").alias("_least"))


def _busy(requests: DataFrame, days: DataFrame, consumer: Sequence[str], staging: str | None) -> DataFrame:
    """Requests of consumers on days whose total passes a limit, by a bitmap of fixed size that drops the others at the scan.

    A limit of any unit can only be passed on such a day.  ``days`` has the totals of a consumer's day, a few rows per consumer.
    """
    keys = [*consumer, "_day"]
    marks = _kept(marks_of(days.where(_PASSED), keys), staging, "days")
    return only_marked(requests.withColumn("_day", F.date_trunc("day", "event_time")), keys, marks).drop("_day")


def _over_limit(limited: DataFrame, scope: Sequence[str], amount: Column, staging: str | None) -> DataFrame:
    """Rows at which the running total of ``amount`` passes ``limit_value``.

    ``limited`` has ``limit_type`` (second, minute, hour or day) and
    ``limit_value``.  Totals restart with each calendar unit and run in order
    of event_time_ms, request_id.

    Counts are taken from coarse to fine.  Callers keep busy days only (see ``_busy``); the units of those are summed, and the
    units that pass are a bitmap of fixed size, which drops all other requests at the scan.  Only what stays is summed by
    second.  A window over those sums, at most 86 400 per scope and unit, tells in which seconds a limit is
    passed.  Requests of other seconds drop out at the scan once more, and the rest are ranked, second by second, so
    no task sorts all requests of a busy consumer.  In a healthy log the raw requests are never shuffled.

    The log is read once per level.  Each level hangs on those before it; with ``staging``, a
    fresh folder on shared storage, they are written there and not computed again.
    """
    keys = [*scope, "limit_type"]
    bare = limited.withColumns(
        {
            "_second": F.date_trunc("second", "event_time"),
            "_unit": F.expr("date_trunc(limit_type, event_time)"),
            "_amount": amount.cast("bigint"),
        }
    )

    def of(level: str, found: DataFrame) -> DataFrame:
        marks = marks_of(found, [*keys, level])
        return only_marked(bare, [*keys, level], _kept(marks, staging, level.strip("_")))

    rows = of("_unit", _totals(bare, [*keys, "_unit"]).where(_PASSED))
    earlier = Window.partitionBy(*keys, "_unit").orderBy("_second").rowsBetween(Window.unboundedPreceding, -1)
    passed = (
        _totals(rows, [*keys, "_unit", "_second"])
        .withColumn("_before", F.coalesce(F.sum("_used").over(earlier), F.lit(0)))
        .where(F.col("_before") + F.col("_used") > F.col("_least"))
        # The join infers these conditions; said here, they also hold for the bitmap, and Spark computes both from one shuffle.
        .where(" AND ".join(f"{c} IS NOT NULL" for c in (*keys, "_second")))
        .select(*keys, "_second", "_before")
    )
    passed = _kept(passed, staging, "passed")
    inside = (
        Window.partitionBy(*keys, "_second")
        .orderBy("event_time_ms", "request_id")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        of("_second", passed)
        .join(passed, [*keys, "_second"])
        .withColumn("current_count", F.col("_before") + F.sum("_amount").over(inside))
        .where(F.col("current_count") > F.col("limit_value"))
    )


def fixed_window_limit(
    requests: DataFrame,
    key: str | Sequence[str] = "consumer_id",
    limit: int | DataFrame = CONSTANT_LIMIT,
    window: str = "minute",
    staging: str | None = None,
) -> DataFrame:
    """G1: requests a fixed-window limiter would reject, as B11 rows.

    ``limit`` is a constant, or a table of plan_slug and limit_value.
    ``staging`` is a fresh folder on shared storage, see ``_over_limit``.
    """
    scope = [key] if isinstance(key, str) else list(key)
    limited = requests.withColumn("limit_type", F.lit(window))
    if isinstance(limit, DataFrame):
        limited = limited.join(literal_rows(limit.select("plan_slug", F.col("limit_value").cast("bigint"))), "plan_slug")
    else:
        limited = limited.withColumn("limit_value", F.lit(limit).cast("bigint"))
    if window != "day":
        day = {"_day": F.date_trunc("day", "event_time"), "_amount": F.lit(1)}
        limited = _busy(limited, _totals(limited.withColumns(day), [*scope, "_day"]), scope, staging)
    return _over_limit(limited, scope, F.lit(1), staging).select(*EVENT_COLUMNS)


_PLAN_LIMITS = {
    "second": None,
    "minute": "rate_limit_per_minute",
    "hour": "rate_limit_per_hour",
    "day": "rate_limit_per_day",
}


def effective_limits(catalog: dict[str, DataFrame], column_prefix: str, plan_columns: dict[str, str | None]) -> DataFrame:
    """(plan_slug, chain_slug, limit_type, limit_value): one row per plan with
    chain_slug = '' and one per chain that has a limit of its own."""
    plans, overrides = catalog["plans"], catalog["plan_chain_limits"]
    chains = catalog["chains"].select(F.col("id").alias("chain_id"), F.col("slug").alias("chain_slug"))
    slugs = plans.select(F.col("id").alias("plan_id"), F.col("slug").alias("plan_slug"))
    own = overrides.join(slugs, "plan_id").join(chains, "chain_id")
    parts = []
    for unit, plan_column in plan_columns.items():
        if plan_column is not None and plan_column in plans.columns:
            parts.append(
                plans.select(
                    F.col("slug").alias("plan_slug"),
                    F.lit("").alias("chain_slug"),
                    F.lit(unit).alias("limit_type"),
                    F.col(plan_column).cast("bigint").alias("limit_value"),
                )
            )
        override = f"{column_prefix}{unit}"
        if override in overrides.columns:
            parts.append(
                own.select(
                    "plan_slug", "chain_slug", F.lit(unit).alias("limit_type"), F.col(override).cast("bigint").alias("limit_value")
                )
            )
    return reduce(DataFrame.unionByName, parts).where(F.col("limit_value").isNotNull())


def _beyond_plan(requests: DataFrame, limits: DataFrame, amount: Column, staging: str | None) -> DataFrame:
    """Requests beyond limits by plan and chain; a chain without a limit of its own falls under the plan's.

    Days are counted per consumer, plan and chain before the limits unfold them; requests unfold only on busy days.
    """
    limits = literal_rows(limits)
    # One row per plan and unit with its limits: (plan limit, {chain: own limit}).
    per_unit = limits.groupBy("plan_slug", "limit_type").agg(
        F.max(F.when(F.col("chain_slug") == "", F.col("limit_value"))).alias("plan_limit"),
        F.map_from_entries(
            F.collect_list(F.when(F.col("chain_slug") != "", F.struct("chain_slug", "limit_value")))
        ).alias("own"),
    )
    own = F.try_element_at("own", F.col("chain_slug"))

    def unfolded(rows: DataFrame) -> DataFrame:
        held = rows.join(per_unit, "plan_slug").withColumns(
            {
                "limit_value": F.coalesce(own, "plan_limit"),
                "limit_scope": F.when(own.isNotNull(), F.col("chain_slug")).otherwise(F.lit("")),
            }
        )
        return held.where(F.col("limit_value").isNotNull()).drop("plan_limit", "own")

    held = limits.groupBy("plan_slug").agg(F.max(F.col("chain_slug") == "").alias("_any"), F.collect_set("chain_slug").alias("_own"))
    limited = requests.join(held, "plan_slug").where("_any OR array_contains(_own, chain_slug)").select(*requests.columns)
    cells = limited.groupBy("consumer_id", "plan_slug", "chain_slug", F.date_trunc("day", "event_time").alias("_day")).agg(
        F.sum(amount.cast("bigint")).alias("_amount")
    )
    days = _totals(unfolded(cells), ["consumer_id", "limit_scope", "limit_type", "_day"])
    busy = _busy(limited, days, ["consumer_id"], staging)
    return _over_limit(unfolded(busy), ["consumer_id", "limit_scope"], amount, staging).select(*EVENT_COLUMNS)


def plan_limit_events(
    requests: DataFrame, catalog: dict[str, DataFrame], staging: str | None = None
) -> DataFrame:
    """Requests beyond the limits of their plan, as B11 rows.

    A chain with a limit of its own is counted by itself against that limit;
    a consumer's other chains are counted together against the plan's limit.
    """
    return _beyond_plan(requests, effective_limits(catalog, "rate_limit_per_", _PLAN_LIMITS), F.lit(1), staging)


def compute_quota(
    requests: DataFrame, catalog: dict[str, DataFrame], staging: str | None = None
) -> DataFrame:
    """Requests beyond the compute-unit quota of their plan and chain.

    ``current_count`` is in compute units.
    """
    quotas = effective_limits(catalog, "compute_units_per_", {"second": None, "day": None})
    return _beyond_plan(requests, quotas, F.col("compute_units"), staging)


DECISION_COLUMNS = ["event_time", "requests", "allowed", "rejected"]


class Bucket:
    """A token bucket on a clock of whole seconds.

    Elapsed time is divided by the window before it is multiplied by the
    refill, so nothing is refilled until a whole window has passed, and the
    refill moment becomes the time of the request, not a multiple of the
    window.
    """

    __slots__ = ("tokens", "refilled")

    def __init__(self, tokens: int, refilled: int) -> None:
        self.tokens, self.refilled = tokens, refilled

    def take(self, now: int, wanted: int, capacity: int, refill: int, window: int) -> int:
        """Let ``wanted`` requests of one second try; returns how many pass."""
        windows = (now - self.refilled) // window
        if windows * refill > 0:
            self.tokens = min(self.tokens + windows * refill, capacity)
            self.refilled = now
        passed = min(self.tokens, wanted)
        self.tokens -= passed
        return passed


def token_bucket(
    requests: DataFrame,
    key: str,
    capacity: int,
    refill: int | None = None,
    window: str | int = "1 minute",
    piece: int | None = None,
) -> DataFrame:
    """Per key and second, how many requests a token bucket lets pass.

    The time line of a key is cut into pieces of ``piece`` seconds (a day; where a bucket takes long to fill up, sixteen times
    that, but no more than MOST_SECONDS unless it takes longer), and the pieces are spread over tasks, so a busy key is no hot task.  Most pieces begin with a full bucket, as
    the key was idle long enough before.  Where not, what the piece before makes of a bucket is a small map (see
    ``buckets``); the maps of a key are composed, a row per piece, and every piece is then walked by itself, refill by refill.
    """
    gain = capacity if refill is None else refill
    rule = Rule(capacity, gain, seconds(window))
    span = max(PIECE, rule.reach, min(16 * rule.reach, MOST_SECONDS)) if piece is None else piece
    second = F.unix_seconds("event_time").alias("second")
    counted = requests.groupBy(F.col(key).cast("string").alias("key"), second).agg(F.count(F.lit(1)).alias("requests"))
    at = ["key", "piece"]
    rows = counted.withColumn("piece", F.expr(f"second DIV {span}")).repartition(*at)

    # Where the key was busy until less than ``full`` seconds before a piece, the bucket comes from there.
    line = Window.partitionBy("key").orderBy("piece")
    ends = rows.groupBy(*at).agg(F.min("second").alias("_first"), F.max("second").alias("_last"))
    idle = F.col("_first") - F.lag("_last").over(line)
    ends = ends.withColumn("fresh", F.coalesce(idle >= rule.full, F.lit(True)))
    ends = ends.withColumn("_leads", ~F.coalesce(F.lead("fresh").over(line), F.lit(True)))
    linked = ends.where("_leads OR NOT fresh").select(F.col("key").alias("_key"), F.col("piece").alias("_piece"), "fresh")
    met = lambda df, other: df["key"].eqNullSafe(other["_key"]) & (df["piece"] == other["_piece"])
    cut = rows.join(linked, met(rows, linked)).sortWithinPartitions(*at, "second").select(*at, "second", "requests", "fresh")
    lists = ", ".join(f"{c} array<bigint>" for c in ("age", "last", "shift", "low", "high"))
    maps = cut.mapInArrow(lambda b: exits(rule, span, b), f"key string, piece bigint, refilled bigint, tokens bigint, {lists}")
    chained = maps.join(linked, met(maps, linked)).drop("_key", "_piece").repartition("key").sortWithinPartitions(*at)
    begun = chained.mapInArrow(lambda b: entries(span, b), "_key string, _piece bigint, refilled bigint, tokens bigint")

    ready = rows.join(begun, met(rows, begun), "left").sortWithinPartitions(*at, "second")
    walked = ready.select(*at, "second", "requests", "refilled", "tokens").mapInArrow(
        lambda b: decisions(rule, b), "key string, second bigint, requests bigint, allowed bigint"
    )
    return walked.select(
        F.col("key").alias(key),
        F.timestamp_seconds("second").alias("event_time"),
        "requests",
        "allowed",
        (F.col("requests") - F.col("allowed")).alias("rejected"),
    )


def token_bucket_rejections(
    requests: DataFrame, decisions: DataFrame, key: str, staging: str | None = None
) -> DataFrame:
    """The rejected requests themselves: the last ones of a second that was cut.

    Requests of other seconds drop out at the scan, by a bitmap.  ``staging`` holds the cut seconds, see ``_over_limit``.
    """
    cut = decisions.where(F.col("rejected") > 0).select(key, F.col("event_time").alias("_second"), "allowed")
    cut = _kept(cut, staging, "cut")
    rows = requests.withColumn("_second", F.date_trunc("second", "event_time"))
    order = Window.partitionBy(key, "_second").orderBy("event_time_ms", "request_id")
    return (
        only_marked(rows, [key, "_second"], marks_of(cut, [key, "_second"]))
        .join(cut, [key, "_second"])
        .withColumn("_place", F.row_number().over(order))
        .where(F.col("_place") > F.col("allowed"))
        .select(*requests.columns)
    )
