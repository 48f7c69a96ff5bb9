"""Runs of a condition that are cut at the ends of time ranges and stitched again."""

from __future__ import annotations

import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyforge.operators.series import hold_for

START = datetime(2024, 1, 1, tzinfo=UTC).replace(tzinfo=None)


def slow(rows, hold):
    """Runs step by step."""
    found, since, before = [], {}, {}
    for moment, key, _ in sorted(rows, key=lambda r: (str(r[1]), r[0])):
        if before.get(key) != moment - timedelta(minutes=1):
            since[key] = moment
        before[key] = moment
        found.append((moment, key, "firing" if moment - since[key] >= timedelta(minutes=hold) else "pending", since[key]))
    return sorted(found, key=str)


@pytest.mark.parametrize("steps", [1, 2, 3, 7, 50, 1024])
@pytest.mark.parametrize("keyed", [True, False])
def test_hold_against_a_loop(spark, steps, keyed):
    draw = random.Random(steps)
    keys = ["a", "b", None] if keyed else [None]
    rows = []
    for key in keys:
        gaps = {draw.randrange(400) for _ in range(12)} | ({m for m in range(100, 180)} if key == "b" else set())
        rows += [(START + timedelta(minutes=m), key, 1.0) for m in range(400) if m not in gaps]
    series = spark.createDataFrame(rows, "eval_time timestamp, key string, value double").repartition(5)
    got = hold_for(series if keyed else series.drop("key"), ["key"] if keyed else [], "1 minute", "9 minutes", steps)
    rows_of = [(r.eval_time, r.key if keyed else None, r.state, r.active_since) for r in got.collect()]
    assert sorted(rows_of, key=str) == slow(rows, 9)


def test_one_series_is_spread_over_tasks(spark):
    """A condition without keys that always holds: the largest task has no more than twice the rows of the median."""
    series = spark.range(40_000).select(F.timestamp_seconds(F.col("id") * 60).alias("eval_time"), F.lit(1.0).alias("value"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    held = hold_for(series, [], "1 minute", "1 hour", steps=64)
    sizes = sorted(r["count"] for r in held.groupBy(F.spark_partition_id()).count().collect())
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 40_000 and len(sizes) >= 8 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    assert held.where("state = 'pending'").count() == 60 and held.select("active_since").distinct().count() == 1
