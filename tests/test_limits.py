"""Limiters against plain loops, with a key that holds most of the log."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from tallyforge.operators import buckets, limits
from tallyforge.sources.requests import read_requests, write_table
from tallyforge.streaming.token_bucket import start_token_bucket

START = datetime(2024, 1, 1)


def skewed_rows(n=3000, keys=6, span=7200, seed=1):
    """A third of the requests are of one consumer; many share a second."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        consumer = "hot" if draw.random() < 0.34 else f"c{draw.randrange(keys)}"
        at = START + timedelta(milliseconds=draw.randrange(span) * 1000 + draw.randrange(0, 1000, 250))
        rows.append(
            {
                "event_time": at.replace(microsecond=0),
                "event_time_ms": at,
                "consumer_id": consumer,
                "request_id": f"r{i:05d}",
                "compute_units": draw.choice([1, 2, 10]),
            }
        )
    return rows


@pytest.mark.parametrize("unit,seconds,limit", [("minute", 60, 3), ("hour", 3600, 40), ("day", 86400, 100), ("second", 1, 1)])
def test_fixed_window_against_a_loop(make_log, unit, seconds, limit):
    rows = skewed_rows()
    used, expected = defaultdict(int), []
    for row in sorted(rows, key=lambda r: (r["event_time_ms"], r["request_id"])):
        bucket = (row["consumer_id"], int((row["event_time"] - START).total_seconds()) // seconds)
        used[bucket] += 1
        if used[bucket] > limit:
            expected.append((row["consumer_id"], row["event_time_ms"], used[bucket]))
    got = limits.fixed_window_limit(make_log(rows), "consumer_id", limit, unit)
    assert sorted((r.consumer_id, r.event_time_ms, r.current_count) for r in got.collect()) == sorted(expected)
    assert expected


def test_limit_is_per_request_plan(make_log, spark):
    # A plan change within the window: each request is held against its own limit.
    rows = [{"event_time": START, "event_time_ms": START + timedelta(milliseconds=i), "plan_slug": "free" if i < 3 else "pro"} for i in range(6)]
    plans = spark.createDataFrame([("free", 1), ("pro", 5)], "plan_slug string, limit_value int")
    got = limits.fixed_window_limit(make_log(rows), "consumer_id", plans, "minute").orderBy("current_count").collect()
    assert [(r.plan_slug, r.current_count) for r in got] == [("free", 2), ("free", 3), ("pro", 6)]


def literal_bucket(rows, capacity, refill, window):
    """One request at a time, as the limiter sees them."""
    state, passed = {}, defaultdict(lambda: [0, 0])
    for row in sorted(rows, key=lambda r: (r["event_time_ms"], r["request_id"])):
        key, now = row["consumer_id"], int((row["event_time"] - START).total_seconds())
        tokens, last = state.get(key, (capacity, now))
        gained = (now - last) // window * refill
        if gained > 0:
            tokens, last = min(tokens + gained, capacity), now
        decision = passed[key, row["event_time"]]
        decision[0] += 1
        if tokens > 0:
            tokens -= 1
            decision[1] += 1
        state[key] = (tokens, last)
    return sorted((k, t, n, ok) for (k, t), (n, ok) in passed.items())


@pytest.mark.parametrize("capacity,refill,window", [(1, 1, 60), (5, 5, 60), (20, 20, 600), (10, 3, 60), (50, 1, 300), (3, 3, 7200)])
def test_token_bucket_against_a_loop(make_log, capacity, refill, window):
    rows = skewed_rows(seed=capacity)
    wanted = literal_bucket(rows, capacity, refill, window)
    for piece in (None, window, 7 * window // 3 + 1):  # short pieces: most buckets come from the piece before
        got = limits.token_bucket(make_log(rows), "consumer_id", capacity, refill, window, piece)
        assert sorted((r.consumer_id, r.event_time, r.requests, r.allowed) for r in got.collect()) == wanted


def test_token_bucket_without_refill(make_log):
    rows = skewed_rows(n=400)
    for piece in (None, 600):
        got = limits.token_bucket(make_log(rows), "consumer_id", 20, 0, 60, piece)
        assert sorted((r.consumer_id, r.event_time, r.requests, r.allowed) for r in got.collect()) == literal_bucket(rows, 20, 0, 60)


def test_maps_of_long_windows_are_small():
    out = buckets.exit_of(buckets.Rule(50, 1, 86400), np.array([10, 500, 90000]), np.array([1, 2, 3]), False, 0)
    assert out.by_age.shape[1] <= 60


@pytest.mark.parametrize("capacity,gain,window", [(1, 1, 5), (4, 4, 7), (9, 2, 5), (30, 7, 11), (3, 5, 4)])
def test_maps_of_pieces_compose_to_the_walk(capacity, gain, window):
    """Whatever bucket a piece begins with, its map gives the bucket that a request-by-request walk leaves."""
    rule = buckets.Rule(capacity, gain, window)
    draw = random.Random(capacity)
    for _ in range(40):
        begin = 1000
        times = sorted(draw.sample(range(begin, begin + 60), draw.randrange(1, 25)))
        wanted = [draw.randrange(1, 6) for _ in times]
        out = buckets.exit_of(rule, np.array(times), np.array(wanted), False, begin)
        for age in range(1, rule.reach + 1):
            for tokens in range(capacity + 1):
                bucket = limits.Bucket(tokens, begin - age)
                for now, count in zip(times, wanted, strict=True):
                    bucket.take(now, count, capacity, gain, window)
                if out.refilled is not None:
                    found = out.refilled, out.tokens
                else:
                    _, last, shift, low, high = out.by_age[:, np.searchsorted(out.by_age[0], age, side="right") - 1]
                    found = begin - age if last < 0 else last, min(max(tokens + shift, low), high)
                assert found == (bucket.refilled, bucket.tokens)


def test_a_busy_key_is_spread_over_tasks(make_log, spark):
    """One key that is never idle: its seconds go to as many tasks as it has pieces."""
    times = [START + timedelta(seconds=7 * i) for i in range(4000)]
    rows = [{"event_time": t, "event_time_ms": t, "consumer_id": "hot", "request_id": f"r{i:05d}"} for i, t in enumerate(times)]
    walked = limits.token_bucket(make_log(rows), "consumer_id", 3, 3, 60, piece=600)
    assert "exchange hashpartitioning(key" in plan_text(walked).lower() and "piece" in plan_text(walked)
    assert sorted((r.consumer_id, r.event_time, r.requests, r.allowed) for r in walked.collect()) == literal_bucket(rows, 3, 3, 60)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sizes = [r[0] for r in walked.groupBy(F.spark_partition_id()).agg(F.count("*")).select("count(1)").collect()]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) >= 6 and max(sizes) <= 4000 * 0.4


def test_rejected_requests_are_the_last_of_their_second(make_log):
    rows = [{"event_time": START, "event_time_ms": START + timedelta(milliseconds=9 - i), "request_id": f"r{i}"} for i in range(5)]
    log = make_log(rows)
    decisions = limits.token_bucket(log, "consumer_id", 2)
    rejected = limits.token_bucket_rejections(log, decisions, "consumer_id")
    assert sorted(r.request_id for r in rejected.collect()) == ["r0", "r1", "r2"]


@pytest.mark.parametrize("capacity,refill", [(4, 4), (8, 2)])
def test_token_bucket_stream_equals_batch(spark, make_log, tmp_path, capacity, refill):
    rows = skewed_rows(n=1500)
    source, out = str(tmp_path / "log"), str(tmp_path / "out")
    # Three deliveries in time order, cut where one second is split over two.
    rows.sort(key=lambda r: (r["event_time_ms"], r["request_id"]))
    for i in range(3):
        write_table(make_log(rows[i * 500 : (i + 1) * 500]).coalesce(1), source, "requests", mode="append")
        stream = read_requests(spark, source, stream=True)
        start_token_bucket(
            stream, "consumer_id", capacity, out, str(tmp_path / "state"), refill, 60, available_now=True
        ).awaitTermination()
    streamed = spark.read.parquet(out).groupBy("consumer_id", "event_time").agg(F.sum("requests"), F.sum("allowed"))
    assert sorted(tuple(r) for r in streamed.collect()) == literal_bucket(rows, capacity, refill, 60)


def test_settled_token_bucket_stream_sees_seconds_only(spark, make_log, tmp_path):
    """A key with twenty requests a second, delivered out of order: a row per second reaches the processor, and one comes out."""
    draw = random.Random(5)
    rows = [dict(r, consumer_id="hot" if i % 2 else r["consumer_id"]) for i, r in enumerate(skewed_rows(n=1600, span=400))]
    last = START + timedelta(seconds=2000)
    rows.append({"event_time": last, "event_time_ms": last, "consumer_id": "end", "request_id": "end"})
    source, out = str(tmp_path / "log"), str(tmp_path / "out")
    parts = [rows[i::2] for i in range(2)]  # the seconds of one delivery come again in the next
    draw.shuffle(parts[0])
    for part in parts:
        write_table(make_log(part).coalesce(1), source, "requests", mode="append")
    stream = read_requests(spark, source, stream=True, files_per_batch=1)
    query = start_token_bucket(
        stream, "consumer_id", 6, out, str(tmp_path / "state"), 6, 60, watermark="10 minutes", available_now=True, partitions=2, settled=True
    )
    query.awaitTermination()
    streamed = spark.read.parquet(out)
    wanted = [r for r in literal_bucket(rows, 6, 6, 60) if r[0] != "end"]
    assert sorted(tuple(r) for r in streamed.select("consumer_id", "event_time", "requests", "allowed").collect()) == wanted
    emitted = sum(p["sink"]["numOutputRows"] for p in query.recentProgress if p["sink"]["numOutputRows"] > 0)
    assert emitted in (0, len(wanted)) and len(wanted) < 0.8 * len(rows)


def test_quota_counts_units(make_log, spark):
    rows = skewed_rows(n=600)
    catalog = {
        "plans": spark.createDataFrame([("p", "free")], "id string, slug string"),
        "chains": spark.createDataFrame([("e", "eth-mainnet")], "id string, slug string"),
        "plan_chain_limits": spark.createDataFrame([("p", "e", 200)], "plan_id string, chain_id string, compute_units_per_day int"),
    }
    used, expected = defaultdict(int), []
    for row in sorted(rows, key=lambda r: (r["event_time_ms"], r["request_id"])):
        used[row["consumer_id"]] += row["compute_units"]
        if used[row["consumer_id"]] > 200:
            expected.append((row["consumer_id"], used[row["consumer_id"]]))
    got = limits.compute_quota(make_log(rows), catalog)
    assert sorted((r.consumer_id, r.current_count) for r in got.collect()) == sorted(expected)
