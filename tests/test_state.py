"""Partial rows: any batching of the log must give the rollup of the whole log."""

from __future__ import annotations

import time
from pathlib import Path
from types import SimpleNamespace

import pytest
from conftest import as_set, plan_text
from pyspark.sql import functions as F

from tallyforge.operators import rollups, usage
from tallyforge.sources.catalog import seed_method_units
from tallyforge.sources.requests import read_requests, write_table
from tallyforge.streaming import rollups as stream_rollups
from tallyforge.streaming import windows
from tallyforge.workload.fixtures import load

BATCH = {
    "latency_metrics": rollups.latency_metrics,
    "chain_health": rollups.chain_health,
    "chain_method_usage": rollups.chain_method_usage,
    "chain_org_usage": rollups.chain_org_usage,
    "chain_popularity": rollups.chain_popularity,
    "usage_hourly": usage.usage_hourly,
    "usage_daily": usage.usage_daily,
}


@pytest.fixture(scope="module")
def log(spark, sf_dir):
    # Coarser routes and times, so that groups hold several requests each.
    (requests,) = load(spark, sf_dir, "requests")
    coarse = requests.where("event_date < DATE '2024-01-07'").withColumns(
        {
            "event_time": F.date_trunc("hour", "event_time"),
            "route_name": F.lit("one"),
            "upstream_host": F.lit("one"),
        }
    )
    return coarse.cache()


def parts(log, n):
    spread = log.withColumn("_p", F.pmod(F.xxhash64("request_id"), F.lit(n)))
    return [spread.where(F.col("_p") == i).drop("_p") for i in range(n)]


@pytest.mark.parametrize("name", BATCH)
def test_state_finishes_to_the_batch_table(log, name):
    rollup, shape = rollups.ROLLUPS[name]
    assert as_set(shape(rollup.finish(rollup.state(log)))) == as_set(BATCH[name](log))


@pytest.mark.parametrize("batches", [1, 3, 7])
@pytest.mark.parametrize("name", ["latency_metrics", "chain_method_usage", "chain_popularity"])
def test_batches_merge_to_the_whole(spark, log, name, batches, tmp_path):
    rollup, _ = rollups.ROLLUPS[name]
    out = str(tmp_path / name)
    spark.createDataFrame([], "day date, upto bigint").write.parquet(f"{out}/compactions")
    for i, part in enumerate(parts(log, batches)):
        stream_rollups.write_batch(part, rollup, out, i)
    # A replayed batch counts once.
    stream_rollups.write_batch(parts(log, batches)[0], rollup, out, 0)
    assert as_set(stream_rollups.read_rollup_table(spark, out, name)) == as_set(BATCH[name](log))


def test_stream_compaction_and_late_rows(spark, log, tmp_path):
    name, source, out = "chain_health", str(tmp_path / "log"), str(tmp_path / "out")
    first, second, third = parts(log, 3)
    rollup, _ = rollups.ROLLUPS[name]

    def drain():
        stream = read_requests(spark, source, stream=True, files_per_batch=1)
        query = stream_rollups.start_rollup(stream, name, out, str(tmp_path / "state"), available_now=True)
        query.awaitTermination()

    def last_batch():
        return spark.read.parquet(f"{out}/batches").agg(F.max("batch_id")).first()[0]

    write_table(first, source, "requests", mode="append")
    write_table(second, source, "requests", mode="append")
    drain()
    whole = as_set(rollups.chain_health(first.unionByName(second)))
    assert as_set(stream_rollups.read_rollup_table(spark, out, name)) == whole

    stream_rollups.compact(spark, out, name, last_batch())
    assert as_set(stream_rollups.read_rollup_table(spark, out, name)) == whole
    # Every batch folder may now go, and the result stays.
    folders = [r.path for r in stream_rollups.superseded(spark, out).collect()]
    assert len(folders) == spark.read.parquet(f"{out}/batches").select("batch_id", "day").distinct().count()
    assert all(Path(f).is_dir() for f in folders)
    # Compacting again finds nothing to do.
    stream_rollups.compact(spark, out, name, last_batch())
    assert spark.read.parquet(f"{out}/compactions").groupBy("day").count().where("count > 1").isEmpty()

    # Rows of long-closed days, delivered after the compaction.
    write_table(third, source, "requests", mode="append")
    drain()
    whole = as_set(rollups.chain_health(log))
    assert as_set(stream_rollups.read_rollup_table(spark, out, name)) == whole
    one_day = stream_rollups.read_rollup_table(spark, out, name, days=("2024-01-03", "2024-01-03"))
    assert as_set(one_day) == as_set(rollups.chain_health(log.where("event_date = DATE '2024-01-03'")))
    # An interrupted compaction has written rows but no log entry: it is not read.
    day = spark.read.parquet(f"{out}/batches").agg(F.min("day")).first()[0]
    some = spark.read.parquet(f"{out}/batches").where(F.col("day") == day).drop("batch_id")
    some.write.partitionBy("day").parquet(f"{out}/compacted/upto=999")
    assert as_set(stream_rollups.read_rollup_table(spark, out, name)) == whole
    stream_rollups.compact(spark, out, name, last_batch(), day=str(day))
    stream_rollups.compact(spark, out, name, last_batch())
    assert as_set(stream_rollups.read_rollup_table(spark, out, name)) == whole
    # All batches are compacted now; what they leave behind can go.
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    filters = plan_text(stream_rollups.read_rollup(spark, out, name)).split("PartitionFilters")[1].split("PushedFilters")[0]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "batch_id#" in filters and f"> {last_batch()}" in filters
    assert stream_rollups.clean_up(spark, out) > 0
    assert spark.read.parquet(f"{out}/compactions").count() > 0
    assert as_set(stream_rollups.read_rollup_table(spark, out, name)) == whole
    assert stream_rollups.superseded(spark, out).isEmpty()


def test_a_rollup_that_has_not_started_is_empty(spark, tmp_path):
    assert stream_rollups.read_rollup_table(spark, str(tmp_path / "none"), "chain_health").count() == 0
    assert stream_rollups.superseded(spark, str(tmp_path / "none")).isEmpty()


def test_daily_from_hourly_equals_daily_from_log(log):
    daily = usage.usage_daily_state(usage.usage_hourly_state(log))
    direct = usage.usage_daily_state_from_log(log)
    assert as_set(daily) == as_set(direct)


def test_coarser_grain_from_any_state(log):
    keys = ["organization_id"]
    from_hours = usage.finalize(usage.usage_hourly_state(log), keys, upstream=True)
    from_days = usage.finalize(usage.usage_daily_state_from_log(log), keys, upstream=True)
    assert as_set(from_hours) == as_set(from_days)


def test_sketches_are_close(log):
    exact = {tuple(r[:3]): r for r in rollups.chain_method_usage(log).collect()}
    for row in rollups.chain_method_usage(log, approx=True).collect():
        near = exact[tuple(row[:3])]
        assert row.request_count == near.request_count
        assert abs(row.unique_consumers - near.unique_consumers) <= max(1, 0.05 * near.unique_consumers)
    keys = ["organization_id"]
    sketched = usage.finalize(usage.usage_daily_state(usage.usage_hourly_state(log, approx=True)), keys)
    plain = {r.organization_id: r for r in usage.finalize(usage.usage_daily_state_from_log(log), keys).collect()}
    for row in sketched.collect():
        near = plain[row.organization_id]
        assert row.latency_avg == pytest.approx(near.latency_avg)
        assert row.latency_p50 == pytest.approx(near.latency_p50, rel=0.2, abs=30)


def test_windowed_stream_drops_and_counts_late_rows(spark, make_log, tmp_path):
    from datetime import datetime

    source = str(tmp_path / "log")
    on_time = [{"event_time": datetime(2024, 1, 1, 10, m), "latency_ms": m} for m in range(0, 60, 5)]
    write_table(make_log(on_time), source, "requests", mode="append")
    kwargs = {"available_now": True}
    stream = lambda: read_requests(spark, source, stream=True)
    drops = str(tmp_path / "drops")
    assert windows.late_rows(spark, drops).count() == 0
    listener = windows.log_drops(spark, drops)
    first = windows.start_windowed(stream(), "chain_health", str(tmp_path / "out"), str(tmp_path / "state"), **kwargs)
    first.awaitTermination()
    late = [{"event_time": datetime(2024, 1, 1, 9, 0)}, {"event_time": datetime(2024, 1, 1, 12, 0), "request_id": "x"}]
    write_table(make_log(late), source, "requests", mode="append")
    second = windows.start_windowed(stream(), "chain_health", str(tmp_path / "out"), str(tmp_path / "state"), **kwargs)
    second.awaitTermination()
    deadline = time.time() + 30  # progress reaches listeners a little later
    while windows.late_rows(spark, drops).isEmpty() and time.time() < deadline:
        time.sleep(0.5)
    spark.streams.removeListener(listener)
    assert [(r.query_id, r.dropped) for r in windows.late_rows(spark, drops).collect()] == [(str(second.id), 1)]
    minutes = [r.minute for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert datetime(2024, 1, 1, 9, 0) not in minutes
    assert len(minutes) == len(on_time)


def test_drops_are_counted_beyond_the_progress_a_query_keeps(spark, tmp_path):
    """150 triggers, one of them run twice: each counts once, as it counted last."""
    log = windows.DropLog(spark, str(tmp_path / "drops"))

    def trigger(batch, dropped, at=0):
        operators = [SimpleNamespace(numRowsDroppedByWatermark=dropped), SimpleNamespace(numRowsDroppedByWatermark=0)]
        progress = SimpleNamespace(id="q", runId="r", batchId=batch, timestamp=f"2024-01-01T00:00:{at:02d}Z", stateOperators=operators)
        log.onQueryProgress(SimpleNamespace(progress=progress))

    for batch in range(150):
        trigger(batch, 3)
    trigger(149, 5, at=1)
    trigger(150, 0)
    assert [tuple(r) for r in windows.late_rows(spark, str(tmp_path / "drops")).collect()] == [("q", 150, 149 * 3 + 5)]


@pytest.mark.parametrize("name", ["chain_popularity", "chain_method_usage"])
def test_windowed_stream_counts_members_exactly(spark, log, tmp_path, name):
    source, out = str(tmp_path / "log"), str(tmp_path / "out")
    for part in range(3):  # three deliveries in time order
        days = log.where(F.expr(f"dayofmonth(event_date) IN ({2 * part + 1}, {2 * part + 2})"))
        write_table(days, source, "requests", mode="append")
        stream = read_requests(spark, source, stream=True)
        windows.start_windowed(stream, name, out, str(tmp_path / "state"), available_now=True, partitions=2).awaitTermination()
    time_key = next(iter(rollups.ROLLUPS[name][0].keys))
    width = "1 hour" if time_key == "hour" else "1 day"
    closed = log.agg(F.max("event_time") - F.expr("INTERVAL 10 MINUTES")).first()[0]
    want = BATCH[name](log).where(F.col(time_key).cast("timestamp") + F.expr(f"INTERVAL {width}") <= F.lit(closed))
    assert as_set(spark.read.parquet(out).select(*want.columns)) == as_set(want) != []


def test_half_a_batch_is_not_read(spark, log, tmp_path):
    name, out = "chain_health", str(tmp_path / "out")
    rollup, _ = rollups.ROLLUPS[name]
    first, second = parts(log, 2)
    spark.createDataFrame([], "day date, upto bigint").write.parquet(f"{out}/compactions")
    stream_rollups.write_batch(first, rollup, out, 0)
    whole = as_set(rollups.chain_health(first))
    half = rollup.state(second).withColumn("day", F.expr(rollup.day))
    half.write.partitionBy("day").parquet(f"{out}/batches/batch_id=1")  # rows, but no note that they are complete
    assert as_set(stream_rollups.read_rollup_table(spark, out, name)) == whole
    stream_rollups.compact(spark, out, name, 1)
    assert as_set(stream_rollups.read_rollup_table(spark, out, name)) == whole
    stream_rollups.write_batch(second, rollup, out, 1)
    assert as_set(stream_rollups.read_rollup_table(spark, out, name)) == as_set(rollups.chain_health(log))


def test_filter_stream_equals_batch(spark, log, tmp_path):
    source = str(tmp_path / "log")
    for part in parts(log, 3):
        write_table(part, source, "requests", mode="append")
    units = seed_method_units(spark)
    for name, operator in {
        "errors": rollups.errors,
        "expensive": lambda df: rollups.expensive_method_usage(df, units),
    }.items():
        out = str(tmp_path / name)
        query = windows.start_filter(
            read_requests(spark, source, stream=True, files_per_batch=5), operator, out, f"{out}-state", available_now=True
        )
        query.awaitTermination()
        assert as_set(spark.read.parquet(out).drop("event_date")) == as_set(operator(read_requests(spark, source)))
