"""Edges that the generated log does not reach."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from conftest import as_set, plan_text
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyforge.operators import billing, ingest, policy, rollups, series, usage
from tallyforge.operators import catalog as views
from tallyforge.plans import dashboards, reports
from tallyforge.sources import catalog as sources
from tallyforge.sources.requests import LOOKUP_COLUMNS, apply_retention, expired_partitions, read_requests, write_table

JANUARY = ("2024-01-01", "2024-01-31")


@pytest.fixture
def empty(make_log):
    return make_log([])


def test_empty_log_gives_empty_tables(empty):
    for f in (
        usage.usage_hourly,
        usage.usage_daily,
        rollups.errors,
        rollups.latency_metrics,
        rollups.chain_health,
        rollups.chain_method_usage,
        rollups.chain_org_usage,
        rollups.chain_popularity,
        series.slo_report,
        series.alert_rejection_rate,
    ):
        assert f(empty).count() == 0


def test_summary_without_traffic_is_one_zero_row(empty, make_log):
    for log in (empty, make_log([{"organization_id": "other"}])):
        state = usage.usage_daily_state_from_log(log)
        (row,) = reports.usage_summary(state, "org1", *JANUARY).collect()
        assert (row.total_requests, row.error_count, row.success_rate_pct) == (0, 0, 0.0)
        assert row.error_rate_pct is None and row.latency_p95 is None
        assert reports.usage_by_chain(state, "org1", *JANUARY).count() == 0
        assert reports.daily_usage(state, "org1", *JANUARY).count() == 0


def test_key_report(make_log):
    state = usage.usage_daily_state_from_log(
        make_log([{"event_time": datetime(2023, 12, 5)}, {"api_key_prefix": "sk_2", "organization_id": "org2"}])
    )
    (row,) = reports.api_key_usage(state, "sk_1", *JANUARY).collect()
    assert (row.organization_id, row.total_requests, row.success_rate_pct) == ("org1", 0, 0.0)
    with pytest.raises(PySparkException, match="unknown API key sk_9"):
        reports.api_key_usage(state, "sk_9", *JANUARY).collect()


def test_reports_of_one_organisation(make_log):
    log = make_log(
        [{"organization_id": "a", "latency_ms": 10 * i, "status_code": 301 if i == 0 else 200} for i in range(5)]
        + [{"organization_id": "b", "is_error": 1, "status_code": 500}]
    )
    state = usage.usage_daily_state_from_log(log)
    (row,) = reports.usage_summary(state, "a", *JANUARY).collect()
    assert (row.total_requests, row.error_rate_pct, row.success_rate_pct, row.latency_p95) == (5, 0.0, 100.0, 38.0)
    # The daily report counts 2xx only, so the redirect lowers it.
    (row,) = reports.daily_usage(state, "a", *JANUARY).collect()
    assert row.success_rate_pct == 80.0


def test_nested_report(catalog, make_log):
    log = make_log(
        [{"organization_id": "o1", "chain_slug": c, "rpc_method": f"m{i:02d}"} for i in range(12) for c in ["x"] + ["y"] * (i % 2)]
    )
    daily, hourly = usage.usage_daily_state_from_log(log), usage.usage_hourly_state(log)

    def report(org, breakdown=True):
        span = ("2024-01-01", "2024-01-31")
        return reports.usage_report(daily, hourly, catalog, org, *span, breakdown, method_limit=reports.NESTED_METHODS).collect()

    (row,) = report("o1")
    assert (row.organization.plan_slug, row.summary.total_requests, row.summary.latency_p95) == ("pro", 18, 0.0)
    assert [(c.chain_slug, c.requests) for c in row.by_chain] == [("x", 12), ("y", 6)]
    # Ten methods, ties by name.
    assert [m.method for m in row.top_methods] == [f"m{i:02d}" for i in (1, 3, 5, 7, 9, 11, 0, 2, 4, 6)]
    (row,) = report("o2")
    assert (row.summary.total_requests, row.summary.success_rate_pct, row.by_chain, row.top_methods) == (0, 0.0, [], [])
    assert row.summary.error_rate_pct is None
    assert report("nobody") == []
    assert len(report(None, breakdown=False)) == 2
    assert "by_chain" not in report("o1", breakdown=False)[0]


def test_reports_of_every_organisation_match_single_ones(make_log):
    log = make_log([{"organization_id": f"o{i % 3}", "rpc_method": f"m{i % 25}", "latency_ms": i} for i in range(200)])
    daily, hourly = usage.usage_daily_state_from_log(log), usage.usage_hourly_state(log)
    span = ("2024-01-01", "2024-01-02")
    single = {
        "summary": lambda org: reports.usage_summary(daily, org, *span),
        "chain": lambda org: reports.usage_by_chain(daily, org, *span),
        "method": lambda org: reports.usage_by_method(hourly, org, *span),
        "daily": lambda org: reports.daily_usage(daily, org, *span),
        "hourly": lambda org: reports.hourly_usage(hourly, org, datetime(2024, 1, 1), datetime(2024, 1, 2)),
    }
    for grain, one in single.items():
        every = reports.usage_reports_all(daily, hourly, *span, grain)
        for org in ("o0", "o1", "o2"):
            assert as_set(every.where(F.col("organization_id") == org).drop("organization_id")) == as_set(one(org)), grain


def test_bucket_bounds(make_log):
    (row,) = rollups.latency_metrics(make_log([{"latency_ms": v} for v in (9, 10, 49, 50, 100, 500, 999, 1000)])).collect()
    assert list(row)[3:9] == [1, 2, 1, 1, 2, 1]


def test_date_ranges():
    now = datetime(2024, 3, 10, 12)
    assert reports.resolve_range(now) == reports.Range(datetime(2024, 3, 1), now)
    got = reports.resolve_range(now, date(2024, 2, 28), date(2024, 2, 29))
    assert got.end == datetime(2024, 2, 29, 23, 59, 59)
    with pytest.raises(ValueError, match="after"):
        reports.resolve_range(now, date(2024, 4, 1))
    with pytest.raises(ValueError, match="1 year"):
        reports.resolve_range(now, date(2023, 1, 1))
    with pytest.raises(ValueError, match="7 days"):
        reports.resolve_range(now, date(2024, 3, 1), hourly=True)
    assert [reports.wants_breakdown(t) for t in ("true", "True", None)] == [True, False, False]


def test_month_to_date_at_month_ends(make_log):
    log = make_log([{"event_time": datetime(2024, 2, d)} for d in (1, 29)] + [{"event_time": datetime(2024, 1, 31)}])
    state = usage.usage_daily_state_from_log(log)
    (row,) = dashboards.usage_by_plan(state, "2024-02-29 23:59:59").collect()
    assert row.total_requests == 2
    (row,) = dashboards.usage_by_plan(state, "2024-01-31 00:00:00").collect()
    assert row.total_requests == 1


def test_default_abuse_threshold_is_strict(spark, make_log):
    log = make_log([{"compute_units": 50, "rpc_method": "trace_block", "consumer_id": c} for c in ["a"] * 100 + ["b"] * 101])
    calls = rollups.expensive_method_usage(log, sources.seed_method_units(spark))
    rows = dashboards.expensive_abusers(calls, "2024-01-01 00:30:00").collect()
    assert [(r.consumer_id, r.usage_count) for r in rows] == [("b", 101)]


@pytest.fixture(scope="module")
def catalog(spark):
    def frame(rows, ddl):
        return spark.createDataFrame(rows, ddl)

    plans = sources.seed_plans(spark).withColumn(
        "allowed_chains", F.when(F.col("slug") == "free", F.lit('["*", "x"]')).when(F.col("slug") == "basic", F.lit(None)).otherwise(F.col("allowed_chains"))
    )
    return {
        "organizations": frame(
            [("o1", "One", "one", "active", datetime(2024, 1, 1)), ("o2", "Two", "two", "suspended", datetime(2024, 1, 2))],
            "id string, name string, slug string, status string, created_at timestamp",
        ),
        "plans": plans,
        "chains": sources.seed_chains(spark),
        "subscriptions": frame(
            [
                ("s2", "o1", "plan-basic", "active", datetime(2024, 1, 1), datetime(2024, 2, 1)),
                ("s1", "o1", "plan-pro", "active", datetime(2024, 1, 1), None),
                ("s0", "o1", "plan-free", "active", None, None),
            ],
            "id string, organization_id string, plan_id string, status string, current_period_start timestamp, current_period_end timestamp",
        ),
        "api_keys": frame(
            [
                ("k1", "o1", "c1", "sk_a", "active", None, '["*"]', "[]"),
                ("k2", "o1", "c2", "sk_a", "revoked", None, "[]", "[]"),
                ("k3", "o1", "c3", "sk_b", "active", datetime(2024, 1, 15), None, '["eth_getLogs"]'),
            ],
            "id string, organization_id string, consumer_id string, key_prefix string, status string, expires_at timestamp,"
            " allowed_chains string, restricted_methods string",
        ),
        "plan_chain_limits": frame([("plan-pro", "chain-eth-mainnet", 7)], "plan_id string, chain_id string, rate_limit_per_minute int"),
    }


def test_one_subscription_per_organisation(catalog):
    rows = {r.organization_id: r.plan_slug for r in views.org_profile(catalog).collect()}
    assert rows == {"o1": "pro", "o2": ""}
    assert [r.organization_id for r in views.list_orgs(catalog).collect()] == ["o1"]
    assert views.org_profile(catalog, slug="two").count() == 1
    assert views.org_profile(catalog, "nobody").count() == 0


def test_wildcard_must_stand_alone(catalog):
    access = {(r.plan_slug, r.chain_slug): r for r in views.plan_chain_access(catalog).collect()}
    assert len(access) == 4 * 21
    assert not access["free", "eth-mainnet"].has_access
    assert not access["basic", "eth-mainnet"].has_access
    assert access["pro", "eth-mainnet"].has_access
    assert access["pro", "eth-mainnet"].rate_limit_per_minute == 7
    assert access["pro", "op-mainnet"].rate_limit_per_minute == 10000


def test_keys(catalog, make_log):
    assert [r.id for r in views.valid_keys(catalog, "2024-01-14 00:00:00").orderBy("id").collect()] == ["k1", "k3"]
    assert [r.id for r in views.valid_keys(catalog, "2024-01-15 00:00:00").collect()] == ["k1"]
    log = make_log([{"api_key_prefix": p, "consumer_id": "?"} for p in ("sk_a", "sk_b", "sk_c")])
    good, bad = views.split_by_key(log, views.valid_keys(catalog, "2024-01-15 00:00:00"))
    assert (good.count(), bad.count()) == (1, 2)
    # The shared prefix belongs to its active key, and adds no row.
    rows = {r.api_key_prefix: (r.consumer_id, r.plan_slug) for r in ingest.enrich_tenant(log, catalog).collect()}
    assert rows == {"sk_a": ("c1", "pro"), "sk_b": ("c3", "pro"), "sk_c": ("", "free")}
    marks = {r.api_key_prefix: r.scope_violation for r in policy.scope_gate(log, catalog).collect()}
    assert marks == {"sk_a": None, "sk_b": "chain", "sk_c": "unknown_key"}


def test_rpc_bodies(spark):
    bodies = ['{"method":"eth_call","id":7}', ' {"method":"m","id":"x"}', "[]", '[{"method":"m"}]', "{oops", "", None, "{}"]
    rows = ingest.parse_rpc_body(spark.createDataFrame([(b,) for b in bodies], "body string")).collect()
    assert [(r.rpc_method, r.rpc_id) for r in rows] == [("eth_call", "7"), ("m", "x")] + [(None, None)] * 6


def test_paths(spark):
    paths = ["/key/eth-mainnet", "/key", "/a/b/c", "key/eth", "/key/", None]
    rows = ingest.parse_access_path(spark.createDataFrame([(p,) for p in paths], "path string")).collect()
    assert [r.path_valid for r in rows] == [True] + [False] * 5
    assert (rows[0].api_key, rows[0].chain_slug) == ("key", "eth-mainnet")
    masked = ingest.mask_api_key(ingest.parse_access_path(spark.createDataFrame([("/" + "k" * 30 + "/x",)], "path string")))
    (row,) = masked.collect()
    assert row.path == "/[REDACTED]/x" and row.api_key_prefix == "k" * 20 and "api_key" not in masked.columns


def test_gates(spark, make_log):
    log = make_log(
        [{"plan_slug": p, "compute_units": u, "rpc_method": m} for p in ("free", "basic", "pro") for u, m in
         ((4, "eth_call"), (5, "eth_getStorageAt"), (10, "eth_getLogs"), (50, "trace_transaction"))]
    )
    live = [r.required_plan for r in policy.plan_gate(log).orderBy("request_id").collect()]
    assert live == [None, "basic", "basic", "pro", None, None, None, "pro", None, None, None, None]
    flags = policy.plan_gate(log, sources.seed_method_units(spark), "flags", sources.seed_plans(spark))
    assert [r.allowed for r in flags.orderBy("request_id").collect()] == [True, False, True, False] * 2 + [True] * 4


def test_seeds_and_insert_absent(spark):
    assert sources.seed_plans(spark).count() == 4
    assert sources.seed_chains(spark).groupBy("chain_type").count().where("count = 19 OR count = 2").count() == 2
    assert sources.seed_method_units(spark).agg(F.sum("compute_units")).first()[0] == 6 + 6 + 6 + 2 + 4 + 25 + 10 + 500
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    incoming = spark.createDataFrame([("a", 2), ("b", 4), ("b", 3), ("c", 5)], "k string, v int")
    assert sorted(tuple(r) for r in sources.insert_absent(target, incoming, ["k"]).collect()) == [("b", 3), ("c", 5)]


def test_retention_bounds(make_log, spark, tmp_path):
    times = [datetime(2024, 1, 16, 23, 59, 59), datetime(2024, 1, 17), datetime(2024, 1, 17, 0, 0, 1)]
    log = make_log([{"event_time": t} for t in times])
    kept = apply_retention(log, "event_time", "requests", "2024-01-31 00:00:00")
    assert [r.event_time for r in kept.collect()] == times[2:]
    assert [r.event_date for r in expired_partitions(log, "event_date", "requests", "2024-01-31 00:00:00").collect()] == [date(2024, 1, 16)]
    write_table(log, str(tmp_path / "log"), "requests")
    plan = apply_retention(read_requests(spark, str(tmp_path / "log")), "event_time", "requests", "2024-01-31 00:00:00")
    assert "PartitionFilters: [isnotnull(event_date" in plan_text(plan)


def test_rewriting_a_day_leaves_the_others(make_log, spark, tmp_path):
    path = str(tmp_path / "log")
    write_table(make_log([{"event_time": datetime(2024, 1, d)} for d in (1, 2)]), path, "requests")
    write_table(make_log([{"event_time": datetime(2024, 1, 2), "request_id": x} for x in "ab"]), path, "requests")
    assert read_requests(spark, path).count() == 3


def test_hold_turns_to_firing(spark, make_log):
    minutes = [0, 1, 2, 3, 10, 11]
    log = make_log([{"event_time": datetime(2024, 1, 1, 0, m), "plan_slug": "free", "status_code": 403} for m in minutes])
    rows = series.alert_plan_violation(log, hold="2 minutes").orderBy("eval_time").collect()
    assert [r.state for r in rows] == ["pending", "pending", "firing", "firing", "pending", "pending"]
    assert rows[-1].active_since == datetime(2024, 1, 1, 0, 11)


def test_histogram_quantile_in_the_infinite_bucket(make_log):
    log = make_log([{"latency_ms": v} for v in (5, 2000, 3000)])
    buckets = series.latency_buckets(log, ["route_name"])
    assert [r.value for r in series.histogram_quantile(buckets, 0.95, ["route_name"]).collect()] == [1000.0]
    (low,) = series.histogram_quantile(buckets, 0.2, ["route_name"]).collect()
    assert low.value == pytest.approx(6.0)
    # A bucket without requests still bounds its neighbour from below.
    sparse = series.latency_buckets(make_log([{"latency_ms": v} for v in (5, 200, 300)]), ["route_name"])
    (row,) = series.histogram_quantile(sparse, 0.5, ["route_name"]).collect()
    assert row.value == pytest.approx(100 + 400 * 0.25)


def test_ties_and_missing_rows_in_billing(spark):
    month = date(2024, 1, 1)
    invoices = spark.createDataFrame([(month, "a", 10), (month, "b", 5)], "period_start date, organization_id string, subtotal int")
    invoices = invoices.withColumns({"usage_charge": F.col("subtotal"), "fixed_charge": F.lit(0)})
    closed = billing.close_period(spark.createDataFrame([(month, "a", 10), (month, "c", 1)], "period_start date, organization_id string, cost int"))
    rows = billing.reconcile(invoices, closed).collect()
    assert {r.organization_id: r.outcome for r in rows} == {"a": "match", "b": "missing_snapshot", "c": "missing_invoice"}
    changed = closed.withColumn("cost", F.lit(10))
    assert {r.organization_id for r in billing.broken_rows(changed).collect()} == {"c"}
    fx = spark.createDataFrame([(date(2024, 1, 5), 2.0)], "rate_date date, try_per_usd double")
    dated = spark.createDataFrame([(date(2024, 1, d), 1.0) for d in (4, 5, 6)], "period_end date, total double")
    converted = billing.convert_fx(dated, fx, "2024-01-31").orderBy("period_end").collect()
    assert [(r.fx_rate, r.estimated) for r in converted] == [(None, None), (2.0, False), (2.0, True)]
    later = billing.convert_fx(dated, fx).orderBy("period_end").collect()
    assert [(r.fx_rate, r.estimated) for r in later] == [(None, None), (2.0, False), (2.0, True)]


def test_free_units_once_per_plan(spark):
    month = date(2024, 1, 1)
    metered = spark.createDataFrame(
        [(month, "o", "p", c, 100) for c in "abc"] + [(month, "q", "p", "a", 40), (month, "q", "p", "b", 0)],
        "period_start date, organization_id string, plan_slug string, chain_slug string, units long",
    )
    prices = spark.createDataFrame([("p", 100, 1.0)], "plan_slug string, included_units int, overage_rate double")
    rated = billing.rate_usage(metered, prices, spark.createDataFrame([], "chain_slug string, coefficient double"))
    assert {r.organization_id: r.cost for r in rated.groupBy("organization_id").agg(F.sum("cost").alias("cost")).collect()} == {"o": 200, "q": 0}
    assert sorted(float(r.billable_units) for r in rated.where("organization_id = 'o'").collect()) == [66.6666, 66.6667, 66.6667]


def test_base_fee_once_per_plan(spark):
    month, keys = date(2024, 1, 1), "period_start date, organization_id string, plan_slug string"
    rows = [(month, "o", "p", c, 5) for c in "abc"] + [(month, "o", "x", "a", 2), (month, "fix", "p", "a", 9), (month, "gone", "p", "a", None)]
    rated = spark.createDataFrame(rows, f"{keys}, chain_slug string, cost int")
    prices = spark.createDataFrame([("p", 30), ("q", 7), ("x", None)], "plan_slug string, base_fee int")
    contracts = spark.createDataFrame([("fix", "FIXED", 100), ("idle", "HYBRID", 1)], "organization_id string, contract_type string, price_fixed int")
    held = spark.createDataFrame([(month, "idle", "q"), (month, "idle", "q"), (month, "o", "p")], keys)
    got = {(r.organization_id, r.plan_slug): (int(r.base_fee), int(r.usage_charge), int(r.amount)) for r in billing.plan_charges(rated, prices, contracts, held).collect()}
    assert got == {("o", "p"): (30, 15, 45), ("o", "x"): (0, 2, 2), ("fix", "p"): (0, 0, 0), ("gone", "p"): (30, 0, 30), ("idle", "q"): (7, 0, 7)}
    assert billing.plan_charges(rated, prices).count() == 4 and billing.plan_charges(rated.limit(0), prices, contracts).count() == 0


def test_contracts_without_usage(spark):
    month = date(2024, 1, 1)
    rated = spark.createDataFrame(
        [(month, "used", "p", "a", 5, 7)], "period_start date, organization_id string, plan_slug string, chain_slug string, units long, cost int"
    )
    contracts = spark.createDataFrame(
        [
            ("idle", "FIXED", 10, None, None), ("over", "FIXED", 10, None, date(2023, 12, 31)), ("later", "FIXED", 10, date(2024, 1, 2), None),
            ("quiet", "METERED", None, None, None), ("used", "HYBRID", 1, date(2023, 1, 1), None), ("used", "FIXED", 9, date(2022, 1, 1), None),
        ],
        "organization_id string, contract_type string, price_fixed int, start_date date, end_date date",
    )
    owed = {r.organization_id: (r.contract_type, int(r.amount)) for r in billing.apply_contracts(rated, contracts).collect()}
    assert owed == {"idle": ("FIXED", 10), "used": ("HYBRID", 8)}
    invoices = {r.organization_id: (int(r.total), len(r.line_items)) for r in billing.build_invoices(rated, contracts, tax_rate="0").collect()}
    assert invoices == {"idle": (10, 1), "used": (8, 2)}
    assert {r.outcome for r in billing.reconcile(billing.build_invoices(rated, contracts), billing.close_period(rated), contracts).collect()} == {"match"}


def test_dates_without_time_are_whole_days(make_log, spark, tmp_path):
    log = make_log([{"event_time": datetime(2024, 1, d, 15), "rpc_method": "m"} for d in (1, 2, 3)])
    daily, hourly = usage.usage_daily_state_from_log(log), usage.usage_hourly_state(log)
    for end in ("2024-01-02", date(2024, 1, 2), datetime(2024, 1, 2, 23, 59, 59)):
        for grain, count in (("summary", "total_requests"), ("chain", "requests"), ("method", "requests"), ("daily", "requests"), ("hourly", "requests")):
            rows = reports.usage_reports_all(daily, hourly, "2024-01-01", end, grain).agg(F.sum(count).alias("n")).first()
            assert rows.n == 2, grain
    path = str(tmp_path / "log")
    write_table(log, path, "requests")
    assert read_requests(spark, path, start="2024-01-02", end="2024-01-02").count() == 1
    assert read_requests(spark, path, end=datetime(2024, 1, 2, 14)).count() == 1


def test_windows_that_are_no_multiple_of_the_step(make_log):
    times = [0, 7, 50, 61, 95, 130, 200]
    log = make_log([{"event_time": datetime(2024, 1, 1) + timedelta(seconds=t)} for t in times])
    for width, step in ((60, 45), (45, 60), (30, 20), (60, 60)):
        got = {r.eval_time: r.n for r in series.sliding(log, [], {"n": F.lit(1)}, width, step).collect()}
        zero = datetime(2024, 1, 1)
        ends = [zero + timedelta(seconds=s) for s in range(-(int(zero.timestamp()) % step), 400, step)]
        want = {e: sum(e - timedelta(seconds=width) <= zero + timedelta(seconds=t) < e for t in times) for e in ends}
        assert got == {e: n for e, n in want.items() if n}, (width, step)


def test_keys_never_stay_in_paths(spark):
    paths = ["/sk_live_secret", "/sk_1/eth-mainnet", "/sk_1/a/b", "//sk_1/x", "sk_1/x", "/", None]
    rows = ingest.mask_api_key(ingest.parse_access_path(spark.createDataFrame([(p,) for p in paths], "path string"))).collect()
    assert not any("sk_" in (r.path or "") for r in rows)


def test_unique_audit_tells_glued_values_apart(spark):
    limits = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("x", "y"), ("x", "y")], "plan_id string, chain_id string")
    rows = views.audit_catalog({"plan_chain_limits": limits}).where("rule = 'unique'").collect()
    assert [(r.value, r.violations) for r in rows] == [("x|y", 2)]


def test_keep_last_takes_the_newest(make_log):
    log = make_log([{"event_time": datetime(2024, 1, 1, 0, m), "status_code": 200 + m} for m in range(3)])
    rows = usage.keep_last(log.select("consumer_id", "event_time", "status_code"), ["consumer_id"], ["event_time"])
    assert as_set(rows.select("status_code")) == [(("status_code", 202),)]


def test_reports_prune_month_partitions(make_log, spark, tmp_path):
    log = make_log([{"event_time": datetime(2024, m, 15), "latency_ms": m} for m in (1, 2, 3)])
    path = str(tmp_path / "daily")
    write_table(usage.usage_daily_state_from_log(log), path, "usage_daily", bloom=LOOKUP_COLUMNS)
    stored = spark.read.parquet(path)
    report = reports.usage_by_chain(stored, "org1", "2024-02-01", "2024-02-29")
    assert [r.latency_p95 for r in report.collect()] == [2.0]
    assert "event_month" in plan_text(report).split("PartitionFilters")[1].split("PushedFilters")[0]
    month = dashboards.usage_by_plan(stored, "2024-03-31 00:00:00")
    assert [r.total_requests for r in month.collect()] == [1]


def test_shares_of_huge_usage_are_exact(spark):
    """Beyond 2^53 ten-thousandths doubles would round; shares add up to the plan's to the last digit."""
    month, units = date(2024, 1, 1), [123_456_789_012, 98_765_432_109, 7]
    metered = spark.createDataFrame(
        [(month, "a", "pro", f"c{i}", u) for i, u in enumerate(units)], "period_start date, organization_id string, plan_slug string, chain_slug string, units bigint"
    )
    prices = spark.createDataFrame([("pro", 1_000_001, Decimal("0.000123"))], "plan_slug string, included_units bigint, overage_rate decimal(12,6)")
    weights = spark.createDataFrame([("c0", Decimal("3.3333")), ("c1", Decimal("0.0001"))], "chain_slug string, coefficient decimal(9,4)")
    rows = billing.rate_usage(metered, prices, weights).orderBy("chain_slug").collect()
    weighted = [u * w for u, w in zip(units, (Decimal("3.3333"), Decimal("0.0001"), Decimal(1)), strict=True)]
    total, running, before, paid = sum(weighted), Decimal(0), Decimal(0), Decimal(0)
    for row, part in zip(rows, weighted, strict=True):
        running += part
        share = (Fraction(running) * Fraction(total - 1_000_001) / Fraction(total) * 10000 + Fraction(1, 2)) // 1 / Fraction(10000)
        through = Decimal(share.numerator) / Decimal(share.denominator)
        cost = (through * Decimal("0.000123")).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert (row.billable_units, row.cost) == (through - before, cost - paid)
        before, paid = through, cost
    assert sum(r.billable_units for r in rows) == total - 1_000_001
