from __future__ import annotations

import contextlib
import io
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]


@pytest.fixture(scope="session")
def spark():
    from tallyforge.session import build_session

    session = build_session("local[8]", 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


def request_rows(spark, rows):
    """A request log from partial dicts; what is not given has a harmless default."""
    from datetime import datetime

    from tallyforge.schemas import request_schema

    schema = request_schema()
    defaults = {
        "event_time": datetime(2024, 1, 1),
        "organization_id": "org1",
        "consumer_id": "c1",
        "api_key_prefix": "sk_1",
        "plan_slug": "free",
        "chain_slug": "eth-mainnet",
        "chain_type": "evm",
        "route_name": "r",
        "method": "POST",
        "upstream_host": "h",
        "rpc_method": "eth_call",
        "status_code": 200,
        "response_size": 0,
        "latency_ms": 0,
        "upstream_latency_ms": 0,
        "compute_units": 1,
        "is_error": 0,
        "error_message": "",
    }
    full = []
    for i, row in enumerate(rows):
        r = {**defaults, "request_id": f"r{i:06d}", **row}
        r.setdefault("event_time_ms", r["event_time"])
        r.setdefault("event_date", r["event_time"].date())
        full.append(tuple(r.get(f.name) for f in schema))
    return spark.createDataFrame(full, schema)


@pytest.fixture
def make_log(spark):
    return lambda rows: request_rows(spark, rows)


def as_set(df):
    """Rows as a sorted list of dict items, doubles rounded."""
    out = []
    for row in df.collect():
        items = row.asDict()
        out.append(tuple((k, round(v, 6) if isinstance(v, float) else v) for k, v in sorted(items.items())))
    return sorted(out, key=repr)


def plan_text(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()
