"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import pytest
from check import compare, connect

import __spark_entry__ as contract

NAMES = list(contract.queries())


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, sf_dir, name):
    good, text = compare(spark, con, sf_dir, name, contract.queries()[name], contract.oracle_sql().get(name))
    assert good, text


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns[:3] == ["organization_id", "chain_slug", "chain_type"]
    assert result.count() > 0
