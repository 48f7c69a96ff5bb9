"""Named queries, each next to the SQL that checks it."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyforge.workload.fixtures import check_sql

Query = Callable[[SparkSession, str], DataFrame]

_PERCENTILE = re.compile(r"(^|_)p\d+(_|$)")


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Doubles rounded and decimals as doubles, as the check queries give them."""
    columns = []
    for field in df.schema:
        name = f"`{field.name}`"
        if isinstance(field.dataType, T.DoubleType):
            columns.append(f"round({name}, {4 if _PERCENTILE.search(field.name) else 6}) AS {name}")
        elif isinstance(field.dataType, T.DecimalType):
            columns.append(f"CAST({name} AS DOUBLE) AS {name}")
        else:
            columns.append(name)
    return df.selectExpr(*columns)


def query(name: str, views: list[str] | None = None, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` reads the fixture ``views``."""

    def register(run: Query) -> Query:
        if name in ENTRIES:
            raise ValueError(f"query {name!r} is registered twice")
        text = None if sql is None else check_sql(views or ["requests"], sql)
        ENTRIES[name] = Entry(lambda spark, sf_dir: comparable(run(spark, sf_dir)), text)
        return run

    return register
