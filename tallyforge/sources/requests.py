"""Request-log scan, partitioned sinks and retention."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.functions.measures import at, last_moment
from tallyforge.schemas import request_schema

# Days each table is kept.
RETENTION_DAYS = {
    "requests": 14,
    "usage_hourly": 90,
    "usage_daily": 540,
    "errors": 30,
    "latency_metrics": 90,
    "rate_limit_events": 30,
    "chain_health": 30,
    "chain_method_usage": 180,
    "chain_org_usage": 540,
    "chain_popularity": 30,
    "expensive_method_usage": 7,
}

# Partition grain and sort order of each table.
TABLE_LAYOUT: dict[str, tuple[str, str, list[str]]] = {
    "requests": ("day", "event_time", ["event_time", "chain_slug", "organization_id", "consumer_id", "status_code"]),
    "usage_hourly": (
        "month",
        "hour",
        ["hour", "chain_slug", "organization_id", "consumer_id", "api_key_prefix", "plan_slug", "route_name", "rpc_method"],
    ),
    "usage_daily": (
        "month",
        "event_date",
        ["event_date", "chain_slug", "organization_id", "consumer_id", "api_key_prefix", "plan_slug"],
    ),
    "errors": ("day", "event_time", ["event_time", "organization_id", "error_type"]),
    "latency_metrics": ("month", "minute", ["minute", "route_name", "upstream_host"]),
    "rate_limit_events": ("day", "event_time", ["event_time", "organization_id", "consumer_id"]),
    "chain_health": ("day", "minute", ["minute", "chain_slug", "upstream_host"]),
    "chain_method_usage": ("month", "event_date", ["event_date", "chain_slug", "rpc_method"]),
    "chain_org_usage": ("month", "event_date", ["event_date", "organization_id", "chain_slug"]),
    "chain_popularity": ("month", "hour", ["hour", "chain_slug"]),
    "expensive_method_usage": ("day", "event_time", ["event_time", "consumer_id", "chain_slug", "rpc_method"]),
}

# Columns by which single tenants are looked up.
LOOKUP_COLUMNS = ["organization_id", "consumer_id", "api_key_prefix"]


def read_requests(
    spark: SparkSession,
    path: str,
    stream: bool = False,
    start: date | datetime | str | None = None,
    end: date | datetime | str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """A1: the request log, batch or stream, with the declared schema.

    ``start`` and ``end`` (inclusive; a date without a time is its whole day) are
    put on the time column and on the partition column, so that whole days are
    pruned.
    """
    if stream:
        reader = spark.readStream.schema(request_schema())
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        log = reader.parquet(path)
    else:
        log = spark.read.schema(request_schema()).parquet(path)
    if start is not None:
        log = log.where((F.col("event_time") >= at(start)) & (F.col("event_date") >= at(start).cast("date")))
    if end is not None:
        last = last_moment(end)
        log = log.where((F.col("event_time") <= last) & (F.col("event_date") <= last.cast("date")))
    return log


def read_or_empty(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A Parquet folder with a declared schema; a folder that is not there yet is empty."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_rollup(
    df: DataFrame,
    path: str,
    grain: str,
    time_col: str,
    sort_by: Sequence[str],
    mode: str = "overwrite",
    bloom: Sequence[str] = (),
) -> None:
    """Write partitioned by day (``event_date``) or month (``event_month``).

    REBALANCE lets adaptive execution split the files of a partition that
    holds most of the rows and join the files of small ones.  Overwriting is
    per partition, so a rerun for one day leaves the other days alone.
    ``bloom`` names columns to get Parquet bloom filters, for point lookups
    by columns the files are not sorted by.
    """
    if grain == "day":
        part, df = "event_date", df.withColumn("event_date", F.to_date(time_col))
    elif grain == "month":
        part, df = "event_month", df.withColumn("event_month", F.date_format(time_col, "yyyyMM"))
    else:
        raise ValueError(f"unknown grain {grain!r}")
    sort_by = [c for c in sort_by if c != part]
    writer = df.hint("rebalance", part).sortWithinPartitions(part, *sort_by).write.mode(mode)
    if bloom:
        filters = {f"parquet.bloom.filter.enabled#{c}": "true" for c in bloom}
        writer = writer.options(**filters, **{"parquet.bloom.filter.adaptive.enabled": "true"})
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)


def write_table(
    df: DataFrame, path: str, table: str, mode: str = "overwrite", bloom: Sequence[str] = ()
) -> None:
    """A11 with the layout of a known table.

    ``bloom`` (say LOOKUP_COLUMNS) pays off for large files that are searched
    by key; it makes writing slower, so it is off unless asked for.
    """
    grain, time_col, sort_by = TABLE_LAYOUT[table]
    write_rollup(df, path, grain, time_col, sort_by, mode, bloom)


def apply_retention(df: DataFrame, time_col: str, table: str, as_of: datetime | str) -> DataFrame:
    """Rows not yet expired at ``as_of``; a date counts as its midnight.

    The bound is a constant on the bare column, so it reaches the scan; where
    the table has a partition column, that one is bounded too.
    """
    oldest = at(as_of) - F.expr(f"INTERVAL {RETENTION_DAYS[table]} DAYS")
    kept = df.where(F.col(time_col) > oldest)
    if "event_date" in df.columns and time_col != "event_date":
        kept = kept.where(F.col("event_date") >= oldest.cast("date"))
    if "event_month" in df.columns:
        kept = kept.where(F.col("event_month").cast("string") >= F.date_format(oldest, "yyyyMM"))
    return kept


def expired_partitions(df: DataFrame, day_col: str, table: str, as_of: datetime | str) -> DataFrame:
    """The days of which every row has expired at ``as_of``."""
    days = df.select(F.col(day_col).alias("event_date")).distinct()
    return days.where(F.date_add("event_date", RETENTION_DAYS[table] + 1).cast("timestamp") <= at(as_of))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Number of rows of each table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result
