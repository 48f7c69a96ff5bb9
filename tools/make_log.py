"""Write a large skewed request log for measurements.

usage: python tools/make_log.py OUT ROWS

One consumer makes a third of all requests; latencies are integers with a
long tail.  The log covers 30 days and is partitioned by day.
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from tallyforge.schemas import request_schema  # noqa: E402
from tallyforge.session import build_session  # noqa: E402
from tallyforge.sources.catalog import CHAINS, METHOD_UNITS  # noqa: E402


START_MS = 1704067200000  # 2024-01-01
SPAN_MS = 30 * 86400000


def main(out: str, rows: int) -> None:
    spark = build_session("local[8]", 64)
    spark.sparkContext.setLogLevel("ERROR")

    def draw(seed: int, bound: int):
        return F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(bound))

    methods = F.array(*[F.lit(m[0]) for m in METHOD_UNITS])
    units = F.array(*[F.lit(m[1]) for m in METHOD_UNITS])
    chains = F.array(*[F.lit(c[0]) for c in CHAINS[:12]])
    consumer = F.when(draw(1, 3) == 0, F.lit(7)).otherwise(draw(2, 20000))
    base = spark.range(0, rows, 1, 64).select(
        "id",
        F.timestamp_millis(F.lit(START_MS) + F.floor(F.col("id") * F.lit(SPAN_MS / rows))).alias("event_time_ms"),
        consumer.alias("c"),
        F.pow(draw(3, 1000) / 1000.0, 4).alias("tail"),
        draw(4, 25).cast("int").alias("m"),
        draw(5, 12).cast("int").alias("ch"),
        draw(6, 100).alias("s"),
    )
    org = F.pmod(F.col("c"), F.lit(500))
    status = F.when(F.col("s") < 90, 200).when(F.col("s") < 93, 429).when(F.col("s") < 96, 403).otherwise(502)
    log = base.select(
        F.date_trunc("second", "event_time_ms").alias("event_time"),
        "event_time_ms",
        F.concat(F.lit("req-"), F.col("id").cast("string")).alias("request_id"),
        F.lit("POST").alias("method"),
        F.lit("/[REDACTED]/x").alias("path"),
        F.concat(chains[F.col("ch")], F.lit("-route")).alias("route_name"),
        F.concat(F.lit("c"), F.col("c").cast("string")).alias("consumer_id"),
        F.concat(F.lit("org"), org.cast("string")).alias("organization_id"),
        F.concat(F.lit("sk_"), F.col("c").cast("string")).alias("api_key_prefix"),
        F.array(*[F.lit(p) for p in ("free", "basic", "pro", "enterprise")])[F.pmod(org, F.lit(4)).cast("int")].alias("plan_slug"),
        chains[F.col("ch")].alias("chain_slug"),
        F.lit("evm").alias("chain_type"),
        status.alias("status_code"),
        (F.col("tail") * 100000).cast("bigint").alias("response_size"),
        (F.col("tail") * 2000).cast("int").alias("latency_ms"),
        (F.col("tail") * 1500).cast("int").alias("upstream_latency_ms"),
        F.concat(chains[F.col("ch")], F.lit("-"), F.pmod("id", F.lit(2)).cast("string")).alias("upstream_host"),
        methods[F.col("m")].alias("rpc_method"),
        units[F.col("m")].alias("compute_units"),
        F.when(status >= 400, 1).otherwise(0).alias("is_error"),
        F.to_date("event_time_ms").alias("event_date"),
    )
    missing = [f for f in request_schema() if f.name not in log.columns]
    log = log.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])
    log.select(*request_schema().names).write.mode("errorifexists").partitionBy("event_date").parquet(out)


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]))
