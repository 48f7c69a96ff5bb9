"""Catalog scans, seed tables and insert-if-absent loading (A2-A4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.schemas import CATALOG_DDL, catalog_schema

Catalog = dict[str, DataFrame]

# Plan slug, name, limits per minute, hour and day, monthly and
# yearly price, archive access, trace access.
PLANS = [
    ("free", "Free", 100, 5000, 100000, "0", "0", False, False),
    ("basic", "Basic", 1000, 50000, 1000000, "29", "290", False, False),
    ("pro", "Pro", 10000, 500000, 10000000, "99", "990", True, True),
    ("enterprise", "Enterprise", 100000, 5000000, 100000000, None, None, True, True),
]

# Slug, name, chain type, chain id, testnet, trace support, block time in seconds.
CHAINS = [
    ("eth-mainnet", "Ethereum Mainnet", "evm", "1", False, True, 12),
    ("eth-sepolia", "Ethereum Sepolia", "evm", "11155111", True, True, 12),
    ("eth-holesky", "Ethereum Holesky", "evm", "17000", True, False, 12),
    ("arb-mainnet", "Arbitrum One", "evm", "42161", False, True, 1),
    ("arb-sepolia", "Arbitrum Sepolia", "evm", "421614", True, False, 1),
    ("op-mainnet", "Optimism", "evm", "10", False, True, 2),
    ("op-sepolia", "Optimism Sepolia", "evm", "11155420", True, False, 2),
    ("base-mainnet", "Base", "evm", "8453", False, True, 2),
    ("base-sepolia", "Base Sepolia", "evm", "84532", True, False, 2),
    ("polygon-mainnet", "Polygon", "evm", "137", False, True, 2),
    ("polygon-amoy", "Polygon Amoy", "evm", "80002", True, False, 2),
    ("polygon-zkevm", "Polygon zkEVM", "evm", "1101", False, False, 1),
    ("bsc-mainnet", "BNB Smart Chain", "evm", "56", False, True, 3),
    ("bsc-testnet", "BNB Testnet", "evm", "97", True, False, 3),
    ("avax-mainnet", "Avalanche C-Chain", "evm", "43114", False, True, 2),
    ("avax-fuji", "Avalanche Fuji", "evm", "43113", True, False, 2),
    ("ftm-mainnet", "Fantom", "evm", "250", False, True, 1),
    ("gnosis-mainnet", "Gnosis Chain", "evm", "100", False, True, 5),
    ("celo-mainnet", "Celo", "evm", "42220", False, False, 5),
    ("sol-mainnet", "Solana Mainnet", "solana", None, False, False, 0),
    ("sol-devnet", "Solana Devnet", "solana", None, True, False, 0),
]

# Method, compute units, expensive, needs archive, needs trace (all evm).
METHOD_UNITS = [
    ("eth_blockNumber", 1, False, False, False),
    ("eth_chainId", 1, False, False, False),
    ("eth_gasPrice", 1, False, False, False),
    ("eth_getBalance", 1, False, False, False),
    ("eth_getCode", 1, False, False, False),
    ("eth_getTransactionCount", 1, False, False, False),
    ("eth_call", 2, False, False, False),
    ("eth_estimateGas", 2, False, False, False),
    ("eth_sendRawTransaction", 2, False, False, False),
    ("eth_getBlockByNumber", 3, False, False, False),
    ("eth_getBlockByHash", 3, False, False, False),
    ("eth_getBlockTransactionCountByNumber", 2, False, False, False),
    ("eth_getTransactionByHash", 2, False, False, False),
    ("eth_getTransactionReceipt", 2, False, False, False),
    ("eth_getLogs", 10, True, False, False),
    ("eth_newFilter", 5, False, False, False),
    ("eth_getFilterLogs", 10, True, False, False),
    ("eth_getStorageAt", 5, False, True, False),
    ("eth_getBalance_historical", 5, False, True, False),
    ("debug_traceTransaction", 50, True, True, True),
    ("debug_traceBlockByNumber", 100, True, True, True),
    ("debug_traceBlockByHash", 100, True, True, True),
    ("trace_transaction", 50, True, True, True),
    ("trace_block", 100, True, True, True),
    ("trace_filter", 100, True, True, True),
]


def read_catalog(spark: SparkSession, path: str, tables: Sequence[str] | None = None) -> Catalog:
    """A2: the catalog tables below ``path``, one Parquet folder each."""
    names = list(CATALOG_DDL) if tables is None else list(tables)
    return {name: spark.read.schema(catalog_schema(name)).parquet(f"{path}/{name}") for name in names}


def read_catalog_jdbc(spark: SparkSession, url: str, tables: Sequence[str] | None = None, **options: str) -> Catalog:
    """A2 from a relational catalog database; needs its JDBC driver on the classpath."""
    names = list(CATALOG_DDL) if tables is None else list(tables)
    return {name: spark.read.format("jdbc").options(url=url, dbtable=name, **options).load() for name in names}


def literal_table(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A small constant table as a VALUES relation.

    Catalyst knows the size of such a relation, unlike that of rows shipped
    from Python, so a join with it is planned as a broadcast at once.
    """

    def cell(value: object) -> str:
        if value is None:
            return "NULL"
        if isinstance(value, bool):
            return str(value).lower()
        if isinstance(value, str):
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return str(value)

    schema = T.StructType.fromDDL(ddl)
    lines = ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)
    table = spark.sql(f"SELECT * FROM VALUES {lines} AS t({', '.join(schema.names)})")
    return table.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def seed_plans(spark: SparkSession) -> DataFrame:
    """A3: the four plans."""
    base = literal_table(
        spark,
        PLANS,
        "slug string, name string, rate_limit_per_minute int, rate_limit_per_hour int, rate_limit_per_day int,"
        " price_monthly decimal(10,2), price_yearly decimal(10,2), archive_access boolean, trace_access boolean",
    )
    return base.select(
        F.concat(F.lit("plan-"), "slug").alias("id"),
        "*",
        F.lit("USD").alias("currency"),
        F.lit('["*"]').alias("allowed_chains"),
        F.lit(True).alias("websocket_access"),
        F.lit(True).alias("is_active"),
        F.lit(True).alias("is_public"),
    )


def seed_chains(spark: SparkSession) -> DataFrame:
    """A3: the known chains."""
    base = literal_table(
        spark,
        CHAINS,
        "slug string, name string, chain_type string, chain_id string, is_testnet boolean,"
        " supports_trace boolean, block_time_seconds int",
    )
    return base.select(
        F.concat(F.lit("chain-"), "slug").alias("id"),
        "*",
        F.lit(True).alias("supports_websocket"),
        F.lit(True).alias("supports_archive"),
        F.lit(True).alias("is_active"),
    )


def seed_method_units(spark: SparkSession) -> DataFrame:
    """A3: compute units and access flags of the known methods."""
    return literal_table(
        spark,
        [("evm", *row) for row in METHOD_UNITS],
        "chain_type string, method_name string, compute_units int, is_expensive boolean,"
        " requires_archive boolean, requires_trace boolean",
    )


def insert_absent(target: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """A4: the incoming rows to append: one per key, none whose key exists.

    Among incoming rows with one key the smallest row wins, so the result
    does not depend on arrival order.
    """
    rest = [c for c in incoming.columns if c not in key]
    one = incoming.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_row")).select(*key, "_row.*")
    return one.join(target.select(*key), list(key), "left_anti").select(*incoming.columns)


def resolve_slug(incoming: DataFrame, slug_col: str, dim: DataFrame, id_col: str) -> DataFrame:
    """A4: replace a slug by the id of the row it names; unknown slugs give null."""
    ids = dim.select(F.col("slug").alias(slug_col), F.col("id").alias(id_col))
    return incoming.join(ids, slug_col, "left").drop(slug_col)
