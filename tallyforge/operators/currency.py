"""Amounts in several currencies, at the quotes that held at a moment (H7)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.operators.billing import MONEY

RATE = "decimal(18,8)"
#: Seconds of a time range of ``as_of``.
SPAN = 30 * 86400


def as_of(rows: DataFrame, quotes: DataFrame, keys: Sequence[str], moment: str, quoted: str, span: int = SPAN) -> DataFrame:
    """Rows with the columns of the latest quote of the same ``keys`` at or before their ``moment``; null if there is none yet.

    Quotes and rows are one table, in order of time within ``keys`` and ranges of ``span`` seconds; the last quote so far is carried
    along each range.  What a range begins with comes from a row per key and range: the last quote of the ranges before.  So
    neither a key nor its quotes are one task, and rows meet no quote but the one that holds.  Of quotes of one moment the greatest
    counts.  Rows with a null key or moment find none.
    """
    values = [c for c in quotes.columns if c not in keys]
    quote = F.struct(quoted, *[c for c in values if c != quoted])
    known = quotes.where(reduce(and_, [F.col(c).isNotNull() for c in (*keys, quoted)]))
    piece = lambda at: F.floor(F.unix_seconds(at) / F.lit(span)).cast("bigint").alias("_piece")
    told = known.select(*keys, piece(quoted), F.col(quoted).alias("_at"), F.lit(0).alias("_kind"), quote.alias("_quote"))
    last = told.groupBy(*keys, "_piece").agg(F.max("_quote").alias("_quote"))
    asked = rows.select(
        *keys, piece(moment), F.col(moment).alias("_at"), F.lit(1).alias("_kind"), F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row")
    )
    every = told.withColumn("_row", F.lit(None).cast(asked.schema["_row"].dataType)).unionByName(asked, allowMissingColumns=True)
    along = Window.partitionBy(*keys, "_piece").orderBy("_at", "_kind", "_quote").rowsBetween(Window.unboundedPreceding, 0)
    found = every.withColumn("_inside", F.last("_quote", ignorenulls=True).over(along)).where("_kind = 1")

    pieces = last.unionByName(asked.select(*keys, "_piece").distinct(), allowMissingColumns=True)
    line = Window.partitionBy(*keys).orderBy("_piece").rangeBetween(Window.unboundedPreceding, -1)
    begun = pieces.withColumn("_carried", F.last("_quote", ignorenulls=True).over(line)).groupBy(*keys, "_piece").agg(F.max("_carried").alias("_carried"))
    held = found.join(begun, [*keys, "_piece"], "left").withColumn("_held", F.coalesce("_inside", "_carried"))
    return held.select("_row.*", *[F.col(f"_held.{c}").alias(c) for c in values])


def convert(
    invoices: DataFrame,
    quotes: DataFrame,
    to: str,
    moment: str = "period_end",
    base: str = "USD",
    span: int = SPAN,
) -> DataFrame:
    """H7 for any currencies: invoices with ``fx_rate``, ``quoted_at``, ``converted_amount`` and ``converted_currency``.

    ``quotes`` has currency, quoted_at and rate, the price of one unit in the ``base`` currency, which needs none.  An invoice's
    ``total`` in its ``currency`` goes through the base at the quotes that held at its ``moment``; ``quoted_at`` is the older of
    the two.  Without a quote yet the three columns are null.
    """
    prices = quotes.select("currency", F.col("quoted_at").cast("timestamp").alias("quoted_at"), F.col("rate").cast(RATE).alias("rate"))

    def priced(rows: DataFrame, currency: Column, name: str) -> DataFrame:
        asked = rows.withColumn("_at_moment", F.col(moment).cast("timestamp")).withColumn("currency_asked", currency)
        met = as_of(asked, prices.withColumnRenamed("currency", "currency_asked"), ["currency_asked"], "_at_moment", "quoted_at", span)
        is_base = F.col("currency_asked") == base
        return met.select(
            *rows.columns,
            F.when(is_base, F.lit(1).cast(RATE)).otherwise(F.col("rate")).alias(f"_{name}"),
            F.when(~is_base, F.col("quoted_at")).alias(f"_{name}_at"),
        )

    both = priced(priced(invoices, F.col("currency"), "own"), F.lit(to), "target")
    rate = F.when(F.col("currency") == to, F.lit(1).cast(RATE)).otherwise((F.col("_own") / F.col("_target")).cast(RATE))
    there = F.col("_own").isNotNull() & F.col("_target").isNotNull() | (F.col("currency") == to)
    return both.withColumn("fx_rate", F.when(there, rate)).select(
        *invoices.columns,
        "fx_rate",
        F.when(there, F.least("_own_at", "_target_at")).alias("quoted_at"),
        F.round(F.col("total") * F.col("fx_rate"), 2).cast(MONEY).alias("converted_amount"),
        F.lit(to).alias("converted_currency"),
    )
