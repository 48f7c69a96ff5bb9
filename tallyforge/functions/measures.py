"""Small column expressions shared by the operators."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIB = float(1024**2)
GIB = float(1024**3)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double; null where the whole is zero."""
    return F.when(whole != 0, part.cast("double") / whole.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * F.lit(100.0)


def gigabytes(size: Column) -> Column:
    return size.cast("double") / F.lit(GIB)


def megabytes(size: Column) -> Column:
    return size.cast("double") / F.lit(MIB)


def quantile_label(q: float) -> str:
    """0.5 -> p50, 0.99 -> p99, 0.999 -> p999."""
    digits = f"{q:.6f}"[2:].rstrip("0")
    return "p" + digits.ljust(2, "0")


def at(moment: datetime | str) -> Column:
    return F.lit(str(moment)).cast("timestamp")


def last_moment(moment: date | datetime | str) -> Column:
    """The inclusive end that ``moment`` names: of a date without a time its last microsecond."""
    whole_day = isinstance(moment, date) and not isinstance(moment, datetime)
    if whole_day or re.fullmatch(r"\s*\d+-\d+-\d+\s*", str(moment)):
        return at(moment) + F.expr("INTERVAL 1 DAY") - F.expr("INTERVAL 1 MICROSECOND")
    return at(moment)


def ago(moment: datetime | str, interval: str) -> Column:
    """The instant ``interval`` (such as '24 HOURS') before ``moment``."""
    return at(moment) - F.expr(f"INTERVAL {interval}")


def within(df: DataFrame, column: str, low: Column, high: Column) -> DataFrame:
    """Rows with ``column`` between two constants, inclusive.

    The bounds are also put on the partition column the table may have, so
    that days or months outside are not even listed.
    """
    rows = df.where(F.col(column).between(low, high))
    if column != "event_date" and "event_date" in df.columns:
        rows = rows.where(F.col("event_date").between(low.cast("date"), high.cast("date")))
    if "event_month" in df.columns:
        month = F.col("event_month").cast("string")
        rows = rows.where(month.between(F.date_format(low, "yyyyMM"), F.date_format(high, "yyyyMM")))
    return rows


def parsed_list(col: Column | str) -> Column:
    """A JSON text array as array<string>; malformed text gives null."""
    return F.from_json(col, "array<string>")


def chain_allowed(chains: Column | str, slug: Column | str) -> Column:
    """True if the parsed list is exactly the wildcard or names the chain; a null list allows nothing."""
    chains = F.col(chains) if isinstance(chains, str) else chains
    slug = F.col(slug) if isinstance(slug, str) else slug
    return F.coalesce((chains == F.array(F.lit("*"))) | F.array_contains(chains, slug), F.lit(False))


def lookup(fact: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join a fact table to a unique-keyed lookup that may grow with the data.

    A plain equi-join: Catalyst broadcasts the lookup while its own size is below the
    threshold; beyond that, adaptive execution splits the shuffled partitions of
    hot keys, and only of those.  No copy of the lookup is made.
    """
    return fact.join(dim, list(on), how)


#: Rows of configuration that may travel in a plan.
LITERAL_ROWS = 20_000


def literal_rows(config: DataFrame, most: int = LITERAL_ROWS) -> DataFrame:
    """Configuration as literal rows if there are at most ``most`` of them (they are read for that), else as it is.

    Catalyst knows the size of literal rows and broadcasts them below its threshold; of a table behind JDBC it knows none, and
    would shuffle the large side of a join before it learns how small the other is.
    """
    rows = config.limit(most + 1).toArrow()
    return config if rows.num_rows > most else config.sparkSession.createDataFrame(rows, config.schema)
