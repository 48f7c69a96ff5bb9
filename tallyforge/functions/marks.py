"""Bitmaps of keys that drop rows at the scan, before anything is shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bitmap: 2 MB, at most 262 144 rows of 64 bits.
BITS = 1 << 24


def _slot(columns: Sequence[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(bits))


def marks_of(keys: DataFrame, columns: Sequence[str], bits: int = BITS) -> DataFrame:
    """A bitmap of the keys: at most bits / 64 rows however many keys there are, so it may always be broadcast."""
    slots = keys.select(_slot(columns, bits).alias("_slot"))
    return slots.groupBy(F.expr("shiftright(_slot, 6)").alias("_word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(_slot & 63 as int)))").alias("_bits")
    )


def only_marked(rows: DataFrame, columns: Sequence[str], marks: DataFrame, bits: int = BITS) -> DataFrame:
    """The rows whose key is in the bitmap, and a share of the others as large as the share of its bits that are set.

    This is a filter: what follows has to compare the keys themselves.  Without marks no row is read.
    """
    hit = F.expr("shiftright(_slot, 6) = _word AND getbit(_bits, cast(_slot & 63 as int)) = 1")
    return rows.withColumn("_slot", _slot(columns, bits)).join(F.broadcast(marks), hit).select(*rows.columns)
