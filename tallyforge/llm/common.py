"""What the operators share: text rules, written intermediates, ranks and prefix sums without a hot task."""

from __future__ import annotations

import string
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"

#: Sort keys are whole numbers below this.
KEY_SPAN = 1 << 60


def fold_case(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, which also cuts its lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that run inside read files and hand Python this many rows at once, fewer where that is set already."""
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before = {name: spark.conf.get(name) for name in names}
    for name, most in before.items():
        spark.conf.set(name, str(min(rows, int(most)) if int(most) > 0 else rows))
    try:
        yield
    finally:
        for name, most in before.items():
            spark.conf.set(name, most)


def random_key(seed: str, *columns: str) -> Column:
    """A repeatable random whole number below KEY_SPAN."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), *parts)), 1, 15), 16, 10).cast("long")


def running_total(df: DataFrame, group: Sequence[str], key: str, ties: Sequence[str], value: str | None) -> DataFrame:
    """Add ``before``: the sum of ``value`` (rows, if None) over the rows of the group with a smaller key.

    ``df`` is read several times, so it should be a written table.  The key space of
    each group is cut into ranges of about equal numbers of rows; a task sorts whole
    ranges, and only the sums of the ranges are accumulated over a group.
    There are about four ranges for each shuffle partition, however many rows there
    are, so a group that holds a third of them is spread over a third of the tasks.
    Groups may be null.
    """
    spark = df.sparkSession
    names = {c: f"_g{i}" for i, c in enumerate(group)}
    same = lambda a, b, extra=(): [a[c].eqNullSafe(b[n]) for c, n in [*names.items(), *((x, x) for x in extra)]]
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = df.count()
    rows = max(32, -(-total // ranges))
    counted = written(
        df.groupBy(*[F.col(c).alias(n) for c, n in names.items()]).agg(F.ceil(F.count("*") / rows).alias("_ranges")),
        "ranges",
    )
    cut = df.join(counted, same(df, counted), "left").drop(*names.values())
    cut = cut.withColumn("_range", F.floor(F.col(key) / F.lit(float(KEY_SPAN)) * F.col("_ranges")))
    amount = F.lit(1) if value is None else F.col(value)
    inner = Window.partitionBy(*group, "_range").orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.withColumn("_inside", F.coalesce(F.sum(amount).over(inner), F.lit(0)))
    sums = cut.groupBy(*[F.col(c).alias(n) for c, n in names.items()], F.col("_range").alias("_r")).agg(
        F.sum(amount).alias("_sum")
    )
    outer = Window.partitionBy(*names.values()).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    sums = written(sums.select("*", F.coalesce(F.sum("_sum").over(outer), F.lit(0)).alias("_offset")), "offsets")
    joined = cut.join(sums, [*same(cut, sums), cut["_range"] == sums["_r"]], "left")
    return joined.withColumn("before", F.col("_inside") + F.col("_offset")).drop(
        *names.values(), "_ranges", "_range", "_inside", "_r", "_sum", "_offset"
    )


def bitmap(rows: DataFrame, keys: Column, bits: int) -> DataFrame:
    """A bitmap of the keys that occur more than once: at most bits / 64 rows, whatever the input."""
    often = rows.groupBy(keys.alias("key")).count().filter("count > 1")
    return slot_bitmap(often, F.col("key"), bits)


def slot_bitmap(rows: DataFrame, keys: Column, bits: int) -> DataFrame:
    """A bitmap of the keys: at most bits / 64 rows, whatever the input."""
    return rows.select(F.pmod(keys, F.lit(bits)).alias("slot")).groupBy(F.expr("shiftright(slot, 6)").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("bits")
    )


def in_bitmap(rows: DataFrame, keys: Column, marks: DataFrame, bits: int, name: str = "hit") -> DataFrame:
    """Add whether a row's key is in the bitmap; a few keys that occur once are too."""
    slotted = rows.withColumn("_slot", F.pmod(keys, F.lit(bits)))
    side = F.broadcast(marks.select(F.col("word").alias("_word"), F.col("bits").alias("_bits")))
    found = slotted.join(side, F.expr("shiftright(_slot, 6) = _word"), "left")
    hit = F.expr("coalesce(getbit(_bits, cast(_slot & 63 as int)), 0) = 1")
    return found.select(*rows.columns, hit.alias(name))


def without(rows: DataFrame, gone: DataFrame, id_col: str, bits: int = 1 << 22) -> DataFrame:
    """The rows whose id is not in ``gone`` (column ``id``); rows with a null id stay.

    Only rows that hit a bitmap of the ids, a fixed size, are shuffled to be compared.
    """
    key = F.xxhash64(F.col(id_col))
    marked = in_bitmap(rows, key, written(slot_bitmap(gone, F.xxhash64("id"), bits), "gone"), bits, "_hit")
    ids = gone.select(F.col("id").alias("_gone"))
    kept = marked.filter("_hit").join(ids, F.col(id_col) == F.col("_gone"), "left_anti")
    return marked.filter("NOT _hit").union(kept).select(*rows.columns)
