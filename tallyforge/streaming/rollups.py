"""Incremental rollups: rows of state per micro-batch, merged on read.

Layout below a rollup's folder:

* ``batches/batch_id=<n>/day=<d>``: the state rows of one micro-batch.  A
  replayed batch overwrites its own folder, so it counts once.
* ``finished/batch_id=<n>``: written after a batch's rows.  Readers take batches up to the last finished one,
  so they never see half a batch.
* ``compacted/upto=<n>/day=<d>``: the batches up to n of one day, merged.
* ``compactions``: (day, upto), appended after the merged rows are complete.
  A reader takes a day's rows from its newest logged compaction and from the
  later batches only; an interrupted compaction is not logged and not read.

Rows may be as late as they like: they are merged into their day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyforge.functions.rollup import Rollup
from tallyforge.operators.rollups import ROLLUPS
from tallyforge.schemas import request_schema
from tallyforge.sources.requests import read_or_empty

_LOG_DDL = "day date, upto bigint"


def _partial_rows(requests: DataFrame, rollup: Rollup) -> DataFrame:
    return rollup.state(requests).withColumn("day", F.expr(rollup.day))


def write_batch(requests: DataFrame, rollup: Rollup, out: str, batch_id: int) -> None:
    """The state rows of one micro-batch, then the note that they are complete; writing a batch again replaces it.

    REBALANCE sizes the files to the rows, whatever the number of shuffle
    partitions and however many rows fall on one day.
    """
    (
        _partial_rows(requests, rollup)
        .hint("rebalance", "day")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("day")
        .parquet(f"{out}/batches/batch_id={batch_id}")
    )
    done = requests.sparkSession.createDataFrame([(rollup.name,)], "rollup string")
    done.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{out}/finished/batch_id={batch_id}")


def finished_upto(spark: SparkSession, out: str) -> int:
    """The last batch whose rows are complete; -1 if there is none.  Batches are written one after the other."""
    last = read_or_empty(spark, f"{out}/finished", "rollup string, batch_id bigint").agg(F.max("batch_id")).first()[0]
    return -1 if last is None else last


def start_rollup(
    stream: DataFrame, name: str, out: str, checkpoint: str, available_now: bool = False, interval: str = "1 minute"
) -> StreamingQuery:
    """Keep the named rollup up to date from a stream of requests."""
    rollup, _ = ROLLUPS[name]
    spark = stream.sparkSession
    spark.createDataFrame([], _LOG_DDL).write.mode("ignore").parquet(f"{out}/compactions")

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, rollup, out, batch_id)

    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def _row_schema(spark: SparkSession, rollup: Rollup, part: str) -> T.StructType:
    """The columns of state rows, then those of the folders ``part=<n>/day=<d>``."""
    rows = _partial_rows(spark.createDataFrame([], request_schema()), rollup).drop("day").schema
    return T.StructType([*rows, T.StructField(part, T.LongType()), T.StructField("day", T.DateType())])


def _logged(spark: SparkSession, out: str) -> DataFrame:
    return read_or_empty(spark, f"{out}/compactions", _LOG_DDL).groupBy("day").agg(F.max("upto").alias("upto"))


def _live_rows(
    spark: SparkSession, rollup: Rollup, out: str, upto: int | None, days: tuple[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows of batches not yet compacted, rows of the newest compactions).

    The log, a row per compacted day, is read first, so that folders are chosen by
    constants on their partition columns and what is superseded is not even listed.
    """
    done: dict[int, list] = {}
    for row in _logged(spark, out).collect():
        done.setdefault(row.upto, []).append(row.day)

    def within(rows: DataFrame) -> DataFrame:
        if days is None:
            return rows
        first, last = (F.lit(day).cast("date") for day in days)
        return rows.where(F.col("day").between(first, last))

    batches = within(read_or_empty(spark, f"{out}/batches", _row_schema(spark, rollup, "batch_id")))
    merged = within(read_or_empty(spark, f"{out}/compacted", _row_schema(spark, rollup, "upto")))
    last = finished_upto(spark, out)
    batches = batches.where(F.col("batch_id") <= (last if upto is None else min(upto, last)))
    new = ~F.col("day").isin([day for group in done.values() for day in group]) if done else F.lit(True)
    newest = F.lit(False)
    for bound, group in sorted(done.items()):
        new |= F.col("day").isin(group) & (F.col("batch_id") > bound)
        newest |= F.col("day").isin(group) & (F.col("upto") == bound)
    return batches.where(new).drop("batch_id"), merged.where(newest).drop("upto")


def read_rollup(
    spark: SparkSession, out: str, name: str, upto: int | None = None, days: tuple[str, str] | None = None
) -> DataFrame:
    """S3: the merged state rows, of ``days`` (first, last) only if given.

    Batches that are being written are left out; ``upto`` leaves out later ones as well.
    """
    rollup, _ = ROLLUPS[name]
    fresh, merged = _live_rows(spark, rollup, out, upto, days)
    return rollup.merge(fresh.unionByName(merged))


def read_rollup_table(
    spark: SparkSession, out: str, name: str, upto: int | None = None, days: tuple[str, str] | None = None
) -> DataFrame:
    """The rollup's table as its batch function gives it."""
    rollup, shape = ROLLUPS[name]
    return shape(rollup.finish(read_rollup(spark, out, name, upto, days)))


def compact(spark: SparkSession, out: str, name: str, upto: int, day: str | None = None) -> None:
    """S3: merge the finished batches up to ``upto``, of one day or of all days that got rows.

    Days without new rows are not rewritten.  Each compaction writes a folder
    of its own and is logged last.
    """
    rollup, _ = ROLLUPS[name]
    upto = min(upto, finished_upto(spark, out))
    fresh, merged = _live_rows(spark, rollup, out, upto)
    if day is not None:
        fresh = fresh.where(F.col("day") == F.lit(day).cast("date"))
    touched = fresh.select("day").distinct()
    if touched.isEmpty():
        return
    rows = fresh.unionByName(merged.join(touched, "day", "left_semi"))
    target = f"{out}/compacted/upto={upto}"
    done = rollup.merge(rows).withColumn("day", F.expr(rollup.day))
    (
        done.hint("rebalance", "day")
        .sortWithinPartitions("day", *rollup.keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(target)
    )
    log = touched_days(spark, target, day).select("day", F.lit(upto).cast("bigint").alias("upto"))
    log.coalesce(1).write.mode("append").parquet(f"{out}/compactions")


def touched_days(spark: SparkSession, target: str, day: str | None) -> DataFrame:
    days = spark.read.parquet(target).select("day").distinct()
    return days if day is None else days.where(F.col("day") == F.lit(day).cast("date"))


def superseded(spark: SparkSession, out: str) -> DataFrame:
    """Folders no reader needs any more, to be deleted when no read is under way."""
    logged = _logged(spark, out)
    paths = []
    for folder, part, old in (("batches", "batch_id", "_part <= upto"), ("compacted", "upto", "_part < upto")):
        rows = read_or_empty(spark, f"{out}/{folder}", f"{part} bigint, day date").select(F.col(part).alias("_part"), "day").distinct()
        name = F.format_string(f"{out}/{folder}/{part}=%d/day=%s", F.col("_part"), F.col("day").cast("string"))
        paths.append(rows.join(logged, "day").where(old).select(name.alias("path")))
    return paths[0].unionByName(paths[1])


def clean_up(spark: SparkSession, out: str) -> int:
    """Delete what ``superseded`` lists; to be run when no reader started before the last compaction."""
    gone = 0
    for row in superseded(spark, out).toLocalIterator():
        path = spark._jvm.org.apache.hadoop.fs.Path(row.path)
        gone += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return gone
