"""Mixing sources to target weights, with exact budgets and repeated epochs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import WORD, random_key, running_total, written


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """One row per source: ``source_size`` and ``target``.

    Sources in code point order, null last, take the weights in turn.  Shared are
    ``share`` times all sizes, by weight; no target passes ``most`` times its source, and the
    excess is shared again until none does.  That is one level for all sources below
    their limit: with the sources in the order of limit / weight, the level is the largest
    of (budget - limits before) / (weights not before).
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    ranked = totals.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(float(most)))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    left = F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    weights_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = F.max("level").over(everything)
    return (
        ranked.withColumn("level", left / weights_left)
        .withColumn("target", F.least(F.col("limit"), F.col("weight") * level))
        .select("source", "source_size", "target")
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Words that a mix takes from each document.

    Every document gets a random key from its id and ``seed``.  Within a source,
    documents are sorted by key in ranges, prefix sums of their sizes are taken over the
    ranges, and the source is cut at its target (see ``source_targets``), so a source gives
    its target rounded down to a whole word; the document at the cut gives its first words.  A target
    beyond the source takes all of it once or more, then cuts the next epoch.

    Returns one row per input row: id, source, ``size`` (words, 0 for a null text),
    ``source_size``, ``target``, ``taken`` (words, repeats counted), and the columns ``carry``, as a row key.  A null source is a source;
    null ids and repeated rows have equal keys and are taken one after the other; without words all
    targets are 0.  The table of sources, one row each, is ranked in one task.
    """
    sizes = written(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            *carry,
        ).withColumn("key", random_key(seed, "id")),
        "sizes",
    )
    targets = written(source_targets(sizes, weights, share, most).withColumnRenamed("source", "of"), "targets")
    placed = running_total(sizes, ["source"], "key", ["id", "size", *carry], "size")
    joined = placed.join(targets, placed["source"].eqNullSafe(targets["of"]), "left")
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size") - F.col("before")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return joined.select(
        F.col("id").alias(id_col),
        F.col("source").alias(source_col),
        "size",
        "source_size",
        "target",
        taken.cast("long").alias("taken"),
        *carry,
    )
