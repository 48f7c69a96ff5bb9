"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import bitmap, fold_case, in_bitmap, written


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    prefix: int = 64,
    filter_bits: int = 1 << 22,
    digest: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Group equal texts and keep the row with the largest id of each group.

    Texts are equal when identical after lower-casing A-Z.  Three refinements:
    rows whose length in bytes recurs; of these, rows whose (length, hash of the
    first ``prefix`` characters) recurs; of these, rows whose SHA-256 recurs.  What
    recurs goes to the next scan as a bitmap of ``filter_bits`` bits, a fixed size, so
    no text is shuffled.  A full bitmap lets more rows pass; the result is the same.

    Returns one row per input row: id, ``keep_id``, ``group_size`` (rows), ``kept``, the columns ``carry``, as a row key, and
    ``text_sha256`` of the folded text: with ``digest`` of each row, else null where two
    stages told that the text is single.  A null text counts as empty; a null id stays
    only in a group without other ids.  Repeated rows of one id and text count each in
    ``group_size`` and are all marked as the id is.  No other column is read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"), *carry)
    length = F.xxhash64(F.octet_length("body"))
    head = F.xxhash64(F.octet_length("body"), fold_case(F.substring("body", 1, prefix)))
    full = F.sha2(fold_case(F.col("body")), 256)

    lengths = written(bitmap(rows, length, filter_bits), "lengths")
    same_length = in_bitmap(rows, length, lengths, filter_bits)
    heads = written(bitmap(same_length.filter("hit"), head, filter_bits), "heads")
    same_head = in_bitmap(same_length.filter("hit"), head, heads, filter_bits, "hit_head")
    survivors = same_head.filter("hit_head")
    groups = written(
        survivors.groupBy(full.alias("sha"))
        .agg(F.count("*").alias("group_size"), F.max("id").alias("keep_id"))
        .filter("group_size > 1"),
        "groups",
    )

    if digest:
        hashed = rows.select("id", full.alias("sha"), *carry)
    else:
        both = in_bitmap(same_length, head, heads, filter_bits, "hit_head")
        hashed = both.select("id", F.when(F.expr("hit AND hit_head"), full).alias("sha"), *carry)
    # a row that is single joins on a key of its own, so that such rows do not meet in one task
    keyed = hashed.withColumn("key", F.coalesce("sha", F.concat(F.lit("id "), F.coalesce(F.col("id").cast("string"), F.lit("")))))
    found = keyed.join(groups.withColumnRenamed("sha", "key"), "key", "left")
    grouped = F.col("group_size").isNotNull()
    keep = F.when(grouped, F.col("keep_id")).otherwise(F.col("id"))
    return found.select(
        F.col("id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"),
        F.col("sha").alias("text_sha256"),
        *carry,
    )
