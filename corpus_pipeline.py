"""Five stages from raw documents to packed sequences."""

from __future__ import annotations

import re

import pandas as pd
import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.llm.common import WORD, remainder, table, without, written
from tallyforge.llm.exact_dedup import exact_dedup
from tallyforge.llm.mixing import mix_sources
from tallyforge.llm.packing import pack_documents
from tallyforge.llm.quality import score_quality
from tallyforge.llm.shingle_join import link_texts


ROW = "_row_key"


def keyed(docs: DataFrame) -> DataFrame:
    """The rows with a key of their own, the same whenever they are read.

    Rows of files are keyed by their places in them, so nothing is copied; other rows are written with a key.
    """
    try:
        placed = docs.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_place"))
    except AnalysisException:  # not from files
        placed = None
    if placed is not None and not {"_file", "_place"} & set(docs.columns):
        number = F.row_number().over(Window.orderBy("_file")).cast("long").alias("_number")
        files = written(placed.select("_file").distinct().select(F.col("_file").alias("_name"), number), "files")
        rows = placed.join(F.broadcast(files), F.col("_file") == F.col("_name"))
        rows = rows.select(*[F.col(f"`{c}`") for c in docs.columns], F.expr("shiftleft(_number, 40) + _place").alias(ROW))
        if not rows.groupBy(ROW).count().filter("count > 1").head(1):  # a join before this may repeat rows of a file
            return rows
    return written(docs.withColumn(ROW, F.monotonically_increasing_id()), "keyed")


def left_over(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``keyed`` whose key is not in ``gone`` (column ``id``), as they came."""
    names = [c for c in rows.columns if c != ROW]
    plain = rows.select(ROW, *names).toDF("key", *[f"c{i}" for i in range(len(names))])
    return without(plain, gone, "key").drop("key").toDF(*names)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a quality score of 0.7 or more, learned as in op1.

    Each row is judged by its own text, whether its id is null or repeated; null and empty texts are scored like others.
    """
    rows = keyed(docs)
    scores = score_quality(rows, table(spark, sf_dir, "labels"), remainder("doc_id", 4) != 2, carry=[ROW])
    return left_over(rows, scores.filter("score < 0.7").select(F.col(ROW).alias("id")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id: one row, also where it is repeated or all ids are null.

    A null text equals an empty one.
    """
    rows = keyed(docs)
    found = written(exact_dedup(rows, carry=[ROW]).filter("group_size > 1").select("kept", "text_sha256", ROW), "groups")
    stays = found.filter("kept").groupBy("text_sha256").agg(F.min(ROW).alias("stays"))
    return left_over(rows, found.join(stays, "text_sha256").filter(F.col(ROW) != F.col("stays")).select(F.col(ROW).alias("id")))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked texts, the row with the smallest id; a null id stays only where there is no other.

    Rows are linked by their own keys, so ids may be null or repeated.  Texts without words link with nothing and stay.
    """
    rows = keyed(docs)
    links = link_texts(rows, id_col=ROW).select(F.col(ROW).alias("id"), "component_id")
    ids = rows.select(F.col(ROW).alias("of"), F.col("doc_id"))
    several = links.groupBy("component_id").count().filter("count > 1").select("component_id")
    groups = written(links.join(several, "component_id").join(ids, F.col("id") == F.col("of")).drop("of"), "groups")
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("id"))).alias("first")
    stays = groups.groupBy("component_id").agg(first).select("component_id", F.col("first.id").alias("stays"))
    return left_over(rows, groups.join(stays, "component_id").filter("id <> stays").select("id"))


@F.pandas_udf(T.StringType())
def first_words(text: pd.Series, words: pd.Series) -> pd.Series:
    """The text up to the end of its word number ``words``; null where there is nothing to cut."""

    def cut(t: str, n: int) -> str:
        for i, found in enumerate(re.finditer(WORD, t), 1):
            if i == n:
                return t[: found.end()]
        return t

    return pd.Series([None if t is None else cut(t, int(n)) for t, n in zip(text, words, strict=True)], dtype=object)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; where a source's budget ends, its first words; without words none.

    Ids may be null or repeated: each row has a key of its own, written with it, and its own take.
    """
    rows = keyed(docs)
    taken = mix_sources(rows, carry=[ROW]).select(F.col(ROW).alias("of"), "size", "taken").filter("taken > 0")
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    plain = rows.select(F.col(ROW).alias("key"), *[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    epoch = F.explode(F.expr("sequence(1, cast(ceil(taken / size) as int))"))
    plain = plain.join(taken, F.col("key") == F.col("of")).withColumn("epoch", epoch)
    plain = plain.withColumn("words", F.least(F.col("size"), F.expr("taken - (epoch - 1) * size")))
    part, body = F.col("words") < F.col("size"), F.col(names["text"])
    text = F.coalesce(first_words(F.when(part, body), F.col("words")), body)
    plain = plain.withColumn(names["text"], text)
    if "n_chars" in names:
        plain = plain.withColumn(names["n_chars"], F.when(part, F.length(body).cast("long")).otherwise(F.col(names["n_chars"])))
    return plain.select(*[F.col(n).alias(c) for c, n in names.items()])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens; every row has its own, whatever its id, a null text that of an empty one."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("n-gram Jaccard join", near), ("mixing", mix), ("packing", pack)]

#: Models, shingle hashes and tokenizers can't be put in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other over ``documents``; between them, rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = written(docs, f"stage{number}")
    return docs
