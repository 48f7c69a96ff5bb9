"""One query for each operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.common import remainder, table
from tallyforge.llm.conversations import damage, repair_conversations
from tallyforge.llm.embeddings import near_duplicate_vectors
from tallyforge.llm.exact_dedup import exact_dedup
from tallyforge.llm.hard_negatives import hard_negatives
from tallyforge.llm.language import identify_language
from tallyforge.llm.mixing import mix_sources
from tallyforge.llm.packing import pack_documents
from tallyforge.llm.quality import score_quality
from tallyforge.llm.repair import read_tokens, write_tokens
from tallyforge.llm.sharding import shard_documents
from tallyforge.llm.shingle_join import link_texts
from tallyforge.llm.toxicity import score_toxicity
from tallyforge.llm.warc import read_archives, write_archives

Query = Callable[[SparkSession, str], DataFrame]


THRESHOLD = 0.7


def _judged(scores: DataFrame, modulus: int, held: int) -> DataFrame:
    """The scores with the fold of each document and the decision at THRESHOLD."""
    fold = F.coalesce(remainder("doc_id", modulus) == held, F.lit(False))
    return scores.select("doc_id", fold.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return _judged(score_quality(docs, labels, remainder("doc_id", 4) != 2), 4, 2)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify_language(table(spark, sf_dir, "documents"), remainder("doc_id", 4) != 2)
    fold = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    return found.select("doc_id", fold.alias("held_out"), "lang_pred", "score")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_archives(write_archives(table(spark, sf_dir, "pages")))


OP3_SQL = """
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS digest FROM pages
), latest AS (
  SELECT *, max(page_id) OVER (PARTITION BY digest) AS latest FROM hashed
)
SELECT page_id, payload_bytes,
       list_aggregate(flatten(list_transform(range(8), lambda g: list_transform([32768, 1024, 32, 1], lambda unit:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                CAST((CAST('0x' || substr(digest, CAST(1 + 5 * g AS INTEGER), 5) AS BIGINT) // unit) % 32 + 1 AS INTEGER), 1)
       ))), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = latest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> latest THEN latest END AS refers_to
FROM latest
"""


def op4_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_texts(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), digest=True)


OP5_SQL = """
WITH hashed AS (
  SELECT doc_id,
         sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM hashed
"""


def op6_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return read_tokens(manifest).withColumnRenamed("id", "doc_id")


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).drop("source")


OP7_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix:' || doc_id), 1, 15) AS BIGINT) AS key
  FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (CAST([3, 1, 2] AS DOUBLE[]))[(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sizes GROUP BY source
), levels AS (
  SELECT *,
         (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(source_size * 2.0::DOUBLE) OVER before, 0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM totals
  WINDOW before AS (ORDER BY source_size * 2.0::DOUBLE / weight, encode(source) NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size, least(source_size * 2.0::DOUBLE, weight * max(level) OVER ()) AS target FROM levels
), placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), epochs AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epoch FROM placed
)
SELECT doc_id, size, source_size, target,
       CAST(epoch * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - epoch * source_size - before)) AS BIGINT) AS taken
FROM epochs
"""


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return _judged(score_toxicity(docs, labels, remainder("doc_id", 3) != 1), 3, 1)


def op10_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


OP11_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER w <= 10
"""


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(table(spark, sf_dir, "documents"), shards=8)
    digest = F.crc32(F.encode(F.coalesce("doc.text", F.lit("")), "UTF-8")).alias("text_crc32")
    no_shard = F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc.doc_id", "size", digest, F.lit("bytes").alias("law"), "shard", "slot", no_shard)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damage(table(spark, sf_dir, "conversations")), live=F.col("live"))


QUERIES: dict[str, Query] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_language_id": op2_language_id,
    "op3_warc": op3_warc,
    "op4_shingle_join": op4_shingle_join,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_token_shards": op6_token_shards,
    "op7_mix_sources": op7_mix_sources,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_pack_documents": op10_pack_documents,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_sharding": op12_sharding,
    "op13_conversation_repair": op13_conversation_repair,
}

SQL: dict[str, str] = {"op3_warc": OP3_SQL, "op5_exact_dedup": OP5_SQL, "op7_mix_sources": OP7_SQL, "op11_hard_negatives": OP11_SQL}
