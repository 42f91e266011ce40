"""Registered queries of the operators: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchcredit.llm import bpe, conversations, embed_dedup, extract, language, mixing, ngram_join, order_minhash, quality, suffix_tree, token_align, topk, warc
from touchcredit.llm.common import Workspace, fold, table

VOCABULARY = "byte_bpe_50k.tiktoken"


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source")


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64.0)


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=85)


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op3_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score_documents(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, ws = table(spark, sf_dir, "documents"), Workspace(spark, "quality")
    feats = ws.keep(docs.select("doc_id", fold("doc_id", 5).cast("int").alias("fold"), quality.features(F.col("text")).alias("features")),
                    "features")
    model = quality.fit(quality.labelled(feats, table(spark, sf_dir, "labels"), "quality"))
    scored = feats.select("doc_id", (F.col("fold") == 0).alias("held_out"), quality.score(F.col("features"), model).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"), min_bytes=100)


def op7_byte_bpe(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    import public_tokenizers

    ranks = bpe.read_ranks(vocabulary or public_tokenizers.path(VOCABULARY))
    return bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, keep_ids=False)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.filter(fold("doc_id", 5) != 0))
    return language.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "language.lang_pred", "language.score")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    definition = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8")
    model = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    return token_align.align(table(spark, sf_dir, "documents"), definition, model)


def op12_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.fingerprint_edits(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audit(conversations.damage(conversations.as_turns(table(spark, sf_dir, "conversations"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_exact_top_k": op2_exact_top_k,
    "op3_suffix_tree": op3_suffix_tree,
    "op4_quality": op4_quality,
    "op5_html_extraction": op5_html_extraction,
    "op6_warc": op6_warc,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_language_id": op10_language_id,
    "op11_token_alignment": op11_token_alignment,
    "op12_order_minhash": op12_order_minhash,
    "op13_conversation_repair": op13_conversation_repair,
}

OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, 3 * source_size AS cap,
         [1, 2, 3][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight FROM sums),
levels AS (
  SELECT *, (SELECT sum(source_size) FROM weighed)::BIGINT
            - coalesce(sum(cap) OVER w, 0)::BIGINT AS words_left,
         (SELECT sum(weight) FROM weighed)::BIGINT - coalesce(sum(weight) OVER w, 0)::BIGINT AS weight_left
  FROM weighed
  WINDOW w AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
water AS (
  SELECT max(words_left::DOUBLE / weight_left::DOUBLE)
           FILTER (WHERE words_left::DOUBLE / weight_left::DOUBLE * weight <= cap) AS level FROM levels),
quota AS (
  SELECT source, source_size, least(level * weight, cap::DOUBLE) AS target FROM levels, water),
placed AS (
  SELECT doc_id, source, size, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size
                                               ROWS UNBOUNDED PRECEDING)::BIGINT - size AS start
  FROM sized)
SELECT doc_id, size, source_size, target, placed.source AS source,
       CASE WHEN source_size = 0 THEN 0
            ELSE (floor(target)::BIGINT // source_size) * size
                 + greatest(0, least(start + size, floor(target)::BIGINT % source_size) - start) END::BIGINT AS taken
FROM placed JOIN quota ON placed.source IS NOT DISTINCT FROM quota.source
"""

OP2_SQL = """
WITH v AS (
  SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 20 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT query_id, vec_id, score,
         (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank FROM scored)
WHERE rank <= 20
"""

ORACLE_SQL: dict[str, str] = {"op1_mix_sources": OP1_SQL, "op2_exact_top_k": OP2_SQL}
