"""The registered queries of this subpackage: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decompose, hamming, linededup, lm, packing, sharding, simhash, toxicity, variants, vectorgraph, whitening
from .common import table

#: the vocabulary file of the queries; the operators take it as a parameter
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.roundtrip_digests(table(spark, sf_dir, "documents"), VOCABULARY)


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "text", F.col("n_lines").cast("bigint"), F.col("n_removed").cast("bigint"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), VOCABULARY)


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorgraph.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest sign codes of every vector whose id is divisible by 20."""
    codes = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), hamming.sign_code("embedding").alias("code"))
    found = hamming.top_k(codes.filter("id % 20 = 0"), codes, 10)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "distance")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(toxicity.fold("doc_id", 3) == 1, F.lit(False)))
    learn = table(spark, sf_dir, "labels").filter(toxicity.fold("doc_id", 3) != 1)
    scored = toxicity.score(docs, toxicity.fit(docs, learn))
    return scored.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
                         F.col("threshold").alias("lang_threshold"), F.col("toxic").alias("over_lang_threshold"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"), shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "copies")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), toxicity.fold("doc_id", 7) == 2)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decompose.pack(table(spark, sf_dir, "documents"), WORD_VOCABULARY)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(table(spark, sf_dir, "documents"), slip=97)


QUERIES = {f.__name__: f for f in (
    op1_bpe_roundtrip, op2_chat_format, op3_line_dedup, op4_simhash, op5_best_fit_packing, op6_embedding_dedup, op7_exact_top_k,
    op8_toxicity, op9_sharding, op10_lm_score, op11_embedding_whitening, op12_packing, op13_spelling_variants)}
ORACLE: dict[str, str] = {"op2_chat_format": chat.sql("conversations"), "op3_line_dedup": linededup.sql("documents"),
                          "op7_exact_top_k": hamming.sql("embeddings"), "op13_spelling_variants": variants.sql("documents")}
