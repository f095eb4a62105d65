"""Queries of this subpackage on the given tables; their SQL counterparts are in ``oracles``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpoint.llm import (
    chat, decontamination, exact_dedup, hard_negatives, jaccard_join, line_dedup, mixing, packing, quality, token_counts, token_files, topk,
    value_codes)
from tillpoint.llm.common import read
from tillpoint.llm.oracles import ORACLES  # noqa: F401  registered with the queries

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    found = topk.top_products(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5, scale=256.0)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_files.token_files(read(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), end_id=2)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(read(spark, sf_dir, "documents")).select("doc_id", "text", "removed_lines")


def op6_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The former name of what ``op6_line_dedup`` returns now."""
    return op6_line_dedup(spark, sf_dir)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), end_id=0, capacity=2048)


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(said).alias("text"))
    return chat.digests(chat.format_chats(given.unionByName(more)))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_groups(read(spark, sf_dir, "documents"), words=3, part=90)


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), size=10)
    items = F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", items, "contaminated")


def op12_value_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, books = value_codes.vector_codes(read(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2, scale=256.0)
    return found.select("vec_id", "code", "error", "label_error", F.lit(value_codes.digest(books)).alias("codebooks_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label, positives=5, negatives=5)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_topk, op2_token_files, op3_mixing, op4_token_counts, op5_exact_dedup, op6_line_dedup, op6_passage_dedup, op7_packing, op8_chat,
    op9_quality, op10_jaccard_join, op11_decontamination, op12_value_codes,
    op13_hard_negatives)}
