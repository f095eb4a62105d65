"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillpoint.functions.lineage import scratch_path
from tillpoint.llm import jaccard_join, line_dedup, mixing, packing, quality
from tillpoint.llm.common import read
from tillpoint.llm.queries import tokenizer


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality.good_documents(docs, read(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand earlier in the corpus."""
    return line_dedup.line_dedup(docs).drop("removed_lines")


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingles of five words with a similarity of 0.8."""
    return jaccard_join.one_of_each(docs, words=5, part=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the training sequences."""
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"), end_id=0, capacity=2048)


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", one_of_near_copies),
    ("mixing sources to target weights", mixed),
    ("best-fit packing", packed),
]

#: The draws of the mix and the tokenizer have no SQL counterpart; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
