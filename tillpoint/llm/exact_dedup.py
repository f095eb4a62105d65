"""Exact deduplication by skew-safe combining, in DataFrame operations only.

Copies are combined three times, each time by their whole text and not by its digest alone: within each input task (the
partial aggregation), within each of ``salts`` groups of a digest, and across the salt groups of a digest, of which
there are at most ``salts``. A group of any size is thus never gathered in one task. The rows then look up their
group by digest, with narrow rows; should two texts ever share a digest, the rows of that digest look it up by text.

Texts are equal when identical after lower-casing A-Z. A null text counts as empty. Of equal texts the row with the
largest ``doc_id`` stays; rows that repeat this id are all marked kept, and a group without any id keeps none (null
``keep_id``, every row kept). An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import LOWER, UPPER, staged, text_of


def digest_of(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_groups(rows: DataFrame, digest: Callable[[Column], Column] = digest_of, salts: int = 32) -> DataFrame:
    """Groups of equal texts of ``rows`` (doc_id, text): doc_id, keep_id, group_size, digest for every row."""
    keyed = rows.select("doc_id", "text").withColumn("digest", digest(F.col("text")))
    salted = (keyed.groupBy("digest", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt"), "text")
              .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n")))
    whole = (salted.repartition("digest").groupBy("digest", "text")
             .agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size")))
    groups = staged(whole.groupBy("digest").agg(F.max("keep_id").alias("keep_id"),
                                                F.max("group_size").alias("group_size"),
                                                F.count("*").alias("texts")), "digest-groups")
    clashes = groups.filter("texts > 1").select("digest")
    found = keyed.drop("text").join(groups.filter("texts = 1").drop("texts"), "digest")
    if not clashes.isEmpty():
        found = found.unionByName(keyed.join(whole.join(clashes, "digest"), ["digest", "text"]).drop("text"))
    return found


def exact_dedup(docs: DataFrame, digest: Callable[[Column], Column] = digest_of, salts: int = 32) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row of ``docs`` (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.translate(text_of(), UPPER, LOWER).alias("text"))
    found = exact_groups(rows, digest, salts)
    kept = F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull())
    return found.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.col("digest").alias("text_sha256"))
