"""Product pairs bought together."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BLOCK = 1_000


def _frequent_only(lines: DataFrame, minimum: int) -> DataFrame:
    """Drop products that cannot reach the minimum in any pair.

    With each basket holding a product once, a pair's count never exceeds either product's
    count, so this is exact and shrinks the baskets before pairs are formed.
    """
    frequent = lines.groupBy("ProductID").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= minimum)
    return lines.join(frequent.select("ProductID"), "ProductID", "left_semi")


def _pairs(items: DataFrame, weight: str | None, block: int) -> DataFrame:
    """Unordered pairs within each basket, summed.

    ``items`` has one row per (basket, product). A basket of more than ``block`` lines is split:
    its left side goes to one of several parts by product, its right side to all of them. Every
    pair is formed exactly once and no task holds the whole basket squared. The table of large
    baskets has at most lines / block rows. All three readers of ``items`` share its shuffle.
    """
    lines = F.sum(weight) if weight else F.count(F.lit(1))
    large = items.groupBy("TransactionID").agg(lines.alias("_size")).filter(F.col("_size") > block)
    large = large.select("TransactionID", F.ceil(F.col("_size") / block).cast("int").alias("_parts"))
    kept = items.join(large, "TransactionID", "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))
    count = F.col(weight) if weight else F.lit(1).cast("bigint")
    left = kept.select("TransactionID", F.col("ProductID").alias("Product1"), count.alias("_n1"),
                       F.pmod(F.xxhash64("ProductID"), F.col("_parts")).cast("int").alias("_part"))
    right = kept.select("TransactionID", F.col("ProductID").alias("Product2"), count.alias("_n2"),
                        F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"))
    joined = left.join(right, ["TransactionID", "_part"]).filter(F.col("Product1") < F.col("Product2"))
    return joined.groupBy("Product1", "Product2").agg(F.sum(F.col("_n1") * F.col("_n2")).alias("CoOccurrence"))


def _named(pairs: DataFrame, products: DataFrame) -> DataFrame:
    first = products.select(F.col("ProductID").alias("Product1"), F.col("ProductName").alias("Product1Name"))
    second = products.select(F.col("ProductID").alias("Product2"), F.col("ProductName").alias("Product2Name"))
    return pairs.join(first, "Product1", "left").join(second, "Product2", "left")


def line_pairs(transactions: DataFrame, products: DataFrame, min_cooccurrence: int = 10, block: int = BLOCK) -> DataFrame:
    """Pair counts over lines: a product on two lines of a basket counts twice.

    Repeated lines are folded to (basket, product, lines) and the pair weight is the product of
    both line counts, so the line-by-line self-join never takes place.
    """
    items = transactions.filter("TransactionID is not null and ProductID is not null").groupBy(
        "TransactionID", "ProductID").agg(F.count(F.lit(1)).alias("_lines"))
    pairs = _pairs(items, "_lines", block).filter(F.col("CoOccurrence") >= min_cooccurrence)
    names = products.select("ProductID", "ProductName")
    return (
        pairs.join(names.withColumnRenamed("ProductName", "Product1Name"), F.col("Product1") == F.col("ProductID")).drop("ProductID")
        .join(names.withColumnRenamed("ProductName", "Product2Name"), F.col("Product2") == F.col("ProductID")).drop("ProductID")
        .select(F.col("Product1").alias("Product1ID"), F.col("Product2").alias("Product2ID"),
                F.col("Product1Name").alias("Product1"), F.col("Product2Name").alias("Product2"), "CoOccurrence")
        .orderBy(F.desc("CoOccurrence"), "Product1ID", "Product2ID")
    )


def calculate_cross_sell_opportunities(transactions: DataFrame, products: DataFrame, min_cooccurrence: int = 10,
                                       block: int = BLOCK) -> DataFrame:
    """Pairs of distinct products per transaction, at least ``min_cooccurrence`` transactions."""
    items = transactions.filter("TransactionID is not null and ProductID is not null").select(
        "TransactionID", "ProductID").distinct()
    pairs = _pairs(_frequent_only(items, min_cooccurrence), None, block).filter(F.col("CoOccurrence") >= min_cooccurrence)
    return _named(pairs, products).select(
        "Product1", "Product2", "CoOccurrence", "Product1Name", "Product2Name"
    ).orderBy(F.desc("CoOccurrence"), "Product1", "Product2")
