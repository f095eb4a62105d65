"""Warehouse reports: customer value, RFM, products, categories, baskets, daily and segment summaries.

Facts are reduced before they meet a dimension, so a hot product or customer is folded by
partial aggregation and only one row per key takes part in the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillpoint.functions.lineage import stage
from tillpoint.functions.ordered import ntile, ranks
from tillpoint.functions.stats import as_of, days_between, mean, ratio


# --- customers -----------------------------------------------------------------

def customer_lifetime_value(customers: DataFrame, transactions: DataFrame, reference_date=None) -> DataFrame:
    """Spend and activity per customer; customers without purchases stay, with count 0. Counts distinct days."""
    ref = as_of(transactions, reference_date)
    spent = transactions.groupBy("CustomerID").agg(
        F.countDistinct("TransactionDate").alias("TotalTransactions"),
        F.sum("LineTotal").alias("TotalSpent"),
        mean(F.col("LineTotal")).alias("AvgTransactionValue"),
        F.max("TransactionDate").alias("LastPurchaseDate"),
        F.min("TransactionDate").alias("FirstPurchaseDate"),
    )
    return customers.select("CustomerID", "FirstName", "LastName", "EnrollmentDate").join(
        spent, "CustomerID", "left"
    ).select(
        "CustomerID", "FirstName", "LastName", "EnrollmentDate",
        F.coalesce("TotalTransactions", F.lit(0)).alias("TotalTransactions"),
        "TotalSpent", "AvgTransactionValue", "LastPurchaseDate", "FirstPurchaseDate",
        days_between(F.col("LastPurchaseDate"), ref).alias("DaysSinceLastPurchase"),
        days_between(F.col("FirstPurchaseDate"), F.col("LastPurchaseDate")).alias("CustomerLifespanDays"),
    )


def rfm_base(transactions: DataFrame, reference_date=None) -> DataFrame:
    """Recency in days, distinct purchase days and spend per customer."""
    ref = as_of(transactions, reference_date)
    base = transactions.groupBy("CustomerID").agg(
        F.max("TransactionDate").alias("LastPurchaseDate"),
        F.countDistinct("TransactionDate").alias("Frequency"),
        F.sum("LineTotal").alias("Monetary"),
    )
    return base.select("CustomerID", "LastPurchaseDate",
                       days_between(F.col("LastPurchaseDate"), ref).alias("Recency"), "Frequency", "Monetary")


def combined_score(r: Column, f: Column, m: Column) -> Column:
    return r * 100 + f * 10 + m


def rfm_scores(transactions: DataFrame, reference_date=None, limit: int | None = None) -> DataFrame:
    """NTILE(5) scores over all customers; CustomerID decides ties."""
    base = stage(rfm_base(transactions, reference_date).drop("LastPurchaseDate"))
    size = base.count()
    metrics = {"RecencyScore": -F.col("Recency"), "FrequencyScore": F.col("Frequency"), "MonetaryScore": F.col("Monetary")}
    placed = ranks(base, "CustomerID", metrics, size, limit)
    scores = placed.select(F.col("CustomerID").alias("_of"), *[ntile(F.col(c), size).alias(c) for c in metrics])
    combined = combined_score(*[F.col(c) for c in metrics]).alias("RFMScore")
    return base.join(scores, F.col("CustomerID").eqNullSafe(F.col("_of"))).select(*base.columns, *metrics, combined)


# Customer segments, first match wins (R days, F distinct days, M spend).
def rule_segment(r: Column, f: Column, m: Column) -> Column:
    return (
        F.when((r <= 30) & (f >= 20) & (m >= 5000), "Champions")
        .when((r <= 60) & (f >= 10) & (m >= 2000), "Loyal Customers")
        .when((r <= 90) & (f >= 5), "Potential Loyalists")
        .when((r <= 30) & (f <= 5), "New Customers")
        .when((r > 90) & (f >= 10), "At Risk")
        .when(r > 180, "Lost")
        .otherwise("Need Attention")
    )


def customer_segments(transactions: DataFrame, reference_date=None, spend_unit: int = 1) -> DataFrame:
    """Customers per rule segment. ``spend_unit`` divides spend before the thresholds apply."""
    base = rfm_base(transactions, reference_date)
    named = base.withColumn("Segment", rule_segment(F.col("Recency"), F.col("Frequency"), F.col("Monetary") / spend_unit))
    return named.groupBy("Segment").agg(
        F.count(F.lit(1)).alias("CustomerCount"),
        mean(F.col("Recency")).alias("AvgRecency"),
        mean(F.col("Frequency")).alias("AvgFrequency"),
        mean(F.col("Monetary")).alias("AvgMonetary"),
    )


# --- products and categories -----------------------------------------------------

def top_products(transactions: DataFrame, products: DataFrame) -> DataFrame:
    """Sales per product, best revenue first."""
    sold = transactions.groupBy("ProductID").agg(
        F.countDistinct("TransactionID").alias("TransactionCount"),
        F.sum("Quantity").alias("TotalUnitsSold"),
        F.sum("LineTotal").alias("TotalRevenue"),
        mean(F.col("UnitPrice")).alias("AvgPrice"),
        mean(F.col("Quantity")).alias("AvgQuantityPerTransaction"),
    )
    return products.select("ProductID", "ProductName", "Category").join(sold, "ProductID").orderBy(
        F.desc("TotalRevenue"), "ProductID")


def _category_sales(transactions: DataFrame, products: DataFrame, distinct: dict[str, str]) -> DataFrame:
    """Sums and distinct counts per category, from one pass over the lines.

    Lines that agree in what is counted are combined in each task, so a category shared by most lines is spread
    over (category, value) pairs before they are counted.
    """
    lines = transactions.select("ProductID", "Quantity", "LineTotal", *distinct)
    sold = lines.join(products.select("ProductID", "Category"), "ProductID")
    return sold.groupBy("Category").agg(
        F.countDistinct("ProductID").alias("ProductCount"),
        F.sum("Quantity").alias("TotalUnitsSold"),
        F.sum("LineTotal").alias("TotalRevenue"),
        ratio(F.sum("LineTotal"), F.count("LineTotal")).alias("AvgTransactionValue"),
        *[F.countDistinct(column).alias(name) for column, name in distinct.items()],
    )


def category_performance(transactions: DataFrame, products: DataFrame) -> DataFrame:
    sales = _category_sales(transactions, products, {"TransactionID": "TransactionCount"})
    return sales.select("Category", "ProductCount", "TransactionCount", "TotalUnitsSold", "TotalRevenue",
                        "AvgTransactionValue").orderBy(F.desc("TotalRevenue"), "Category")


def category_summary(transactions: DataFrame, products: DataFrame) -> DataFrame:
    sales = _category_sales(transactions, products, {"TransactionID": "TransactionCount", "CustomerID": "UniqueCustomers"})
    return sales.select("Category", "TransactionCount", "UniqueCustomers", "TotalUnitsSold", "TotalRevenue",
                        "AvgTransactionValue", "ProductCount")


def monthly_product_sales(transactions: DataFrame, products: DataFrame) -> DataFrame:
    """Units and revenue per month and product; newest month first, best revenue first."""
    sold = transactions.groupBy(
        F.year("TransactionDate").alias("Year"), F.month("TransactionDate").alias("Month"), "ProductID"
    ).agg(F.sum("Quantity").alias("UnitsSold"), F.sum("LineTotal").alias("Revenue"))
    named = sold.join(products.select("ProductID", "ProductName", "Category"), "ProductID")
    return named.select("Year", "Month", "ProductID", "ProductName", "Category", "UnitsSold", "Revenue").orderBy(
        F.desc("Year"), F.desc("Month"), F.desc("Revenue"), "ProductID")


def daily_summary(transactions: DataFrame) -> DataFrame:
    """Distinct transactions, customers and products, and sales, per day, from one pass over the lines.

    Each line gives one (day, value) pair to each distinct count; pairs are deduplicated before they are counted,
    so a busy day spreads over many tasks.
    """
    return transactions.groupBy(F.to_date("TransactionDate").alias("TransactionDate")).agg(
        F.countDistinct("TransactionID").alias("TransactionCount"),
        F.countDistinct("CustomerID").alias("UniqueCustomers"),
        F.countDistinct("ProductID").alias("UniqueProducts"),
        F.sum("Quantity").alias("TotalQuantity"),
        F.sum("LineTotal").alias("TotalRevenue"),
        mean(F.col("LineTotal")).alias("AvgTransactionValue"),
    )
