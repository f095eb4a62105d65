"""Product features: performance, categories, trends, affinity and their matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillpoint.functions.lineage import stage
from tillpoint.functions.stats import as_of, days_between, mean, number, ratio, zero_filled
from tillpoint.operators.customer_features import growth, trend_direction
from tillpoint.schemas import HISTORY_DAYS, RECENT_DAYS

DETAILS = ["ProductID", "ProductName", "Category", "Price", "Cost"]


def _sales(transactions: DataFrame) -> DataFrame:
    return transactions.filter("ProductID is not null").groupBy("ProductID").agg(
        F.count("TransactionID").alias("TransactionCount"),
        F.coalesce(F.sum("Quantity"), F.lit(0)).alias("TotalUnitsSold"),
        mean(F.col("Quantity")).alias("AvgQuantityPerTransaction"),
        F.sum("LineTotal").alias("TotalRevenue"),
        mean(F.col("LineTotal")).alias("AvgRevenuePerTransaction"),
        F.min("TransactionDate").alias("FirstSaleDate"),
        F.max("TransactionDate").alias("LastSaleDate"),
    )


def calculate_product_performance(transactions: DataFrame, products: DataFrame, reference_date=None) -> DataFrame:
    """Sales, margin, profit and velocity per sold product. Sales are reduced before the product join."""
    ref = as_of(transactions, reference_date)
    sold = _sales(transactions).join(products.select(*DETAILS), "ProductID", "left")
    age = days_between(F.col("FirstSaleDate"), ref)
    return sold.select(
        "*",
        F.coalesce(ratio(F.col("TotalRevenue"), F.col("TotalUnitsSold")), number(F.col("Price"))).alias("RevenuePerUnit"),
        F.coalesce(ratio(F.col("Price") - F.col("Cost"), F.col("Price")), F.lit(0.0)).alias("ProfitMargin"),
        (F.col("TotalRevenue") - F.col("Cost") * F.col("TotalUnitsSold")).alias("TotalProfit"),
        age.alias("ProductAge"),
    ).withColumn("SalesVelocity", ratio(F.col("TotalUnitsSold"), F.greatest(F.col("ProductAge"), F.lit(1))))


def calculate_category_performance(transactions: DataFrame, products: DataFrame) -> DataFrame:
    """Sales, reach and revenue share per category, best revenue first."""
    per_product = transactions.groupBy("ProductID").agg(
        F.count("TransactionID").alias("_lines"), F.sum("Quantity").alias("_units"),
        F.sum("LineTotal").alias("_revenue"), F.count("LineTotal").alias("_priced"))
    named = per_product.join(products.select("ProductID", "Category"), "ProductID", "left")
    sums = named.groupBy("Category").agg(
        F.sum("_lines").alias("TransactionCount"),
        F.count("ProductID").alias("UniqueProducts"),
        F.sum("_units").alias("TotalUnitsSold"),
        F.sum("_revenue").alias("TotalRevenue"),
        ratio(F.sum("_revenue"), F.sum("_priced")).alias("AvgTransactionValue"),
    ).filter("Category is not null")
    buyers = transactions.select("CustomerID", "ProductID").distinct().join(
        products.select("ProductID", "Category"), "ProductID").groupBy("Category").agg(
        F.countDistinct("CustomerID").alias("UniqueCustomers"))
    whole = sums.agg(F.sum("TotalRevenue").alias("t")).scalar()
    return sums.join(buyers, "Category").select(
        "Category", "TransactionCount", "UniqueCustomers", "UniqueProducts", "TotalUnitsSold", "TotalRevenue",
        "AvgTransactionValue",
        ratio(F.col("TotalRevenue"), F.col("UniqueCustomers")).alias("RevenuePerCustomer"),
        ratio(F.col("TotalRevenue"), F.col("UniqueProducts")).alias("RevenuePerProduct"),
        ratio(F.col("TotalRevenue"), whole).alias("RevenueShare"),
    ).orderBy(F.desc("TotalRevenue"), "Category")


# Columns of the product trend table, in order.
PRODUCT_TREND_COLUMNS = ["ProductID", "RecentUnitsSold", "RecentRevenue", "HistoricalUnitsSold", "HistoricalRevenue",
                         "UnitsGrowthRate", "RevenueGrowthRate", "TrendDirection"]


def calculate_product_trends(transactions: DataFrame, products: DataFrame, reference_date=None) -> DataFrame:
    """Last 90 days against the 90 before, for products sold in the last 180. ``products`` is not read."""
    ref = as_of(transactions, reference_date)
    day = F.col("TransactionDate")
    recent = day >= F.date_sub(ref, RECENT_DAYS)
    window = transactions.filter(day >= F.date_sub(ref, HISTORY_DAYS)).filter("ProductID is not null")
    sums = zero_filled(window.groupBy("ProductID").agg(
        F.sum(F.when(recent, F.col("Quantity"))).alias("RecentUnitsSold"),
        F.sum(F.when(recent, F.col("LineTotal"))).alias("RecentRevenue"),
        F.sum(F.when(~recent, F.col("Quantity"))).alias("HistoricalUnitsSold"),
        F.sum(F.when(~recent, F.col("LineTotal"))).alias("HistoricalRevenue"),
    ), PRODUCT_TREND_COLUMNS[1:5])
    return sums.withColumn(
        "UnitsGrowthRate", growth(F.col("RecentUnitsSold"), F.col("HistoricalUnitsSold"))
    ).withColumn(
        "RevenueGrowthRate", growth(F.col("RecentRevenue"), F.col("HistoricalRevenue"))
    ).withColumn("TrendDirection", trend_direction(F.col("RevenueGrowthRate"), "growing", "declining")).select(
        *PRODUCT_TREND_COLUMNS)


# Weights of the affinity score.
RECENCY_WEIGHT, FREQUENCY_WEIGHT, MONETARY_WEIGHT = 0.3, 0.4, 0.3


def calculate_customer_product_affinity(transactions: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Affinity of each (customer, product) pair, scaled by the largest value over all pairs.

    The pairs are reduced once and staged; their maxima are a scalar subquery over the staged pairs.
    """
    pairs = stage(transactions.filter("CustomerID is not null and ProductID is not null").groupBy("CustomerID", "ProductID").agg(
        F.count("TransactionID").alias("PurchaseCount"),
        F.coalesce(F.sum("Quantity"), F.lit(0)).alias("TotalQuantity"),
        F.sum("LineTotal").alias("TotalSpend"),
        F.min("TransactionDate").alias("FirstPurchaseDate"),
        F.max("TransactionDate").alias("LastPurchaseDate"),
    ))
    top = pairs.agg(F.struct(
        F.max("LastPurchaseDate").alias("ref"),
        F.min("LastPurchaseDate").alias("oldest"),
        F.max("PurchaseCount").alias("count"),
        F.max("TotalSpend").alias("spend"),
    ).alias("top")).scalar()
    days = days_between(F.col("LastPurchaseDate"), top.getField("ref"))
    most_days = days_between(top.getField("oldest"), top.getField("ref"))
    scored = pairs.withColumn("DaysSinceLastPurchase", days).select(
        "*",
        (F.lit(1.0) - ratio(F.col("DaysSinceLastPurchase"), most_days + 1)).alias("RecencyScore"),
        ratio(F.col("PurchaseCount"), top.getField("count") + 1).alias("FrequencyScore"),
        (number(F.col("TotalSpend")) / (number(top.getField("spend")) + F.lit(1.0))).alias("MonetaryScore"),
    )
    return scored.withColumn(
        "AffinityScore",
        F.col("RecencyScore") * RECENCY_WEIGHT + F.col("FrequencyScore") * FREQUENCY_WEIGHT + F.col("MonetaryScore") * MONETARY_WEIGHT)


def create_product_feature_matrix(transactions: DataFrame, products: DataFrame, reference_date=None) -> DataFrame:
    """All products with performance and trends; missing numbers become 0."""
    ref = as_of(transactions, reference_date)
    performance = calculate_product_performance(transactions, products, ref).drop(*DETAILS[1:])
    trends = calculate_product_trends(transactions, products, ref)
    matrix = products.select(*DETAILS).join(performance, "ProductID", "left").join(trends, "ProductID", "left")
    return zero_filled(matrix, [c for c, t in matrix.dtypes if c != "ProductID" and t != "string" and t != "date"])
