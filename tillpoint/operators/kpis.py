"""KPI tables a dashboard reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillpoint.functions.quantiles import quantiles
from tillpoint.functions.stats import count_if, mean, number, ratio
from tillpoint.operators.loyalty import tier_name

# Risk levels from low to high.
RISK_LEVELS = ["Low", "Medium", "High", "Critical"]


def percent_of(part: Column, whole: Column, digits: int | None = 2) -> Column:
    share = ratio(part, whole) * 100
    return share if digits is None else F.bround(share, digits)


def kpi_metrics(transactions: DataFrame, customers: DataFrame, predictions: DataFrame, features: DataFrame) -> DataFrame:
    """Eight headline figures as one row. Transactions are lines; churn is the predicted share."""
    sales = transactions.agg(
        F.sum("LineTotal").alias("total_revenue"),
        mean(F.col("LineTotal")).alias("avg_transaction_value"),
        F.count(F.lit(1)).alias("total_transactions"),
    )
    sold = transactions.agg(F.countDistinct("ProductID").alias("n")).scalar()
    people = customers.agg(F.count(F.lit(1)).alias("n")).scalar()
    churn = predictions.agg(F.struct(
        count_if(F.col("ChurnPrediction") == 0).alias("active"),
        (ratio(count_if(F.col("ChurnPrediction") == 1), F.count(F.lit(1))) * 100).alias("rate"),
    ).alias("c")).scalar()
    value = features.agg(mean(F.col("LifetimeValue")).alias("v")).scalar() if "LifetimeValue" in features.columns else F.lit(0.0)
    return sales.select(
        people.alias("total_customers"), "total_revenue", "avg_transaction_value", "total_transactions",
        sold.alias("unique_products"), churn.getField("active").alias("active_customers"),
        churn.getField("rate").alias("churn_rate"), value.alias("avg_lifetime_value"))


def monthly_revenue(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy(F.date_format("TransactionDate", "yyyy-MM").alias("YearMonth")).agg(
        F.sum("LineTotal").alias("LineTotal")).orderBy("YearMonth")


def _product_sums(transactions: DataFrame, products: DataFrame) -> DataFrame:
    sold = transactions.groupBy("ProductID").agg(
        F.sum("LineTotal").alias("TotalRevenue"), F.sum("Quantity").alias("TotalQuantity"),
        F.count("TransactionID").alias("TransactionCount"))
    return sold.join(products.select("ProductID", "ProductName", "Category"), "ProductID", "left")


def product_revenue(transactions: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue, quantity and lines per product that occurs, best first."""
    named = _product_sums(transactions, products).filter("ProductName is not null and Category is not null")
    return named.select("ProductID", "ProductName", "Category", "TotalRevenue", "TotalQuantity", "TransactionCount").orderBy(
        F.desc("TotalRevenue"), "ProductID")


def top_product_revenue(transactions: DataFrame, products: DataFrame, n: int = 1000) -> DataFrame:
    return product_revenue(transactions, products).limit(n)


def top_products_with_price(transactions: DataFrame, products: DataFrame, n: int = 20) -> DataFrame:
    """The top products with their average price per unit."""
    price = F.bround(ratio(F.col("TotalRevenue"), F.col("TotalQuantity")), 2)
    return top_product_revenue(transactions, products, n).withColumn("AvgPrice", price)


def category_revenue(transactions: DataFrame, products: DataFrame) -> DataFrame:
    return _product_sums(transactions, products).filter("Category is not null").groupBy("Category").agg(
        F.sum("TotalRevenue").alias("TotalRevenue"), F.sum("TotalQuantity").alias("TotalQuantity"),
        F.sum("TransactionCount").alias("TransactionCount")).orderBy(F.desc("TotalRevenue"), "Category")


def category_share(transactions: DataFrame, products: DataFrame) -> DataFrame:
    revenue = category_revenue(transactions, products)
    whole = revenue.agg(F.sum("TotalRevenue").alias("t")).scalar()
    return revenue.select("Category", "TotalRevenue", ratio(F.col("TotalRevenue"), whole).alias("RevenueShare"))


def segment_distribution(labels: DataFrame, names: DataFrame) -> DataFrame:
    """Customers per cluster in cluster order. Clusters that share a name stay apart."""
    whole = labels.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = labels.groupBy("Segment").agg(F.count(F.lit(1)).alias("Count")).join(names, "Segment", "left")
    fallback = F.concat(F.lit("Segment "), F.col("Segment").cast("string"))
    return counts.select(
        F.col("Segment").alias("Cluster"), F.coalesce("SegmentName", fallback).alias("Segment"), "Count",
        percent_of(F.col("Count"), whole).alias("Percentage")).orderBy("Cluster")


def risk_distribution(predictions: DataFrame) -> DataFrame:
    """Customers per risk level, most frequent first. Percentages count customers without a level too."""
    whole = predictions.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = predictions.filter("RiskLevel is not null").groupBy("RiskLevel").agg(F.count(F.lit(1)).alias("Count"))
    return counts.select("RiskLevel", "Count", percent_of(F.col("Count"), whole).alias("Percentage")).orderBy(
        F.desc("Count"), "RiskLevel")


def risk_order(level: Column) -> Column:
    place = F.lit(None).cast("int")
    for i, name in enumerate(RISK_LEVELS, start=1):
        place = F.when(level == name, F.lit(i)).otherwise(place)
    return place


def risk_summary(predictions: DataFrame) -> DataFrame:
    """Risk levels that occur, from low to critical."""
    whole = predictions.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = predictions.filter("RiskLevel is not null").groupBy("RiskLevel").agg(F.count(F.lit(1)).alias("Count"))
    return counts.select("RiskLevel", "Count", percent_of(F.col("Count"), whole, None).alias("Percentage")).orderBy(
        risk_order(F.col("RiskLevel")))


def headline_insights(segments: DataFrame, risks: DataFrame) -> DataFrame:
    """Largest segment (the first cluster on a tie) and the critical customers, as one row."""
    largest = F.max_by(F.struct("Segment", "Percentage"), F.struct(F.col("Count"), -F.col("Cluster")))
    critical = risks.filter(F.col("RiskLevel") == "Critical").agg(F.struct(
        F.coalesce(F.sum("Count"), F.lit(0)).alias("n"), F.coalesce(F.sum("Percentage"), F.lit(0.0)).alias("p")).alias("c")).scalar()
    return segments.agg(largest.alias("_top")).select(
        F.col("_top.Segment").alias("TopSegment"), F.col("_top.Percentage").alias("TopSegmentPercentage"),
        critical.getField("n").alias("CriticalCount"), critical.getField("p").alias("CriticalPercentage"))


def high_value_customers(features: DataFrame, probability: float = 0.75, limit: int | None = None) -> DataFrame:
    """How many customers lie above the lifetime-value quantile."""
    cut = quantiles(features, [], ["LifetimeValue"], probability, limit).scalar()
    return features.agg(
        F.max(cut).alias("Threshold"), count_if(number(F.col("LifetimeValue")) > cut).alias("HighValueCount"))


def recommended_actions(insights: DataFrame, features: DataFrame) -> DataFrame:
    """Rules that fire: many critical customers, one dominant segment, low lifetime value."""
    value = features.agg(mean(F.col("LifetimeValue")).alias("v")).scalar()
    facts = insights.withColumn("AvgLifetimeValue", value)
    rules = F.array(
        F.struct(F.lit("Urgent").alias("Action"), (F.col("CriticalPercentage") > 10).alias("Fires"),
                 F.col("CriticalPercentage").alias("Measure")),
        F.struct(F.lit("Focus").alias("Action"), (F.col("TopSegmentPercentage") > 40).alias("Fires"),
                 F.col("TopSegmentPercentage").alias("Measure")),
        F.struct(F.lit("Opportunity").alias("Action"), (F.col("AvgLifetimeValue") < 1000).alias("Fires"),
                 F.col("AvgLifetimeValue").alias("Measure")),
    )
    return facts.select(F.explode(rules).alias("r")).filter("r.Fires").select("r.Action", "r.Measure")


def metrics_by_segment_name(features: DataFrame, labels: DataFrame, names: DataFrame) -> DataFrame:
    """Mean key figures per segment name; clusters that share a name merge."""
    wanted = ["Recency", "Frequency", "LifetimeValue", "CurrentPointsBalance"]
    have = [c for c in wanted if c in features.columns]
    joined = features.join(labels, "CustomerID").join(names, "Segment")
    return joined.groupBy("SegmentName").agg(*[mean(F.col(c)).alias(c) for c in have])


def at_risk_customers(predictions: DataFrame, level: str | None = None, n: int | None = 100) -> DataFrame:
    """Customers by churn probability; all levels or one. ``n=None`` exports all of them."""
    chosen = predictions if level is None else predictions.filter(F.col("RiskLevel") == level)
    status = F.when(F.col("ChurnPrediction") == 1, "Churned").otherwise("Active")
    listed = chosen.select("CustomerID", "ChurnProbability", "ChurnPrediction", "RiskLevel", status.alias("Status")).orderBy(
        F.desc("ChurnProbability"), "CustomerID")
    return listed if n is None else listed.limit(n)


def tier_shares(features: DataFrame) -> DataFrame:
    """Customers per tier code, with the tier's name."""
    whole = features.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = features.groupBy("TierNumeric").agg(F.count(F.lit(1)).alias("Count"))
    return counts.select("TierNumeric", tier_name(F.col("TierNumeric")).alias("Tier"), "Count",
                         percent_of(F.col("Count"), whole, None).alias("Percentage")).orderBy("TierNumeric")


def points_statistics(features: DataFrame) -> DataFrame:
    earned = F.sum("TotalPointsEarned") if "TotalPointsEarned" in features.columns else F.lit(0)
    return features.agg(
        mean(F.col("CurrentPointsBalance")).alias("AvgPointsBalance"),
        F.sum("CurrentPointsBalance").alias("TotalPoints"),
        F.max("CurrentPointsBalance").alias("MaxPoints"),
        earned.alias("TotalPointsEarned"),
    )
