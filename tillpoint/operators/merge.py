"""The merged analytical table and its per-transaction and per-customer summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillpoint.functions.lineage import stage
from tillpoint.functions.stats import mean


def newest(column: str, *order: str):
    """Last non-null value of a column in the given order."""
    return F.max_by(F.col(column), F.when(F.col(column).isNotNull(), F.struct(*order)))


def loyalty_per_transaction(loyalty: DataFrame) -> DataFrame:
    """Summed points and the newest balance, tier and rate of each transaction."""
    order = ("TransactionDate", "LoyaltyRecordID")
    return loyalty.groupBy("TransactionID").agg(
        F.sum("PointsEarned").alias("PointsEarned"),
        F.sum("PointsRedeemed").alias("PointsRedeemed"),
        newest("PointsBalance", *order).alias("PointsBalance"),
        newest("Tier", *order).alias("Tier"),
        newest("PointsPerDollar", *order).alias("PointsPerDollar"),
    )


def survey_per_customer(surveys: DataFrame) -> DataFrame:
    """Mean scores; 'Yes' if any answer is 'Yes'."""
    said_yes = F.max(F.when(F.col("WouldRecommend") == "Yes", F.lit(True)))
    return surveys.groupBy("CustomerID").agg(
        mean(F.col("SatisfactionScore")).alias("SatisfactionScore"),
        mean(F.col("NPSScore")).alias("NPSScore"),
        F.when(said_yes, "Yes").otherwise("No").alias("WouldRecommend"),
    )


def merge_datasets(transactions: DataFrame, loyalty: DataFrame, surveys: DataFrame,
                   customers: DataFrame, products: DataFrame, stores: DataFrame) -> DataFrame:
    """Every line with its product, store, customer, transaction points and customer survey.

    Points are summed per transaction and repeat on each of its lines: do not add them up again.
    No side carries a broadcast hint. Spark broadcasts the ones it measures to be small; beyond
    that AQE splits a hot customer, product or store on the line side of the left join. It can do so
    only where a join stands between two exchanges, so customers and their surveys are one staged table,
    met by the lines in one join.
    """
    people = customers.select(
        "CustomerID", "FirstName", "LastName", "EnrollmentDate",
        F.col("City").alias("City_customer"), F.col("Province").alias("Province_customer"))
    answers = survey_per_customer(surveys)
    people = stage(people.join(answers, "CustomerID", "left").select(
        F.col("CustomerID").alias("_who"), *[c for c in people.columns if c != "CustomerID"],
        *[c for c in answers.columns if c != "CustomerID"]).unionByName(
            answers.join(people, "CustomerID", "left_anti").withColumnRenamed("CustomerID", "_who"), allowMissingColumns=True))
    return (
        transactions
        .join(products.select("ProductID", "ProductName", "Category", "Price", "Cost"), "ProductID", "left")
        .join(stores.select("StoreID", "StoreName", "City", "Province"), "StoreID", "left")
        .join(loyalty_per_transaction(loyalty), "TransactionID", "left")
        .join(people, F.col("CustomerID") == F.col("_who"), "left").drop("_who")
    )
