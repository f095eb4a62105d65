"""Buying spells: a customer's purchases with at most ``gap_days`` from one to the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillpoint.functions.stats import days_between, mean

GAP_DAYS = 30


def purchase_sessions(transactions: DataFrame, gap_days: int = GAP_DAYS) -> DataFrame:
    """CustomerID, SessionStart, SessionEnd, ActiveDays, Lines, Units and Spend of every session.

    Lines are folded to (customer, day) before sessions are formed, so a busy customer brings at most one row a day.
    Lines without a customer or a date belong to no session.
    """
    known = transactions.filter("CustomerID is not null and TransactionDate is not null")
    daily = known.groupBy("CustomerID", F.col("TransactionDate").cast("date").alias("_day")).agg(
        F.count(F.lit(1)).alias("_lines"), F.sum("Quantity").alias("_units"), F.sum("LineTotal").alias("_spend"))
    spell = F.session_window(F.col("_day").cast("timestamp_ntz"), f"{int(gap_days)} days")
    grouped = daily.groupBy("CustomerID", spell.alias("_spell")).agg(
        F.min("_day").alias("SessionStart"), F.max("_day").alias("SessionEnd"), F.count(F.lit(1)).alias("ActiveDays"),
        F.sum("_lines").alias("Lines"), F.sum("_units").alias("Units"), F.sum("_spend").alias("Spend"))
    return grouped.drop("_spell")


def calculate_session_features(transactions: DataFrame, gap_days: int = GAP_DAYS) -> DataFrame:
    """Sessions, mean spend of a session, days of the longest, and the first and last session's start per customer."""
    length = days_between(F.col("SessionStart"), F.col("SessionEnd")) + 1
    return purchase_sessions(transactions, gap_days).groupBy("CustomerID").agg(
        F.count(F.lit(1)).alias("Sessions"), mean(F.col("Spend")).alias("AvgSessionSpend"), F.max(length).alias("LongestSessionDays"),
        mean(F.col("ActiveDays")).alias("AvgActiveDays"), F.min("SessionStart").alias("FirstSession"), F.max("SessionStart").alias("LastSession"))
