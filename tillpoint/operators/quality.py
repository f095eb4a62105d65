"""Data quality: referential checks, completeness metrics and domain rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tillpoint.functions.stats import count_if, ratio


def orphans(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Distinct fact keys absent from the dimension. A null key is an orphan unless the dimension has one too."""
    used = facts.select(key).distinct().alias("used")
    known = dimension.select(key).distinct().alias("known")
    return used.join(known, F.col(f"used.{key}").eqNullSafe(F.col(f"known.{key}")), "left_anti")


def validate_referential_integrity(transactions: DataFrame, loyalty: DataFrame, surveys: DataFrame,
                                   customers: DataFrame, products: DataFrame, stores: DataFrame) -> DataFrame:
    """One row per check with its orphan key count."""
    checks = {
        "transactions_customers": (transactions, customers, "CustomerID"),
        "transactions_products": (transactions, products, "ProductID"),
        "transactions_stores": (transactions, stores, "StoreID"),
        "loyalty_transactions": (loyalty, transactions, "TransactionID"),
        "loyalty_customers": (loyalty, customers, "CustomerID"),
        "surveys_customers": (surveys, customers, "CustomerID"),
    }
    rows = [
        orphans(facts, dim, key).agg(F.count(F.lit(1)).alias("OrphanCount"))
        .select(F.lit(name).alias("CheckName"), "OrphanCount", (F.col("OrphanCount") == 0).alias("Passed"))
        for name, (facts, dim, key) in checks.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def _missing(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def calculate_data_quality_metrics(df: DataFrame, dataset_name: str = "dataset") -> DataFrame:
    """Record, missing-value and full-row duplicate counts as one row.

    Rows are first folded to distinct rows with a count, so copies merge before the shuffle
    and both kinds of counts come from a single pass.
    """
    width = len(df.columns)
    missing = reduce(lambda a, b: a + b, [F.when(_missing(df, c), 1).otherwise(0) for c in df.columns])
    folded = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    totals = folded.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum(missing * F.col("_copies")), F.lit(0)).alias("missing_values"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_records"),
    )
    return totals.select(
        F.lit(dataset_name).alias("dataset"),
        "total_records",
        F.lit(width).alias("total_columns"),
        "missing_values",
        F.coalesce(ratio(F.col("missing_values"), F.col("total_records") * width) * 100, F.lit(0.0)).alias("missing_percentage"),
        "duplicate_records",
        F.coalesce(ratio(F.col("duplicate_records"), F.col("total_records")) * 100, F.lit(0.0)).alias("duplicate_percentage"),
    )


def check_domains(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Violations per named rule, all counted in one pass. A null outcome does not violate, as with CHECK."""
    counted = df.agg(*[count_if(~rule).alias(name) for name, rule in rules.items()])
    return counted.unpivot([], list(rules), "Rule", "Violations")


def survey_score_rules() -> dict[str, Column]:
    return {
        "SatisfactionScore": F.col("SatisfactionScore").between(1, 5),
        "NPSScore": F.col("NPSScore").between(0, 10),
    }


# The primary keys of the warehouse tables.
PRIMARY_KEYS = {
    "dim_customers": ["CustomerID"], "dim_products": ["ProductID"], "dim_stores": ["StoreID"], "dim_dates": ["DateKey"],
    "fact_transactions": ["TransactionID", "CustomerID", "ProductID", "TransactionDate"],
    "fact_loyalty_points": ["LoyaltyRecordID"], "fact_surveys": ["SurveyID"],
}


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with an incomplete key, keys that several rows share and the rows too many, as one row.

    Rows are counted per key, so copies of a key combine in each task before anything is shuffled.
    """
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return per_key.agg(
        zero(F.sum("_n")).alias("Rows"), zero(F.sum(F.when(~complete, F.col("_n")))).alias("IncompleteKeys"),
        count_if(complete & (F.col("_n") > 1)).alias("RepeatedKeys"),
        zero(F.sum(F.when(complete, F.col("_n") - 1))).alias("ExtraRows"))


def validate_primary_keys(tables: dict[str, DataFrame], keys: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per table: TableName, Rows, IncompleteKeys, RepeatedKeys, ExtraRows and Passed."""
    known = PRIMARY_KEYS if keys is None else keys
    rows = [key_violations(df, known[name]).select(F.lit(name).alias("TableName"), "*") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, rows).withColumn("Passed", (F.col("IncompleteKeys") == 0) & (F.col("RepeatedKeys") == 0))


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that several rows share, with how many."""
    return df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("Rows")).filter("Rows > 1")
