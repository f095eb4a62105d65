"""Writing tables: processed files, the star-schema warehouse, DDL and aggregate tables."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillpoint import schemas
from tillpoint.functions.lineage import release_after

FORMATS = ("parquet", "csv", "both")


def _stem(path: str) -> str:
    """Path without a .parquet or .csv suffix."""
    for suffix in (".parquet", ".csv"):
        if path.lower().endswith(suffix):
            return path[: -len(suffix)]
    return path


def save_processed_data(df: DataFrame, file_path, format: str = "parquet", partition_by=None, **options) -> None:
    """Overwrite ``<path>.parquet`` and/or ``<path>.csv``. An unknown format is an error, not a silent no-op."""
    kind = format.lower()
    if kind not in FORMATS:
        raise ValueError(f"unknown format {format!r}, expected one of {FORMATS}")
    stem, began = _stem(str(file_path)), time.monotonic()
    writer = df.write.mode("overwrite").options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if kind in ("parquet", "both"):
        writer.parquet(f"{stem}.parquet")
    if kind in ("csv", "both"):
        writer.option("header", True).csv(f"{stem}.csv")
    release_after(df.sparkSession, began)


def save_all_processed_data(datasets: dict[str, DataFrame], output_dir, format: str = "parquet", **options) -> None:
    for name, df in datasets.items():
        save_processed_data(df, f"{str(output_dir).rstrip('/')}/{name}", format, **options)


# Areas of the warehouse and the columns each fact keeps.
AREAS = ("fact_tables", "dimension_tables", "aggregated_tables")
FACT_COLUMNS = {
    "fact_transactions": ["TransactionID", "CustomerID", "TransactionDate", "StoreID", "ProductID",
                          "Quantity", "UnitPrice", "LineTotal"],
    "fact_loyalty_points": ["LoyaltyRecordID", "CustomerID", "TransactionID", "TransactionDate",
                            "PointsEarned", "PointsRedeemed", "PointsBalance", "Tier", "PointsPerDollar"],
    "fact_surveys": ["SurveyID", "CustomerID", "SurveyDate", "SatisfactionScore", "NPSScore",
                     "Feedback", "WouldRecommend"],
}


def create_data_warehouse_structure(spark: SparkSession, output_dir) -> list[str]:
    """The three area folders."""
    conf = spark._jsc.hadoopConfiguration()
    made = []
    for area in AREAS:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{str(output_dir).rstrip('/')}/{area}")
        path.getFileSystem(conf).mkdirs(path)
        made.append(path.toString())
    return made


def fact_frame(df: DataFrame, fact: str) -> DataFrame:
    return df.select(*FACT_COLUMNS[fact])


def _by_month(df: DataFrame, date_column: str) -> DataFrame:
    """Add the folder column and let AQE even out the write: small months share a task, large ones are split."""
    return df.withColumn("SalesMonth", F.date_format(date_column, "yyyy-MM")).hint("rebalance", F.col("SalesMonth"))


def prepare_fact_tables(transactions: DataFrame, loyalty: DataFrame, surveys: DataFrame, output_dir, **options) -> dict[str, str]:
    """Project and write the facts, one folder per month: month filters skip folders, day filters skip row groups."""
    area = f"{str(output_dir).rstrip('/')}/fact_tables"
    plan = {
        "fact_transactions": (transactions, "TransactionDate"),
        "fact_loyalty_points": (loyalty, "TransactionDate"),
        "fact_surveys": (surveys, "SurveyDate"),
    }
    written = {}
    for fact, (df, day) in plan.items():
        path = f"{area}/{fact}"
        save_processed_data(_by_month(fact_frame(df, fact), day), path, partition_by=["SalesMonth"], **options)
        written[fact] = f"{path}.parquet"
    return written


def prepare_dimension_tables(customers: DataFrame, products: DataFrame, stores: DataFrame, output_dir, **options) -> dict[str, str]:
    area = f"{str(output_dir).rstrip('/')}/dimension_tables"
    written = {}
    for name, df in {"dim_customers": customers, "dim_products": products, "dim_stores": stores}.items():
        save_processed_data(df, f"{area}/{name}", **options)
        written[name] = f"{area}/{name}.parquet"
    return written


def create_date_dimension(spark: SparkSession, start_date="2020-01-01", end_date="2025-12-31", output_dir=None) -> DataFrame:
    """Calendar with one row per day, both ends included."""
    span = spark.range(1).select(
        F.explode(F.sequence(F.lit(start_date).cast("date"), F.lit(end_date).cast("date"))).alias("Date"))
    calendar = describe_dates(span)
    if output_dir is not None:
        save_processed_data(calendar, f"{str(output_dir).rstrip('/')}/dimension_tables/dim_dates")
    return calendar


def describe_dates(days: DataFrame) -> DataFrame:
    """The calendar attributes of a one-column frame of dates."""
    day = F.col("Date")
    return days.select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("DateKey"),
        day,
        F.year(day).alias("Year"),
        F.quarter(day).alias("Quarter"),
        F.month(day).alias("Month"),
        F.date_format(day, "MMMM").alias("MonthName"),
        F.weekofyear(day).alias("Week"),
        F.weekday(day).alias("DayOfWeek"),
        F.date_format(day, "EEEE").alias("DayName"),
        F.dayofmonth(day).alias("DayOfMonth"),
        (F.weekday(day) >= 5).alias("IsWeekend"),
        F.month(day).isin(schemas.HOLIDAY_MONTHS).alias("IsHolidaySeason"),
    )


WAREHOUSE_TABLES = {
    "dim_customers": schemas.CUSTOMERS,
    "dim_products": schemas.PRODUCTS,
    "dim_stores": schemas.STORES,
    "dim_dates": schemas.DATES,
    "fact_transactions": schemas.TRANSACTIONS,
    "fact_loyalty_points": schemas.LOYALTY,
    "fact_surveys": schemas.SURVEYS,
}


def create_warehouse_tables(spark: SparkSession, database: str, location: str | None = None) -> list[str]:
    """Empty catalog tables for the star schema. Keys and score ranges are checked by the quality operators."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")
    for name, schema in WAREHOUSE_TABLES.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet")
    return sorted(WAREHOUSE_TABLES)


def materialize(df: DataFrame, table: str, location: str | None = None) -> DataFrame:
    """Replace an aggregate table and return it. A path writes Parquet there; a plain name is a catalog table."""
    if location is not None:
        path = f"{location.rstrip('/')}/{table}.parquet"
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.parquet(path)
    df.write.mode("overwrite").format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)
