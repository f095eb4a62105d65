"""Facts clustered by customer, and aggregates refreshed month by month.

A clustered fact is a bucketed and sorted table: grouping by customer, windows over a customer's lines and joins of facts by
customer read it without an exchange. All facts have the same number of buckets, which follows from the largest one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillpoint.sources.sinks import FACT_COLUMNS, fact_frame

#: Rows that make a bucket, and so the work of one task.
ROWS_PER_BUCKET = 5_000_000
#: The column beside CustomerID that each fact is sorted by.
FACT_DAYS = {"fact_transactions": "TransactionDate", "fact_loyalty_points": "TransactionDate", "fact_surveys": "SurveyDate"}


def bucket_count(rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """A power of two, so tables of different ages join bucket by bucket."""
    return 1 << max(0, -(-rows // rows_per_bucket) - 1).bit_length()


def cluster_facts(transactions: DataFrame, loyalty: DataFrame, surveys: DataFrame, database: str, location: str | None = None,
                  rows_per_bucket: int = ROWS_PER_BUCKET) -> dict[str, str]:
    """Write the facts as bucketed tables ``<database>.<fact>`` and return their names.

    A fact in which one customer (or the lines without one) has more rows than a bucket is stored unclustered: there an
    exchange is better, as it combines within tasks first, and AQE can split it.
    """
    spark = transactions.sparkSession
    frames = {"fact_transactions": transactions, "fact_loyalty_points": loyalty, "fact_surveys": surveys}
    sizes = {}
    for fact, df in frames.items():
        per_customer = df.groupBy("CustomerID").agg(F.count(F.lit(1)).alias("n"))
        row = per_customer.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.max("n"), F.lit(0)).alias("most")).first()
        sizes[fact] = row["rows"], row["most"]
    buckets = bucket_count(max(rows for rows, _ in sizes.values()), rows_per_bucket)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}" + (f" LOCATION '{location}'" if location else ""))
    written = {}
    for fact, df in frames.items():
        kept = fact_frame(df, fact) if set(FACT_COLUMNS[fact]) <= set(df.columns) else df
        name = f"{database}.{fact}"
        if sizes[fact][1] > rows_per_bucket:
            writer = kept.write
        else:  # the writer's buckets are the exchange's partitions: one file for each
            placed = kept.repartition(buckets, "CustomerID").sortWithinPartitions("CustomerID", FACT_DAYS[fact])
            writer = placed.write.bucketBy(buckets, "CustomerID").sortBy("CustomerID", FACT_DAYS[fact])
        writer.mode("overwrite").format("parquet").saveAsTable(name)
        written[fact] = name
    return written


# --- refreshed aggregates ------------------------------------------------------------------------

MONTH = "SalesMonth"


def month_of(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def build_by_month(facts: DataFrame, summary: Callable[[DataFrame], DataFrame], month: Column, path: str) -> DataFrame:
    """Write ``summary`` of all facts, one folder per month. ``month``: of a summary row, as 'yyyy-MM'."""
    summary(facts).withColumn(MONTH, month).write.mode("overwrite").partitionBy(MONTH).parquet(path)
    return read_by_month(facts.sparkSession, path)


def read_by_month(spark: SparkSession, path: str) -> DataFrame:
    """The aggregate without its folder column."""
    return spark.read.option("basePath", path).parquet(path).drop(MONTH)


def refresh_months(facts: DataFrame, summary: Callable[[DataFrame], DataFrame], month: Column, path: str, changed: list,
                   day_column: str = "TransactionDate") -> DataFrame:
    """Recompute the months of the ``changed`` days; the files of all other months stay as they are.

    ``summary`` must give rows that depend on one month's facts only, as those per day or month do. Of facts stored by
    month only the folders of these months are read. A month left without facts disappears.
    """
    spark = facts.sparkSession
    days = spark.createDataFrame([(str(d),) for d in changed], "d string").select(month_of(F.col("d").cast("date")).alias("m")).distinct()
    months = sorted(r["m"] for r in days.collect() if r["m"] is not None)  # months of the given days
    own = F.col(MONTH) if MONTH in facts.columns else month_of(F.col(day_column))
    part = summary(facts.filter(own.isin(months)).drop(MONTH)).withColumn(MONTH, month)
    part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)
    held = {r[MONTH] for r in spark.read.parquet(path).filter(F.col(MONTH).isin(months)).select(F.col(MONTH).cast("string").alias(MONTH)).distinct().collect()}
    for gone in held - {r["m"] for r in facts.filter(own.isin(months)).select(own.alias("m")).distinct().collect()}:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{MONTH}={gone}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return read_by_month(spark, path)
