"""From raw files to processed tables and the star-schema warehouse."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tillpoint.operators import cleaning, merge, quality
from tillpoint.sources import readers, sinks


#: The job's files are larger than its input: they are packed tighter than by default.
PACKED = {"compression": "zstd"}


@dataclass
class EtlResult:
    tables: dict[str, DataFrame]
    integrity: DataFrame
    quality: DataFrame
    warehouse: dict[str, str]
    #: lines that each cleaning step dropped or changed
    steps: DataFrame


def run_etl_pipeline(spark: SparkSession, raw_dir, processed_dir, warehouse_dir, first_date=cleaning.FIRST_DATE,
                     last_date=cleaning.LAST_DATE) -> EtlResult:
    """Validate sources, load, clean, check, merge, and write.

    Cleaned tables are written once and read back (what each cleaning step did is observed in that write), so integrity, quality, merge and the warehouse
    start from compact Parquet and a lost executor never repeats the cleaning.
    """
    readers.validate_data_sources(spark, raw_dir)
    raw = readers.load_all_data(spark, raw_dir)
    dated = {
        "transactions": cleaning.normalize_dates(raw["transactions"], ["TransactionDate"]),
        "loyalty": cleaning.normalize_dates(raw["loyalty"], ["TransactionDate"]),
        "surveys": cleaning.normalize_dates(raw["surveys"], ["SurveyDate"]),
        "customers": cleaning.normalize_dates(raw["customers"], ["EnrollmentDate", "DateOfBirth"]),
    }
    counts = cleaning.CleaningCounts()
    cleaned = {
        "transactions": cleaning.clean_transactions(dated["transactions"], first_date=first_date, last_date=last_date, counts=counts),
        "loyalty": cleaning.clean_loyalty_data(dated["loyalty"], flag_suspicious=True),
        "surveys": cleaning.clean_survey_data(dated["surveys"]),
        "customers": dated["customers"],
        "products": raw["products"],
        "stores": raw["stores"],
    }
    sinks.save_all_processed_data(cleaned, processed_dir, **PACKED)
    tables = {n: spark.read.parquet(f"{str(processed_dir).rstrip('/')}/{n}.parquet") for n in cleaned}
    cleaned.clear()  # and with it the staged copy of the deduplicated lines
    order = ("transactions", "loyalty", "surveys", "customers", "products", "stores")

    integrity = quality.validate_referential_integrity(*[tables[n] for n in order])
    checks = None
    for n in ("transactions", "loyalty", "surveys", "customers"):
        row = quality.calculate_data_quality_metrics(tables[n], n)
        checks = row if checks is None else checks.unionByName(row)

    merged = merge.merge_datasets(*[tables[n] for n in order])
    sinks.save_processed_data(merged, f"{str(processed_dir).rstrip('/')}/merged", **PACKED)
    tables["merged"] = spark.read.parquet(f"{str(processed_dir).rstrip('/')}/merged.parquet")

    sinks.create_data_warehouse_structure(spark, warehouse_dir)
    written = sinks.prepare_fact_tables(tables["transactions"], tables["loyalty"], tables["surveys"], warehouse_dir, **PACKED)
    written |= sinks.prepare_dimension_tables(tables["customers"], tables["products"], tables["stores"], warehouse_dir, **PACKED)
    sinks.create_date_dimension(spark, first_date, last_date, warehouse_dir)
    written["dim_dates"] = f"{str(warehouse_dir).rstrip('/')}/dimension_tables/dim_dates.parquet"
    return EtlResult(tables, integrity, checks, written, counts.table(spark))
