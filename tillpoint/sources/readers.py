"""Loading the six input tables and the cached result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillpoint import schemas


def _matches(spark: SparkSession, path: str) -> list[str]:
    """Existing files or folders for a path or glob, on any Hadoop file system."""
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(hadoop_path)
    return [] if found is None else sorted(s.getPath().toString() for s in found)


def require_columns(df: DataFrame, required: list[str], table: str = "table") -> DataFrame:
    """The frame itself, or ValueError naming the absent columns. Extra columns are welcome."""
    absent = sorted(set(required) - set(df.columns))
    if absent:
        raise ValueError(f"{table}: missing required columns {absent}")
    return df


def validate_dataframe(df: DataFrame, required_columns: list[str]) -> bool:
    require_columns(df, required_columns)
    return True


def _load(spark: SparkSession, table: str, path, reject_empty: bool = False, **options) -> DataFrame:
    path = str(path)
    found = _matches(spark, path)
    if not found:
        raise FileNotFoundError(f"{table}: {path} does not exist")
    if len(found) > 1:
        raise ValueError(f"{table}: {path} matches {len(found)} files, which would count their rows together")
    if path.lower().endswith(".parquet"):
        df = spark.read.options(**options).parquet(path)
        require_columns(df, schemas.REQUIRED[table], table)
    else:
        df = _read_csv(spark, table, path, options)
    if reject_empty and df.isEmpty():
        raise ValueError(f"{table}: {path} holds no rows")
    return df


BAD_RECORD = "_bad_record"


def _read_csv(spark: SparkSession, table: str, path: str, options: dict) -> DataFrame:
    """CSV columns are matched by header name; known ones get their pinned type, others stay text.

    A value that doesn't fit its type fails the read. With ``mode="PERMISSIVE"`` it becomes null instead, and
    ``_bad_record`` holds the whole line, so that ``bad_records`` can count what was lost.
    """
    settings = {"header": True, "enforceSchema": False, "mode": "FAILFAST", **options}
    header = spark.read.options(**settings).csv(path).columns
    known = {f.name: f.dataType for f in schemas.SCHEMAS[table].fields}
    absent = sorted(set(schemas.REQUIRED[table]) - set(header))
    if absent:
        raise ValueError(f"{table}: missing required columns {absent}")
    pinned = T.StructType([T.StructField(c, known.get(c, T.StringType())) for c in header])
    if settings["mode"].upper() == "PERMISSIVE":
        pinned = pinned.add(BAD_RECORD, T.StringType())
        settings.setdefault("columnNameOfCorruptRecord", BAD_RECORD)
    return spark.read.options(**settings).schema(pinned).csv(path)


def bad_records(df: DataFrame) -> DataFrame:
    """Lines and bad lines of a table that was read with ``mode="PERMISSIVE"``."""
    held = df.cache()  # Spark does not count the bad-record column of a file on its own
    bad = F.count(BAD_RECORD) if BAD_RECORD in df.columns else F.lit(0).cast("long")
    return held.agg(F.count(F.lit(1)).alias("Lines"), bad.alias("BadLines"))


def load_transactions(spark: SparkSession, file_path, **options) -> DataFrame:
    return _load(spark, "transactions", file_path, reject_empty=True, **options)


def load_loyalty_data(spark: SparkSession, file_path, **options) -> DataFrame:
    return _load(spark, "loyalty", file_path, reject_empty=True, **options)


def load_survey_data(spark: SparkSession, file_path, **options) -> DataFrame:
    return _load(spark, "surveys", file_path, **options)


def load_products(spark: SparkSession, file_path, **options) -> DataFrame:
    return _load(spark, "products", file_path, **options)


def load_stores(spark: SparkSession, file_path, **options) -> DataFrame:
    return _load(spark, "stores", file_path, **options)


def load_customers(spark: SparkSession, file_path, **options) -> DataFrame:
    return _load(spark, "customers", file_path, **options)


LOADERS = {
    "transactions": load_transactions,
    "loyalty": load_loyalty_data,
    "surveys": load_survey_data,
    "products": load_products,
    "stores": load_stores,
    "customers": load_customers,
}


def _raw_path(data_dir, table: str, files: dict[str, str] | None = None) -> str:
    return f"{str(data_dir).rstrip('/')}/{(schemas.RAW_FILES | (files or {}))[table]}"


def load_reference_data(spark: SparkSession, data_dir) -> dict[str, DataFrame]:
    """The three dimensions."""
    return {t: LOADERS[t](spark, _raw_path(data_dir, t)) for t in ("products", "stores", "customers")}


def load_all_data(spark: SparkSession, data_dir, files: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """All six tables from a folder of raw files; ``files`` names those that differ from the usual names."""
    return {t: load(spark, _raw_path(data_dir, t, files)) for t, load in LOADERS.items()}


def load_warehouse_tables(spark: SparkSession, folder) -> dict[str, DataFrame]:
    """All six tables from the Parquet folders the pipeline wrote."""
    base = str(folder).rstrip("/")
    return {t: load(spark, f"{base}/{t}.parquet") for t, load in LOADERS.items()}


def validate_data_sources(spark: SparkSession, data_dir, raise_missing: bool = True,
                          files: dict[str, str] | None = None) -> dict[str, bool]:
    """Which raw files exist; raises for absent ones unless told not to."""
    names = schemas.RAW_FILES | (files or {})
    present = {t: bool(_matches(spark, _raw_path(data_dir, t, files))) for t in names}
    absent = [names[t] for t, ok in present.items() if not ok]
    if absent and raise_missing:
        raise FileNotFoundError(f"missing data files in {data_dir}: {', '.join(absent)}")
    return present


# Result tables the analysis job writes; the product table may be absent.
RESULT_TABLES = [
    "feature_matrix", "segment_labels", "segment_profiles", "segment_names", "churn_predictions",
    "churn_feature_importance", "churn_metrics", "kpi_metrics", "monthly_revenue",
    "product_performance", "category_performance", "segment_distribution", "churn_risk_distribution",
]
PRODUCT_RESULT = T.StructType([
    T.StructField("ProductID", T.StringType()),
    T.StructField("ProductName", T.StringType()),
    T.StructField("Category", T.StringType()),
    T.StructField("TotalRevenue", T.DecimalType(28, 2)),
    T.StructField("TotalQuantity", T.LongType()),
    T.StructField("TransactionCount", T.LongType()),
])


def load_precomputed_data(spark: SparkSession, folder) -> dict[str, DataFrame]:
    """Result tables of an earlier analysis run. A missing product table reads as an empty one."""
    base = str(folder).rstrip("/")
    results = {}
    for name in RESULT_TABLES:
        path = f"{base}/{name}.parquet"
        if _matches(spark, path):
            results[name] = spark.read.parquet(path)
        elif name == "product_performance":
            results[name] = spark.createDataFrame([], PRODUCT_RESULT)
        else:
            raise FileNotFoundError(f"result table {path} does not exist")
    return results
