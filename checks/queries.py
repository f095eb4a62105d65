"""Registered queries: one or more per inventory item, each with its SQL counterpart where SQL can say it."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from checks.ctes import D, DATES, FEATURES, I, MEAN, REAL, TABLES, WHOLE, typed, with_tables
from checks.mapping import CLEAN_ORDER, FIRST_DATE, LAST_DATE, LINE_ORDER, Tables
from checks.plans import exchanges
from tillpoint.functions.lineage import release_after, scratch_path, stage
from tillpoint.functions.quantiles import quantiles
from tillpoint.operators import (
    baskets, churn, cleaning, customer_features as cf, explanations, kpis, loyalty as loy, merge, ml_prep, product_features as pf,
    quality, reports, segmentation as seg, sessions,
)
from tillpoint.plans import analysis, etl
from tillpoint.sources import clustered, readers, sinks
from tillpoint.streaming import ledger, windows

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Whole numbers as BIGINT, other numbers as DOUBLE rounded to 6 places, the rest as is.

    Scaling, rounding to whole numbers and scaling back is the same arithmetic in both engines.
    """
    out = []
    for f in df.schema.fields:
        c = f"`{f.name}`"
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = f"cast({c} as bigint)"
        elif isinstance(f.dataType, (T.DecimalType, T.FloatType, T.DoubleType)):
            c = f"rint(cast({c} as double) * 1e6D) / 1e6D"
        out.append(f"{c} as `{f.name}`")
    return df.selectExpr(*out)


def query(name: str, sql: str | None = None, *tables: str):
    def register(f: Callable[[Tables], DataFrame]):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = with_tables(sql, *tables)
        return f

    return register


def mapped(source: str, *columns: str) -> str:
    """SELECT of typed columns; a column is 'name:i' (whole), 'name:d' (double) or 'name'."""
    kinds = {"i": WHOLE, "d": REAL}
    parts = []
    for c in columns:
        name, _, kind = c.partition(":")
        parts.append(typed(name, kinds.get(kind, "text")))
    return f"SELECT {', '.join(parts)} FROM {source}"


TX_COLUMNS = ("TransactionID:i", "CustomerID:i", "TransactionDate", "StoreID:i", "ProductID:i", "Quantity:i", "UnitPrice:d",
              "LineTotal:d")
TX_NAMES = [c.partition(":")[0] for c in TX_COLUMNS]
LOYALTY_COLUMNS = ("LoyaltyRecordID:i", "CustomerID:i", "TransactionID:i", "TransactionDate", "PointsEarned:i",
                   "PointsRedeemed:i", "PointsBalance:i", "Tier", "PointsPerDollar:d")
SURVEY_COLUMNS = ("SurveyID:i", "CustomerID:i", "SurveyDate", "SatisfactionScore:i", "NPSScore:i", "Feedback", "WouldRecommend")
REF = "(SELECT ref FROM refd)"

# --- sources and sinks: written to the shared folder and loaded back ----------------------------


def _round_trip(t: Tables, df: DataFrame, table: str, format: str) -> DataFrame:
    path = scratch_path(t.spark, table)
    sinks.save_processed_data(df, path, format)
    return readers.LOADERS[table](t.spark, f"{path}.{format}")


_product_sql = mapped("products", "ProductID:i", "ProductName", "Category", "Price:d", "Cost:d")
_store_sql = mapped("stores", "StoreID:i", "StoreName", "City", "Province")
_customer_sql = mapped("customers", "CustomerID:i", "FirstName", "LastName", "City", "Province", "EnrollmentDate")


def _ids_as_numbers(df: DataFrame) -> DataFrame:
    """CSV files bring IDs back as text, as the contract says."""
    ids = [c for c in ("TransactionID", "CustomerID", "StoreID", "ProductID") if c in df.columns]
    return df.withColumns({c: F.col(c).cast("bigint") for c in ids})


@query("src_01", mapped("tx", *TX_COLUMNS), "tx")
def _(t):
    return _round_trip(t, t.tx.select(*TX_NAMES), "transactions", "parquet")


@query("src_01_csv", mapped("tx", *TX_COLUMNS), "tx")
def _(t):
    return _ids_as_numbers(_round_trip(t, t.tx.select(*TX_NAMES), "transactions", "csv"))


@query("src_02", mapped("loyalty", *LOYALTY_COLUMNS), "loyalty")
def _(t):
    return _round_trip(t, t.loyalty.drop("CumulativeSpend"), "loyalty", "parquet")


@query("src_03", mapped("surveys", *SURVEY_COLUMNS), "surveys")
def _(t):
    return _ids_as_numbers(_round_trip(t, t.surveys, "surveys", "csv"))


@query("src_04", _product_sql, "products")
def _(t):
    return _ids_as_numbers(_round_trip(t, t.products, "products", "csv"))


@query("src_05", _store_sql, "stores")
def _(t):
    return _ids_as_numbers(_round_trip(t, t.stores, "stores", "csv"))


@query("src_06", _customer_sql, "customers")
def _(t):
    return _ids_as_numbers(_round_trip(t, t.customers, "customers", "csv"))


def _raw_folder(t: Tables) -> str:
    base = scratch_path(t.spark, "raw")
    frames = {"transactions": t.tx.select(*TX_NAMES), "loyalty": t.loyalty.drop("CumulativeSpend"), "surveys": t.surveys,
              "products": t.products, "stores": t.stores, "customers": t.customers}
    sinks.save_all_processed_data(frames, base, "csv", compression="gzip")
    return base


_counts = "SELECT '{0}' AS TableName, count(*) AS Rows FROM {0}"


@query("src_07", " UNION ALL ".join(_counts.format(n) for n in ("products", "stores", "customers")), "products", "stores", "customers")
def _(t):
    base = scratch_path(t.spark, "dims")
    sinks.save_all_processed_data({"products": t.products, "stores": t.stores, "customers": t.customers}, base, "csv")
    return _table_sizes(readers.load_reference_data(t.spark, base))


def _table_sizes(frames: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in frames.items():
        row = df.agg(F.count(F.lit(1)).alias("Rows")).select(F.lit(name).alias("TableName"), "Rows")
        out = row if out is None else out.unionByName(row)
    return out


_six = {"transactions": "tx", "loyalty": "loyalty", "surveys": "surveys", "products": "products", "stores": "stores",
        "customers": "customers"}


@query("src_08", " UNION ALL ".join(f"SELECT '{n}' AS TableName, count(*) AS Rows FROM {s}" for n, s in _six.items()), *_six.values())
def _(t):
    base = _raw_folder(t)
    readers.validate_data_sources(t.spark, base)
    return _table_sizes(readers.load_all_data(t.spark, base))


@query("snk_04", f"""SELECT 'fact_transactions' AS FactName, count(*) AS Rows, {D('sum(LineTotal)')} AS Amount FROM tx
  UNION ALL SELECT 'fact_loyalty_points', count(*), {D('sum(PointsEarned)')} FROM loyalty
  UNION ALL SELECT 'fact_surveys', count(*), {D('sum(NPSScore)')} FROM surveys""", "tx", "loyalty", "surveys")
def _(t):
    written = sinks.prepare_fact_tables(t.tx, t.loyalty, t.surveys, scratch_path(t.spark, "warehouse"))
    measure = {"fact_transactions": "LineTotal", "fact_loyalty_points": "PointsEarned", "fact_surveys": "NPSScore"}
    out = None
    for fact, path in written.items():
        row = t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("Rows"), F.sum(measure[fact]).cast("double").alias("Amount"))
        row = row.select(F.lit(fact).alias("FactName"), "Rows", "Amount")
        out = row if out is None else out.unionByName(row)
    return out


@query("snk_04_clustered", f"""
  SELECT {I('CustomerID')} AS CustomerID, count(*) AS Lines, {D('sum(LineTotal)')} AS Spend, {I('max(last)')} AS PointsBalance,
         0::bigint AS Exchanges
  FROM (SELECT tx.CustomerID, LineTotal, NULL AS last FROM tx
        UNION ALL SELECT CustomerID, NULL, arg_max(PointsBalance, LoyaltyRecordID) FROM loyalty GROUP BY CustomerID)
  GROUP BY CustomerID HAVING count(LineTotal) > 0""".replace("count(*) AS Lines", "count(LineTotal) AS Lines"), "tx", "loyalty")
def _(t):
    """Sales and ledger of every customer, joined from facts clustered by customer: no fact is shuffled."""
    names = clustered.cluster_facts(t.tx, t.loyalty, t.surveys, f"shop_{uuid.uuid4().hex[:12]}", scratch_path(t.spark, "clustered"))
    sales = t.spark.table(names["fact_transactions"]).groupBy("CustomerID").agg(F.count(F.lit(1)).alias("Lines"), F.sum("LineTotal").alias("Spend"))
    newest = t.spark.table(names["fact_loyalty_points"]).groupBy("CustomerID").agg(F.max_by("PointsBalance", "LoyaltyRecordID").alias("PointsBalance"))
    joined = sales.hint("merge").join(newest, "CustomerID")
    return joined.withColumn("Exchanges", F.lit(exchanges(joined)))


@query("snk_05", " UNION ALL ".join(f"SELECT 'dim_{n}' AS TableName, count(*) AS Rows FROM {n}" for n in ("customers", "products", "stores")),
       "customers", "products", "stores")
def _(t):
    written = sinks.prepare_dimension_tables(t.customers, t.products, t.stores, scratch_path(t.spark, "warehouse"))
    return _table_sizes({n: t.spark.read.parquet(p) for n, p in written.items()})


@query("snk_06", f"""
  SELECT {I("strftime(Date, '%Y%m%d')")} AS DateKey, Date, {I('year(Date)')} AS Year, {I('quarter(Date)')} AS Quarter,
         {I('month(Date)')} AS Month, monthname(Date) AS MonthName, {I('week(Date)')} AS Week, {I('isodow(Date) - 1')} AS DayOfWeek,
         strftime(Date, '%A') AS DayName, {I('day(Date)')} AS DayOfMonth, isodow(Date) >= 6 AS IsWeekend,
         month(Date) IN (11, 12, 1, 2) AS IsHolidaySeason
  FROM (SELECT cast(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS date) AS Date FROM orders)""")
def _(t):
    span = t.raw("orders").agg(F.min(F.col("o_orderdate").cast("date")).alias("a"), F.max(F.col("o_orderdate").cast("date")).alias("b"))
    return sinks.describe_dates(span.select(F.explode(F.sequence("a", "b")).alias("Date")))


# --- repairs ---------------------------------------------------------------------------------

_dirty_names = [*TX_NAMES]


@query("cln_01", mapped("cln1", *TX_COLUMNS), "cln1")
def _(t):
    return cleaning.drop_incomplete(t.dirty_tx, cleaning.LINE_KEY).select(*TX_NAMES)


@query("cln_02", mapped("cln2", *TX_COLUMNS), "cln2")
def _(t):
    kept = cleaning.drop_incomplete(t.dirty_tx, cleaning.LINE_KEY)
    return cleaning.keep_first(kept, cleaning.LINE_KEY, list(CLEAN_ORDER)).select(*TX_NAMES)


def _through_price(t: Tables) -> DataFrame:
    kept = cleaning.keep_first(cleaning.drop_incomplete(t.dirty_tx, cleaning.LINE_KEY), cleaning.LINE_KEY, list(CLEAN_ORDER))
    fixed = kept.withColumn("Quantity", cleaning.repaired_quantity(F.col("Quantity")))
    return fixed.filter(~cleaning.has_bad_price(F.col("UnitPrice")))


@query("cln_03", mapped("cln3", "TransactionID:i", "ProductID:i", "LineNumber:i", "Quantity:i"), "cln3")
def _(t):
    kept = cleaning.keep_first(cleaning.drop_incomplete(t.dirty_tx, cleaning.LINE_KEY), cleaning.LINE_KEY, list(CLEAN_ORDER))
    return kept.select("TransactionID", "ProductID", "LineNumber", cleaning.repaired_quantity(F.col("Quantity")).alias("Quantity"))


@query("cln_04", mapped("cln4", *TX_COLUMNS), "cln4")
def _(t):
    return _through_price(t).select(*TX_NAMES)


@query("cln_05", mapped("cln5", *TX_COLUMNS), "cln5")
def _(t):
    return cleaning.cap_prices(_through_price(t)).select(*TX_NAMES)


@query("cln_06", mapped("cln6", *TX_COLUMNS), "cln6")
def _(t):
    return cleaning.repair_totals(cleaning.cap_prices(_through_price(t))).select(*TX_NAMES)


@query("cln_07", mapped("cln7", *TX_COLUMNS), "cln7")
def _(t):
    return cleaning.clean_transactions(t.dirty_tx, first_date=FIRST_DATE, last_date=LAST_DATE, order=CLEAN_ORDER).select(*TX_NAMES)


@query("cln_10_12", mapped("clean_loyalty", *LOYALTY_COLUMNS), "clean_loyalty")
def _(t):
    return cleaning.clean_loyalty_data(t.dirty_loyalty)


@query("cln_13", f"""
  SELECT {I('LoyaltyRecordID')} AS LoyaltyRecordID, {I('CustomerID')} AS CustomerID, {I('PointsRedeemed')} AS PointsRedeemed,
         PointsRedeemed > coalesce(lag(PointsBalance) OVER (PARTITION BY CustomerID ORDER BY TransactionDate, LoyaltyRecordID), 0)
           AS IsSuspicious
  FROM clean_loyalty""", "clean_loyalty")
def _(t):
    flagged = cleaning.flag_suspicious_redemptions(cleaning.clean_loyalty_data(t.dirty_loyalty), measure=t.customer_sizes)
    return flagged.select("LoyaltyRecordID", "CustomerID", "PointsRedeemed", "IsSuspicious")


@query("cln_20_21", mapped("clipped_surveys", *SURVEY_COLUMNS), "clipped_surveys")
def _(t):
    out = cleaning.drop_incomplete(t.dirty_surveys, ["CustomerID"])
    for c, (low, high) in cleaning.SCORE_RANGES.items():
        out = out.withColumn(c, cleaning.clipped(F.col(c), low, high))
    return out


@query("cln_22", f"""
  SELECT {I('SurveyID')} AS SurveyID, {I('CustomerID')} AS CustomerID, SurveyDate,
         {D('coalesce(SatisfactionScore, (SELECT median(SatisfactionScore) FROM clipped_surveys))')} AS SatisfactionScore,
         {D('coalesce(NPSScore, (SELECT median(NPSScore) FROM clipped_surveys))')} AS NPSScore, Feedback, WouldRecommend
  FROM clipped_surveys""", "clipped_surveys")
def _(t):
    return cleaning.clean_survey_data(t.dirty_surveys)


@query("cln_30", """
  SELECT cast(o_orderkey AS bigint) AS TransactionID,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE cast(o_orderdate AS date) END AS TransactionDate,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL
              ELSE strftime(cast(o_orderdate AS date) + to_minutes(o_orderkey % 1440), '%Y-%m-%d %H:%M:%S') END AS PlacedAt FROM orders""")
def _(t):
    day = F.col("o_orderdate").cast("date").cast("string")
    text = F.when(F.pmod(F.col("o_orderkey"), F.lit(7)) == 0, F.concat(F.lit("on "), day)).otherwise(day)
    minute = F.pmod(F.col("o_orderkey"), F.lit(1440)).cast("int")
    clock = F.format_string("%s %02d:%02d:00", text, F.floor(minute / 60).cast("int"), minute % 60)
    raw = t.raw("orders").select(F.col("o_orderkey").alias("TransactionID"), text.alias("TransactionDate"), clock.alias("PlacedAt"))
    dated = cleaning.normalize_dates(raw, ["TransactionDate", "NoSuchColumn"], ("PlacedAt",))
    return dated.withColumn("PlacedAt", F.date_format("PlacedAt", "yyyy-MM-dd HH:mm:ss"))


# --- quality ---------------------------------------------------------------------------------

_checks = [("transactions_customers", "dirty_tx", "CustomerID", "customers"), ("transactions_products", "dirty_tx", "ProductID", "products"),
           ("transactions_stores", "dirty_tx", "StoreID", "stores"), ("loyalty_transactions", "dirty_loyalty", "TransactionID", "dirty_tx"),
           ("loyalty_customers", "dirty_loyalty", "CustomerID", "customers"), ("surveys_customers", "dirty_surveys", "CustomerID", "customers")]


@query("dq_01", " UNION ALL ".join(
    f"SELECT '{n}' AS CheckName, count(*) AS OrphanCount, count(*) = 0 AS Passed FROM "
    f"(SELECT DISTINCT {k} FROM {f} EXCEPT SELECT {k} FROM {d})" for n, f, k, d in _checks),
    "dirty_tx", "dirty_loyalty", "dirty_surveys", "customers", "products", "stores")
def _(t):
    return quality.validate_referential_integrity(t.dirty_tx, t.dirty_loyalty, t.dirty_surveys, t.customers, t.products, t.stores)


_dirty_columns = ["TransactionID", "CustomerID", "TransactionDate", "StoreID", "ProductID", "Quantity", "UnitPrice", "LineTotal", "LineNumber"]


@query("dq_02", f"""
  SELECT 'transactions' AS dataset, total_records, 9::bigint AS total_columns, missing_values,
         {D('missing_values * 100.0::double / (total_records * 9)')} AS missing_percentage, duplicate_records,
         {D('duplicate_records * 100.0::double / total_records')} AS duplicate_percentage
  FROM (SELECT count(*) AS total_records,
          {I(' + '.join(f'count(*) FILTER ({c} IS NULL)' for c in _dirty_columns))} AS missing_values,
          count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty_tx)) AS duplicate_records FROM dirty_tx)""", "dirty_tx")
def _(t):
    return quality.calculate_data_quality_metrics(t.dirty_tx, "transactions")


@query("dq_03", """
  SELECT 'SatisfactionScore' AS Rule, count(*) FILTER (NOT SatisfactionScore BETWEEN 1 AND 5) AS Violations FROM dirty_surveys
  UNION ALL SELECT 'NPSScore', count(*) FILTER (NOT NPSScore BETWEEN 0 AND 10) FROM dirty_surveys""", "dirty_surveys")
def _(t):
    return quality.check_domains(t.dirty_surveys, quality.survey_score_rules())


@query("dq_04", f"""
  SELECT count(*) AS Lines, count(*) FILTER (CustomerID IS NULL) AS MissingKey,
         {I('''(SELECT sum(n - 1) FROM (SELECT count(*) AS n FROM cln1
               GROUP BY TransactionID, CustomerID, ProductID, TransactionDate))''')} AS Duplicate,
         count(*) FILTER (Quantity <= 0 OR Quantity > 1000) AS BadQuantity, count(*) FILTER (UnitPrice <= 0) AS BadPrice,
         count(*) FILTER (abs(LineTotal - round(UnitPrice * Quantity, 2)) > 0.01) AS WrongTotal,
         count(*) FILTER (TransactionDate < DATE '{DATES[0]}' OR TransactionDate > DATE '{DATES[1]}') AS DateOutside
  FROM dirty_tx""", "dirty_tx", "cln1")
def _(t):
    return cleaning.audit_transactions(t.dirty_tx, FIRST_DATE, LAST_DATE)


@query("dq_04_steps", f"""
  SELECT (SELECT count(*) FROM dirty_tx) AS Lines, (SELECT count(*) FROM dirty_tx) - (SELECT count(*) FROM cln1) AS MissingKey,
         (SELECT count(*) FROM cln1) - (SELECT count(*) FROM cln2) AS Duplicate,
         (SELECT count(*) FROM cln2 WHERE Quantity <= 0 OR Quantity > 1000) AS BadQuantity,
         (SELECT count(*) FROM cln2 WHERE UnitPrice <= 0) AS BadPrice,
         (SELECT count(*) FROM cln4, clnstat WHERE UnitPrice > mu + 3 * sd OR UnitPrice < mu - 3 * sd) AS CappedPrice,
         (SELECT count(*) FROM cln5 WHERE abs(LineTotal - round(UnitPrice * Quantity, 2)) > 0.01) AS WrongTotal,
         (SELECT count(*) FROM cln6 WHERE TransactionDate < DATE '{DATES[0]}' OR TransactionDate > DATE '{DATES[1]}') AS DateOutside,
         (SELECT count(*) FROM cln7) AS Kept""", "cln7", "clnstat")
def _(t):
    """The counts observed while the cleaned lines are written, once."""
    counts = cleaning.CleaningCounts()
    cleaned = cleaning.clean_transactions(t.dirty_tx, first_date=FIRST_DATE, last_date=LAST_DATE, order=CLEAN_ORDER, counts=counts)
    cleaned.write.parquet(scratch_path(t.spark, "cleaned"))
    return counts.table(t.spark)


_keyed = {"dim_customers": "customers", "dim_products": "products", "dim_stores": "stores", "fact_transactions": "dirty_tx",
          "fact_loyalty_points": "dirty_loyalty", "fact_surveys": "dirty_surveys"}


def _key_sql(name: str, source: str) -> str:
    keys = quality.PRIMARY_KEYS[name]
    whole = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return (f"SELECT '{name}' AS TableName, {I('sum(n)')} AS Rows, {I(f'coalesce(sum(n) FILTER (NOT ({whole})), 0)')} AS IncompleteKeys, "
            f"count(*) FILTER ({whole} AND n > 1) AS RepeatedKeys, {I(f'coalesce(sum(n - 1) FILTER ({whole}), 0)')} AS ExtraRows, "
            f"count(*) FILTER (NOT ({whole}) OR n > 1) = 0 AS Passed FROM (SELECT {', '.join(keys)}, count(*) AS n FROM {source} GROUP BY ALL)")


@query("ddl_keys", " UNION ALL ".join(_key_sql(n, s) for n, s in _keyed.items()), *_keyed.values())
def _(t):
    """Primary keys of the warehouse tables, on the faulty lines, records and surveys."""
    frames = {"dim_customers": t.customers, "dim_products": t.products, "dim_stores": t.stores, "fact_transactions": t.dirty_tx,
              "fact_loyalty_points": t.dirty_loyalty, "fact_surveys": t.dirty_surveys}
    return quality.validate_primary_keys(frames)


# --- joins -----------------------------------------------------------------------------------

@query("j_01", f"""
  WITH_TABLES SELECT {I('tx.TransactionID')} AS TransactionID, {I('tx.CustomerID')} AS CustomerID, tx.TransactionDate,
         {I('tx.StoreID')} AS StoreID, {I('tx.ProductID')} AS ProductID, {I('tx.LineNumber')} AS LineNumber,
         {I('tx.Quantity')} AS Quantity, {D('tx.UnitPrice')} AS UnitPrice, {D('tx.LineTotal')} AS LineTotal,
         ProductName, Category, {D('Price')} AS Price, {D('Cost')} AS Cost, StoreName, s.City, s.Province,
         FirstName, LastName, EnrollmentDate, c.City AS City_customer, c.Province AS Province_customer,
         {I('l.PointsEarned')} AS PointsEarned, {I('l.PointsRedeemed')} AS PointsRedeemed, {I('l.PointsBalance')} AS PointsBalance,
         l.Tier, {D('l.PointsPerDollar')} AS PointsPerDollar, {D('v.SatisfactionScore')} AS SatisfactionScore,
         {D('v.NPSScore')} AS NPSScore, v.WouldRecommend
  FROM tx LEFT JOIN products p ON p.ProductID = tx.ProductID LEFT JOIN stores s ON s.StoreID = tx.StoreID
  LEFT JOIN customers c ON c.CustomerID = tx.CustomerID
  LEFT JOIN (SELECT TransactionID, sum(PointsEarned) AS PointsEarned, sum(PointsRedeemed) AS PointsRedeemed,
               arg_max(PointsBalance, LoyaltyRecordID) AS PointsBalance, arg_max(Tier, LoyaltyRecordID) AS Tier,
               arg_max(PointsPerDollar, LoyaltyRecordID) AS PointsPerDollar FROM loyalty GROUP BY TransactionID) l
    ON l.TransactionID = tx.TransactionID
  LEFT JOIN (SELECT CustomerID, cast(sum(SatisfactionScore) AS double) / count(*) AS SatisfactionScore,
               cast(sum(NPSScore) AS double) / count(*) AS NPSScore,
               CASE WHEN bool_or(WouldRecommend = 'Yes') THEN 'Yes' ELSE 'No' END AS WouldRecommend
             FROM surveys GROUP BY CustomerID) v ON v.CustomerID = tx.CustomerID""".replace("WITH_TABLES ", ""),
       "tx", "products", "stores", "customers", "loyalty", "surveys")
def _(t):
    merged = merge.merge_datasets(t.tx, t.loyalty, t.surveys, t.customers, t.products, t.stores)
    return merged.drop("ReturnFlag")


@query("j_04", mapped("latest", *LOYALTY_COLUMNS), "latest")
def _(t):
    return loy.latest_records(t.loyalty).select(*[c.partition(":")[0] for c in LOYALTY_COLUMNS])


@query("j_11", f"""
  SELECT {I('CustomerID')} AS CustomerID FROM (SELECT CustomerID FROM tx WHERE TransactionDate <= cut GROUP BY 1
    INTERSECT SELECT CustomerID FROM tx WHERE TransactionDate > cut GROUP BY 1)""".replace(
    "cut", "(SELECT min(TransactionDate) + cast(floor(datediff('day', min(TransactionDate), max(TransactionDate)) * 0.8::double) AS integer) FROM tx)"), "tx")
def _(t):
    train, _test = churn.temporal_targets(t.tx)
    return train.select("CustomerID")


# --- warehouse reports ------------------------------------------------------------------------

@query("agg_01", f"""
  SELECT {I('c.CustomerID')} AS CustomerID, FirstName, LastName, EnrollmentDate,
         count(DISTINCT TransactionDate) AS TotalTransactions, {D('sum(LineTotal)')} AS TotalSpent,
         {D(MEAN('LineTotal'))} AS AvgTransactionValue, max(TransactionDate) AS LastPurchaseDate,
         min(TransactionDate) AS FirstPurchaseDate, datediff('day', max(TransactionDate), {REF}) AS DaysSinceLastPurchase,
         datediff('day', min(TransactionDate), max(TransactionDate)) AS CustomerLifespanDays
  FROM customers c LEFT JOIN tx ON tx.CustomerID = c.CustomerID
  GROUP BY c.CustomerID, FirstName, LastName, EnrollmentDate""", "customers", "tx", "refd")
def _(t):
    return reports.customer_lifetime_value(t.customers, t.tx, t.ref)


@query("agg_02", f"""
  SELECT Tier, count(DISTINCT CustomerID) AS CustomerCount, {D(MEAN('PointsBalance'))} AS AvgPointsBalance,
         {I('sum(PointsEarned)')} AS TotalPointsEarned, {I('sum(PointsRedeemed)')} AS TotalPointsRedeemed
  FROM latest GROUP BY Tier""", "latest")
def _(t):
    return loy.tier_distribution(t.loyalty)


@query("agg_03", f"""
  SELECT {I('p.ProductID')} AS ProductID, ProductName, Category, count(DISTINCT TransactionID) AS TransactionCount,
         {I('sum(Quantity)')} AS TotalUnitsSold, {D('sum(LineTotal)')} AS TotalRevenue, {D(MEAN('UnitPrice'))} AS AvgPrice,
         {D(MEAN('Quantity'))} AS AvgQuantityPerTransaction
  FROM products p JOIN lines ON lines.ProductID = p.ProductID GROUP BY ALL""", "products", "lines")
def _(t):
    return reports.top_products(t.lines, t.products)


_category = f"""
  SELECT Category, count(DISTINCT p.ProductID) AS ProductCount, count(DISTINCT TransactionID) AS TransactionCount,
         {I('sum(Quantity)')} AS TotalUnitsSold, {D('sum(LineTotal)')} AS TotalRevenue, {D(MEAN('LineTotal'))} AS AvgTransactionValue"""


@query("agg_04", f"{_category} FROM products p JOIN lines ON lines.ProductID = p.ProductID GROUP BY Category", "products", "lines")
def _(t):
    return reports.category_performance(t.lines, t.products)


@query("agg_05", f"""
  SELECT {I('year(TransactionDate)')} AS Year, {I('month(TransactionDate)')} AS Month, {I('p.ProductID')} AS ProductID,
         ProductName, Category, {I('sum(Quantity)')} AS UnitsSold, {D('sum(LineTotal)')} AS Revenue
  FROM tx JOIN products p ON p.ProductID = tx.ProductID GROUP BY ALL""", "tx", "products")
def _(t):
    return reports.monthly_product_sales(t.tx, t.products)


@query("agg_06", f"""
  SELECT {I('a')} AS Product1ID, {I('b')} AS Product2ID, p1.ProductName AS Product1, p2.ProductName AS Product2, CoOccurrence
  FROM (SELECT t1.ProductID AS a, t2.ProductID AS b, count(*) AS CoOccurrence FROM lines t1 JOIN lines t2
          ON t1.TransactionID = t2.TransactionID AND t1.ProductID < t2.ProductID GROUP BY 1, 2)
  JOIN products p1 ON p1.ProductID = a JOIN products p2 ON p2.ProductID = b WHERE CoOccurrence >= 2""", "lines", "products")
def _(t):
    return baskets.line_pairs(t.lines, t.products, 2)


@query("agg_06_brands", """
  SELECT t1.b AS Product1, t2.b AS Product2, count(*) AS CoOccurrence
  FROM (SELECT l_orderkey AS o, p_brand AS b FROM lineitem JOIN part ON p_partkey = l_partkey) t1
  JOIN (SELECT l_orderkey AS o, p_brand AS b FROM lineitem JOIN part ON p_partkey = l_partkey) t2 ON t1.o = t2.o AND t1.b < t2.b
  GROUP BY 1, 2 HAVING count(*) >= 10""")
def _(t):
    brand_of = t.raw("part").select(F.col("p_partkey").alias("ProductID"), F.col("p_brand").alias("Brand"))
    lines = t.lines.join(brand_of, "ProductID").select("TransactionID", F.col("Brand").alias("ProductID"))
    brands = t.raw("part").select(F.col("p_brand").alias("ProductID"), F.col("p_brand").alias("ProductName")).distinct()
    return baskets.line_pairs(lines, brands, 10).select("Product1", "Product2", "CoOccurrence")


_tier_members = ", ".join(
    f"count(DISTINCT CASE WHEN Tier = '{x}' THEN CustomerID END) AS {x}{{0}}" for x in ("Platinum", "Gold", "Silver", "Bronze"))


@query("agg_07", f"""
  SELECT count(DISTINCT CustomerID) AS TotalMembers, {I('sum(PointsEarned)')} AS TotalPointsEarned,
         {I('sum(PointsRedeemed)')} AS TotalPointsRedeemed, {D(MEAN('PointsBalance'))} AS AvgPointsBalance,
         {_tier_members.format('Members')} FROM latest""", "latest")
def _(t):
    return loy.loyalty_overview(t.loyalty)


_month = f"{I('year(TransactionDate)')} AS Year, {I('month(TransactionDate)')} AS Month"


@query("agg_08", f"""
  SELECT {_month}, {I('sum(PointsEarned)')} AS PointsEarned, {I('sum(PointsRedeemed)')} AS PointsRedeemed,
         {D(MEAN('PointsBalance'))} AS AvgPointsBalance, count(DISTINCT CustomerID) AS ActiveMembers
  FROM loyalty GROUP BY 1, 2""", "loyalty")
def _(t):
    return loy.monthly_points_activity(t.loyalty)


@query("agg_09", """
  SELECT PreviousTier AS FromTier, Tier AS ToTier, count(*) AS MigrationCount FROM tier_lag
  WHERE PreviousTier IS NOT NULL AND PreviousTier <> Tier GROUP BY 1, 2""", "tier_lag")
def _(t):
    return loy.tier_migration(t.loyalty, t.customer_sizes)


@query("agg_10", f"""
  SELECT CASE WHEN PointsRedeemed BETWEEN 0 AND 1000 THEN '0-1K' WHEN PointsRedeemed BETWEEN 1001 AND 5000 THEN '1K-5K'
              WHEN PointsRedeemed BETWEEN 5001 AND 10000 THEN '5K-10K' ELSE '10K+' END AS RedemptionRange,
         count(*) AS RedemptionCount, {D(MEAN('PointsRedeemed'))} AS AvgRedemption, {I('sum(PointsRedeemed)')} AS TotalRedeemed
  FROM (SELECT TransactionID, sum(PointsRedeemed) AS PointsRedeemed FROM loyalty GROUP BY 1)
  WHERE PointsRedeemed > 0 GROUP BY 1""", "loyalty")
def _(t):
    per_basket = t.loyalty.groupBy("TransactionID").agg(F.sum("PointsRedeemed").alias("PointsRedeemed"))
    return loy.redemption_patterns(per_basket)


@query("agg_11", f"""
  SELECT {I('CustomerID')} AS CustomerID, max(TransactionDate) AS LastPurchaseDate,
         datediff('day', max(TransactionDate), {REF}) AS Recency, count(DISTINCT TransactionDate) AS Frequency,
         {D('sum(LineTotal)')} AS Monetary FROM tx GROUP BY CustomerID""", "tx", "refd")
def _(t):
    return reports.rfm_base(t.tx, t.ref)


_daily = f"""
  SELECT TransactionDate, count(DISTINCT TransactionID) AS TransactionCount, count(DISTINCT CustomerID) AS UniqueCustomers,
         count(DISTINCT ProductID) AS UniqueProducts, {I('sum(Quantity)')} AS TotalQuantity, {D('sum(LineTotal)')} AS TotalRevenue,
         {D(MEAN('LineTotal'))} AS AvgTransactionValue FROM tx GROUP BY 1"""
_segments = f"""
  SELECT Segment, count(*) AS CustomerCount, {D(MEAN('Recency'))} AS AvgRecency, {D(MEAN('Frequency'))} AS AvgFrequency,
         {D(MEAN('Monetary'))} AS AvgMonetary
  FROM (SELECT *, CASE WHEN Recency <= 30 AND Frequency >= 20 AND Monetary / 100 >= 5000 THEN 'Champions'
                       WHEN Recency <= 60 AND Frequency >= 10 AND Monetary / 100 >= 2000 THEN 'Loyal Customers'
                       WHEN Recency <= 90 AND Frequency >= 5 THEN 'Potential Loyalists'
                       WHEN Recency <= 30 AND Frequency <= 5 THEN 'New Customers'
                       WHEN Recency > 90 AND Frequency >= 10 THEN 'At Risk' WHEN Recency > 180 THEN 'Lost'
                       ELSE 'Need Attention' END AS Segment FROM rfm) GROUP BY 1"""
_summary = f"""{_category.replace('lines', 'tx')}, count(DISTINCT CustomerID) AS UniqueCustomers
  FROM products p JOIN tx ON tx.ProductID = p.ProductID GROUP BY Category"""
_monthly_loyalty = f"""
  SELECT {_month}, count(DISTINCT CustomerID) AS ActiveMembers, {I('sum(PointsEarned)')} AS TotalPointsEarned,
         {I('sum(PointsRedeemed)')} AS TotalPointsRedeemed, {D(MEAN('PointsBalance'))} AS AvgPointsBalance,
         {_tier_members.format('Count')} FROM loyalty GROUP BY 1, 2"""


@query("agg_12", _daily, "tx")
def _(t):
    return reports.daily_summary(t.tx)


@query("agg_13", _segments, "rfm")
def _(t):
    return reports.customer_segments(t.tx, t.ref, 100)


@query("agg_14", _summary, "tx", "products")
def _(t):
    return reports.category_summary(t.tx, t.products)


@query("agg_15", _monthly_loyalty, "loyalty")
def _(t):
    return loy.monthly_loyalty_summary(t.loyalty)


def _stored(t: Tables, df: DataFrame, table: str) -> DataFrame:
    return sinks.materialize(df, table, scratch_path(t.spark, "aggregates"))


@query("ctas_01", _daily, "tx")
def _(t):
    return _stored(t, reports.daily_summary(t.tx), "agg_daily_transactions")


@query("ctas_01_refreshed", _daily, "tx")
def _(t):
    """Built without the sales that come late, then refreshed for their months: the same table."""
    late = F.pmod(F.col("TransactionID"), F.lit(50)) == 3
    newest = F.col("TransactionDate") >= F.add_months(F.lit(t.ref), -2)
    path, month = scratch_path(t.spark, "agg_daily"), clustered.month_of(F.col("TransactionDate"))
    clustered.build_by_month(t.tx.filter(~(late & newest)), reports.daily_summary, month, path)
    days = [r[0] for r in t.tx.filter(late & newest).select("TransactionDate").distinct().collect()]  # days of two months
    return clustered.refresh_months(t.tx, reports.daily_summary, month, path, days)


@query("ctas_04_refreshed", _monthly_loyalty, "loyalty")
def _(t):
    late = F.pmod(F.col("TransactionID"), F.lit(50)) == 3
    newest = F.col("TransactionDate") >= F.add_months(F.lit(t.ref), -2)
    path = scratch_path(t.spark, "agg_monthly")
    month = F.concat_ws("-", F.col("Year"), F.lpad(F.col("Month").cast("string"), 2, "0"))
    clustered.build_by_month(t.loyalty.filter(~(late & newest)), loy.monthly_loyalty_summary, month, path)
    days = [r[0] for r in t.loyalty.filter(late & newest).select("TransactionDate").distinct().collect()]
    return clustered.refresh_months(t.loyalty, loy.monthly_loyalty_summary, month, path, days)


@query("ctas_02", _segments, "rfm")
def _(t):
    return _stored(t, reports.customer_segments(t.tx, t.ref, 100), "agg_customer_segments")


@query("ctas_03", _summary, "tx", "products")
def _(t):
    return _stored(t, reports.category_summary(t.tx, t.products), "agg_category_performance")


@query("ctas_04", _monthly_loyalty, "loyalty")
def _(t):
    return _stored(t, loy.monthly_loyalty_summary(t.loyalty), "agg_monthly_loyalty")


# --- windows ----------------------------------------------------------------------------------

@query("win_01", f"""
  SELECT {I('CustomerID')} AS CustomerID, Recency, Frequency, {D('Monetary')} AS Monetary, RecencyScore, FrequencyScore, MonetaryScore,
         RecencyScore * 100 + FrequencyScore * 10 + MonetaryScore AS RFMScore
  FROM (SELECT *, ntile(5) OVER (ORDER BY Recency DESC, CustomerID) AS RecencyScore,
          ntile(5) OVER (ORDER BY Frequency, CustomerID) AS FrequencyScore,
          ntile(5) OVER (ORDER BY Monetary, CustomerID) AS MonetaryScore FROM rfm)""", "rfm")
def _(t):
    return reports.rfm_scores(t.tx, t.ref)


@query("win_02", f"""
  SELECT {I('LoyaltyRecordID')} AS LoyaltyRecordID, {I('CustomerID')} AS CustomerID, TransactionDate, Tier, PreviousTier
  FROM tier_lag""", "tier_lag")
def _(t):
    return loy.with_previous_tier(t.loyalty, t.customer_sizes).select(
        "LoyaltyRecordID", "CustomerID", "TransactionDate", "Tier", "PreviousTier")


@query("win_03", mapped("f_rfm", "CustomerID:i", "RecencyScore:i", "FrequencyScore:i", "MonetaryScore:i"), "f_rfm")
def _(t):
    return cf.calculate_rfm_features(t.tx, t.ref).select("CustomerID", "RecencyScore", "FrequencyScore", "MonetaryScore")


@query("win_05", mapped("f_loyalty", "CustomerID:i", "TierChanges:i"), "f_loyalty")
def _(t):
    return cf.calculate_loyalty_features(t.loyalty, t.customers, t.ref, t.customer_sizes).select("CustomerID", "TierChanges")


@query("win_06", f"""
  SELECT {I('TransactionID')} AS TransactionID, {I('CustomerID')} AS CustomerID, {I('LineNumber')} AS LineNumber,
         {I('ProductID')} AS ProductID, {D('sum(LineTotal) OVER w')} AS CumulativeSpend
  FROM tx WINDOW w AS (PARTITION BY CustomerID ORDER BY TransactionDate, TransactionID, LineNumber, ProductID, StoreID,
                       Quantity, LineTotal ROWS UNBOUNDED PRECEDING)""", "tx")
def _(t):
    return loy.running_spend(t.tx, LINE_ORDER, measure=t.customer_sizes).select(
        "TransactionID", "CustomerID", "LineNumber", "ProductID", "CumulativeSpend")


# --- customer features ------------------------------------------------------------------------

def _features_sql(source: str, columns: list[str]) -> str:
    return "SELECT " + ", ".join([f"{I('CustomerID')} AS CustomerID"] + [typed(c, FEATURES[c][1]) for c in columns if c != "CustomerID"]) + f" FROM {source}"


@query("fea_01", _features_sql("f_rfm", cf.RFM_COLUMNS), "f_rfm")
def _(t):
    return cf.calculate_rfm_features(t.tx, t.ref)


@query("fea_02", _features_sql("f_period", [c for c in FEATURES if FEATURES[c][0] == "f_period"]), "f_period")
def _(t):
    return cf.calculate_frequency_by_period(t.tx, t.ref)


@query("fea_03", _features_sql("f_loyalty", cf.LOYALTY_COLUMNS), "f_loyalty")
def _(t):
    return cf.calculate_loyalty_features(t.loyalty, t.customers, t.ref, t.customer_sizes)


@query("fea_04", _features_sql("f_engage", cf.ENGAGEMENT_COLUMNS), "f_engage")
def _(t):
    return cf.calculate_engagement_features(t.tx, t.products)


_sessions = f"""
  (SELECT CustomerID, min(d) AS SessionStart, max(d) AS SessionEnd, count(*) AS ActiveDays, sum(n) AS Lines, sum(u) AS Units, sum(s) AS Spend
   FROM (SELECT *, sum(fresh) OVER (PARTITION BY CustomerID ORDER BY d) AS island
         FROM (SELECT *, CASE WHEN d - lag(d) OVER (PARTITION BY CustomerID ORDER BY d) <= {sessions.GAP_DAYS} THEN 0 ELSE 1 END AS fresh
               FROM (SELECT CustomerID, TransactionDate AS d, count(*) AS n, sum(Quantity) AS u, sum(LineTotal) AS s FROM tx GROUP BY 1, 2)))
   GROUP BY CustomerID, island)"""


@query("fea_04_sessions", f"SELECT {I('CustomerID')} AS CustomerID, SessionStart, SessionEnd, ActiveDays, {I('Lines')} AS Lines, {I('Units')} AS Units, "
       f"{D('Spend')} AS Spend FROM {_sessions}", "tx")
def _(t):
    return sessions.purchase_sessions(t.tx)


@query("fea_04_session_features", f"""
  SELECT {I('CustomerID')} AS CustomerID, count(*) AS Sessions, {D(MEAN('Spend'))} AS AvgSessionSpend,
         {I("max(datediff('day', SessionStart, SessionEnd) + 1)")} AS LongestSessionDays, {D(MEAN('ActiveDays'))} AS AvgActiveDays,
         min(SessionStart) AS FirstSession, max(SessionStart) AS LastSession FROM {_sessions} GROUP BY CustomerID""", "tx")
def _(t):
    return sessions.calculate_session_features(t.tx)


@query("fea_05", _features_sql("f_trend", cf.TREND_COLUMNS), "f_trend")
def _(t):
    return cf.calculate_behavioral_features(t.tx, t.ref)


@query("fea_06", _features_sql("f_season", cf.SEASON_COLUMNS), "f_season")
def _(t):
    return cf.calculate_seasonal_features(t.tx)


@query("fea_07", _features_sql("f_survey", ["AvgSatisfactionScore", "AvgNPSScore", "RecommendationRate"]), "f_survey")
def _(t):
    return cf.calculate_survey_features(t.surveys)


@query("fea_08", "SELECT * FROM features", "features")
def _(t):
    return t.features


# --- products -----------------------------------------------------------------------------------

TABLES["p_sales"] = (["tx", "products", "refd"], f"""
  SELECT s.*, ProductName, Category, Price, Cost, coalesce(cast(TotalRevenue AS double) / nullif(TotalUnitsSold, 0), cast(Price AS double))
           AS RevenuePerUnit, cast(Price - Cost AS double) / cast(Price AS double) AS ProfitMargin,
         TotalRevenue - Cost * TotalUnitsSold AS TotalProfit, datediff('day', FirstSaleDate, {REF}) AS ProductAge,
         cast(TotalUnitsSold AS double) / greatest(1, datediff('day', FirstSaleDate, {REF})) AS SalesVelocity
  FROM (SELECT ProductID, count(*) AS TransactionCount, cast(sum(Quantity) AS bigint) AS TotalUnitsSold,
          {MEAN('Quantity')} AS AvgQuantityPerTransaction, sum(LineTotal) AS TotalRevenue, {MEAN('LineTotal')} AS AvgRevenuePerTransaction,
          min(TransactionDate) AS FirstSaleDate, max(TransactionDate) AS LastSaleDate FROM tx GROUP BY ProductID) s
  LEFT JOIN products ON products.ProductID = s.ProductID""")
TABLES["p_trend"] = (["tx", "refd"], """
  SELECT *, cast(RecentUnitsSold - HistoricalUnitsSold AS double) / (HistoricalUnitsSold + 1) AS UnitsGrowthRate,
         (cast(RecentRevenue AS double) - cast(HistoricalRevenue AS double)) / (cast(HistoricalRevenue AS double) + 1) AS RevenueGrowthRate
  FROM (SELECT ProductID, cast(coalesce(sum(Quantity) FILTER (TransactionDate >= ref - 90), 0) AS bigint) AS RecentUnitsSold,
          coalesce(sum(LineTotal) FILTER (TransactionDate >= ref - 90), 0) AS RecentRevenue,
          cast(coalesce(sum(Quantity) FILTER (TransactionDate < ref - 90), 0) AS bigint) AS HistoricalUnitsSold,
          coalesce(sum(LineTotal) FILTER (TransactionDate < ref - 90), 0) AS HistoricalRevenue
        FROM tx, refd WHERE TransactionDate >= ref - 180 GROUP BY ProductID)""")
_direction = """CASE WHEN RevenueGrowthRate > 0.1::double THEN 'growing' WHEN RevenueGrowthRate < -0.1::double THEN 'declining'
  WHEN RevenueGrowthRate IS NOT NULL THEN 'stable' END AS TrendDirection"""
_sales_columns = ["TransactionCount:i", "TotalUnitsSold:i", "AvgQuantityPerTransaction:d", "TotalRevenue:d", "AvgRevenuePerTransaction:d",
                  "RevenuePerUnit:d", "ProfitMargin:d", "TotalProfit:d", "ProductAge:i", "SalesVelocity:d"]
_trend_columns = ["RecentUnitsSold:i", "RecentRevenue:d", "HistoricalUnitsSold:i", "HistoricalRevenue:d", "UnitsGrowthRate:d", "RevenueGrowthRate:d"]


@query("fea_10", mapped("p_sales", "ProductID:i", *_sales_columns, "FirstSaleDate", "LastSaleDate", "ProductName", "Category", "Price:d", "Cost:d"), "p_sales")
def _(t):
    return pf.calculate_product_performance(t.tx, t.products, t.ref)


@query("fea_11", f"""
  SELECT *, {D('TotalRevenue / UniqueCustomers')} AS RevenuePerCustomer, {D('TotalRevenue / UniqueProducts')} AS RevenuePerProduct,
         {D('TotalRevenue / sum(TotalRevenue) OVER ()')} AS RevenueShare
  FROM (SELECT Category, count(*) AS TransactionCount, count(DISTINCT CustomerID) AS UniqueCustomers,
          count(DISTINCT tx.ProductID) AS UniqueProducts, {I('sum(Quantity)')} AS TotalUnitsSold, {D('sum(LineTotal)')} AS TotalRevenue,
          {D(MEAN('LineTotal'))} AS AvgTransactionValue FROM tx JOIN products p ON p.ProductID = tx.ProductID GROUP BY Category)""",
       "tx", "products")
def _(t):
    return pf.calculate_category_performance(t.tx, t.products)


@query("fea_12", f"SELECT {I('ProductID')} AS ProductID, {', '.join(typed(c[:-2], WHOLE if c[-1] == 'i' else REAL) for c in _trend_columns)}, {_direction} FROM p_trend", "p_trend")
def _(t):
    return pf.calculate_product_trends(t.tx, t.products, t.ref)


@query("fea_13", f"""
  SELECT {I('CustomerID')} AS CustomerID, {I('ProductID')} AS ProductID, PurchaseCount, TotalQuantity, {D('TotalSpend')} AS TotalSpend,
         FirstPurchaseDate, LastPurchaseDate, DaysSinceLastPurchase, {D('r')} AS RecencyScore, {D('f')} AS FrequencyScore,
         {D('m')} AS MonetaryScore, {D('r * 0.3::double + f * 0.4::double + m * 0.3::double')} AS AffinityScore
  FROM (SELECT *, 1 - cast(DaysSinceLastPurchase AS double) / (max(DaysSinceLastPurchase) OVER () + 1) AS r,
          cast(PurchaseCount AS double) / (max(PurchaseCount) OVER () + 1) AS f,
          cast(TotalSpend AS double) / (cast(max(TotalSpend) OVER () AS double) + 1) AS m
        FROM (SELECT CustomerID, ProductID, count(*) AS PurchaseCount, {I('sum(Quantity)')} AS TotalQuantity,
                sum(LineTotal) AS TotalSpend, min(TransactionDate) AS FirstPurchaseDate, max(TransactionDate) AS LastPurchaseDate,
                datediff('day', max(TransactionDate), {REF}) AS DaysSinceLastPurchase FROM tx GROUP BY 1, 2))""", "tx", "refd")
def _(t):
    return pf.calculate_customer_product_affinity(t.tx, t.products)


@query("fea_14", f"""
  SELECT {I('a')} AS Product1, {I('b')} AS Product2, CoOccurrence, p1.ProductName AS Product1Name, p2.ProductName AS Product2Name
  FROM (SELECT t1.ProductID AS a, t2.ProductID AS b, count(*) AS CoOccurrence
        FROM (SELECT DISTINCT TransactionID, ProductID FROM lines) t1 JOIN (SELECT DISTINCT TransactionID, ProductID FROM lines) t2
          ON t1.TransactionID = t2.TransactionID AND t1.ProductID < t2.ProductID GROUP BY 1, 2)
  LEFT JOIN products p1 ON p1.ProductID = a LEFT JOIN products p2 ON p2.ProductID = b WHERE CoOccurrence >= 2""", "lines", "products")
def _(t):
    return baskets.calculate_cross_sell_opportunities(t.lines, t.products, 2)


@query("fea_15", f"""
  SELECT {I('p.ProductID')} AS ProductID, p.ProductName, p.Category, {D('p.Price')} AS Price, {D('p.Cost')} AS Cost,
         {', '.join(typed(c[:-2], WHOLE if c[-1] == 'i' else REAL, fill=True) for c in _sales_columns + _trend_columns)},
         FirstSaleDate, LastSaleDate, {_direction}
  FROM products p LEFT JOIN p_sales ON p_sales.ProductID = p.ProductID LEFT JOIN p_trend ON p_trend.ProductID = p.ProductID""",
       "products", "p_sales", "p_trend")
def _(t):
    return pf.create_product_feature_matrix(t.tx, t.products, t.ref)


@query("fea_16", f"""
  SELECT {I('TransactionID')} AS TransactionID, {I('sum(PointsEarned)')} AS PointsEarned, {I('sum(PointsRedeemed)')} AS PointsRedeemed,
         {I('arg_max(PointsBalance, LoyaltyRecordID)')} AS PointsBalance, arg_max(Tier, LoyaltyRecordID) AS Tier,
         {D('arg_max(PointsPerDollar, LoyaltyRecordID)')} AS PointsPerDollar FROM loyalty GROUP BY TransactionID""", "loyalty")
def _(t):
    return merge.loyalty_per_transaction(t.loyalty)


@query("fea_17", f"""
  SELECT {I('CustomerID')} AS CustomerID, {D(MEAN('SatisfactionScore'))} AS SatisfactionScore, {D(MEAN('NPSScore'))} AS NPSScore,
         CASE WHEN bool_or(WouldRecommend = 'Yes') THEN 'Yes' ELSE 'No' END AS WouldRecommend FROM surveys GROUP BY CustomerID""", "surveys")
def _(t):
    return merge.survey_per_customer(t.surveys)


# --- programme rules ------------------------------------------------------------------------------

@query("re_01", f"""
  SELECT row_number() OVER (ORDER BY CustomerID, LoyaltyRecordID) AS LoyaltyRecordID, {I('CustomerID')} AS CustomerID,
         {I('TransactionID')} AS TransactionID, TransactionDate, PointsEarned, PointsRedeemed, {I('PointsBalance')} AS PointsBalance,
         Tier, {D('PointsPerDollar')} AS PointsPerDollar, {D('CumulativeSpend')} AS CumulativeSpend FROM loyalty""", "loyalty")
def _(t):
    return t.ledger(True)


def _arriving(t: Tables, columns: list[str], parts: int = 4):
    """The sales as a stream of files that arrive in the order of their dates, ``parts`` spans of the calendar, two files each or more of large tables."""
    folder, sales = scratch_path(t.spark, "arriving"), t.tx.select(*columns)
    span = t.sold.agg(F.min("TransactionDate").alias("a"), F.max("TransactionDate").alias("b")).first()
    days = (span["b"] - span["a"]).days + 1
    part = F.floor(F.datediff("TransactionDate", F.lit(span["a"])) * parts / days)
    files = max(2, int(t.spark.conf.get("spark.sql.shuffle.partitions")) // (4 * parts))
    for i in range(parts):
        began = time.monotonic()
        sales.filter(part == i).repartition(files, "CustomerID").write.mode("append").parquet(folder)
        release_after(t.spark, began)
    return t.spark.readStream.schema(sales.schema).option("maxFilesPerTrigger", files).parquet(folder)


@query("re_01_stream", f"""
  SELECT {I('LoyaltyRecordID')} AS LoyaltyRecordID, {I('CustomerID')} AS CustomerID, {I('TransactionID')} AS TransactionID, TransactionDate,
         PointsEarned, PointsRedeemed, {I('PointsBalance')} AS PointsBalance, Tier, {D('PointsPerDollar')} AS PointsPerDollar,
         {D('CumulativeSpend')} AS CumulativeSpend FROM loyalty""", "loyalty")
def _(t):
    """The ledger of sales that arrive in several batches, from the state store."""
    stream = _arriving(t, [*LINE_ORDER, "CustomerID", "ReturnFlag"])
    path = scratch_path(t.spark, "ledger")
    redeemed = F.when(F.col("ReturnFlag") == "R", 500).otherwise(0)
    ledger.start_points_ledger(stream, path, scratch_path(t.spark, "ledger-state"), LINE_ORDER, redeemed, t.points).awaitTermination()
    return t.spark.read.parquet(path)


@query("flt_01_stream", f"""
  SELECT {I('CustomerID')} AS CustomerID, DATE '1970-01-01' + w * 30 AS WindowStart, DATE '1970-01-01' + w * 30 + 60 AS WindowEnd, count(*) AS Lines,
         {D('sum(LineTotal)')} AS Spend
  FROM (SELECT *, unnest([d // 30, d // 30 - 1]) AS w FROM (SELECT *, cast(TransactionDate - DATE '1970-01-01' AS integer) AS d FROM tx))
  WHERE DATE '1970-01-01' + w * 30 + 60 <= (SELECT ref FROM refd) - 7 GROUP BY CustomerID, w""", "tx", "refd")
def _(t):
    """Sliding windows of 60 days on event time: those that the watermark has closed."""
    path = scratch_path(t.spark, "sliding")
    stream = _arriving(t, ["CustomerID", "TransactionDate", "LineTotal"])
    windows.start_sliding_sales(stream, path, scratch_path(t.spark, "sliding-state"), length_days=60, slide_days=30).awaitTermination()
    return t.spark.read.parquet(path)


@query("re_04", f"""
  SELECT {I('TransactionID')} AS TransactionID, {I('ProductID')} AS ProductID, {I('LineNumber')} AS LineNumber, {I('q')} AS Quantity,
         {D('CASE WHEN lifted THEN cast(round(UnitPrice * q, 2) AS decimal(18,2)) ELSE LineTotal END')} AS LineTotal
  FROM (SELECT *, CASE WHEN lifted THEN least(Quantity + 1, 60) ELSE Quantity END AS q
        FROM (SELECT *, month(TransactionDate) IN (11, 12, 1, 2) AND (TransactionID * 7 + ProductID * 3 + LineNumber) % 100 < 30 AS lifted FROM tx))""", "tx")
def _(t):
    chosen = F.pmod(F.col("TransactionID") * 7 + F.col("ProductID") * 3 + F.col("LineNumber"), F.lit(100)) < 30
    lifted = loy.apply_seasonal_uplift(t.tx, chosen, most=60)
    return lifted.select("TransactionID", "ProductID", "LineNumber", "Quantity", "LineTotal")


@query("re_05", f"""
  SELECT CustomerID, {D('TotalSpend')} AS TotalSpend, {D('bias')} AS SatisfactionBias, score AS SatisfactionScore,
         {D('(score - 1) / 4::double * 10')} AS NPSBase,
         CASE WHEN round_even((score - 1) / 4::double * 10, 0) >= 7 THEN 'Yes' ELSE 'No' END AS WouldRecommend
  FROM (SELECT *, cast(greatest(1, least(5, round_even(base + bias, 0))) AS bigint) AS score
        FROM (SELECT {I('c.CustomerID')} AS CustomerID, TotalSpend, cast(c.CustomerID % 41 AS double) / 10 + 1 AS base,
                CASE WHEN TotalSpend IS NULL THEN 0 WHEN TotalSpend / 100 > 5000 THEN 0.3::double
                     WHEN TotalSpend / 100 > 2000 THEN 0.1::double ELSE -0.1::double END AS bias
              FROM customers c LEFT JOIN (SELECT CustomerID, sum(LineTotal) AS TotalSpend FROM tx GROUP BY 1) s
                ON s.CustomerID = c.CustomerID))""", "customers", "tx")
def _(t):
    base = F.pmod(F.col("CustomerID"), F.lit(41)).cast("double") / 10 + 1
    return loy.survey_expectations(t.customers, t.tx, base, 100)


# --- KPIs ------------------------------------------------------------------------------------------

def _predictions(t: Tables) -> DataFrame:
    return churn.risk_table(t.scored)


@query("kpi_01", f"""
  SELECT (SELECT count(*) FROM customers) AS total_customers, {D('sum(LineTotal)')} AS total_revenue,
         {D(MEAN('LineTotal'))} AS avg_transaction_value, count(*) AS total_transactions, count(DISTINCT ProductID) AS unique_products,
         (SELECT count(*) FILTER (ChurnPrediction = 0) FROM predictions) AS active_customers,
         (SELECT {D('count(*) FILTER (ChurnPrediction = 1) / count(*)::double * 100')} FROM predictions) AS churn_rate,
         (SELECT {D('sum(LifetimeValue::decimal(18,2))::double / count(*)')} FROM features) AS avg_lifetime_value FROM tx""",
       "tx", "customers", "predictions", "features")
def _(t):
    spent = t.tx.groupBy("CustomerID").agg(F.sum("LineTotal").alias("LifetimeValue"))
    value = t.customers.select("CustomerID").join(spent, "CustomerID", "left").fillna(0, ["LifetimeValue"])
    return kpis.kpi_metrics(t.tx, t.customers, _predictions(t), value)


@query("kpi_02", f"SELECT strftime(TransactionDate, '%Y-%m') AS YearMonth, {D('sum(LineTotal)')} AS LineTotal FROM tx GROUP BY 1", "tx")
def _(t):
    return kpis.monthly_revenue(t.tx)


TABLES["k_products"] = (["lines", "products"], f"""
  SELECT {I('p.ProductID')} AS ProductID, ProductName, Category, {D('sum(LineTotal)')} AS TotalRevenue,
         {I('sum(Quantity)')} AS TotalQuantity, count(*) AS TransactionCount
  FROM lines JOIN products p ON p.ProductID = lines.ProductID GROUP BY ALL""")


@query("kpi_03", "SELECT * FROM k_products", "k_products")
def _(t):
    return kpis.product_revenue(t.lines, t.products)


@query("top_01", "SELECT * FROM k_products ORDER BY TotalRevenue DESC, ProductID LIMIT 1000", "k_products")
def _(t):
    return kpis.top_product_revenue(t.lines, t.products, 1000)


@query("kpi_15", """
  SELECT *, round_even(TotalRevenue / TotalQuantity, 2) AS AvgPrice FROM k_products ORDER BY TotalRevenue DESC, ProductID LIMIT 20""",
       "k_products")
def _(t):
    return kpis.top_products_with_price(t.lines, t.products, 20)


TABLES["k_categories"] = (["k_products"], f"""
  SELECT Category, {D('sum(TotalRevenue)')} AS TotalRevenue, {I('sum(TotalQuantity)')} AS TotalQuantity,
         {I('sum(TransactionCount)')} AS TransactionCount
  FROM (SELECT Category, TotalRevenue::decimal(18,2) AS TotalRevenue, TotalQuantity, TransactionCount FROM k_products) GROUP BY 1""")


@query("kpi_04", "SELECT * FROM k_categories", "k_categories")
def _(t):
    return kpis.category_revenue(t.lines, t.products)


@query("kpi_16", f"SELECT Category, TotalRevenue, {D('TotalRevenue / sum(TotalRevenue) OVER ()')} AS RevenueShare FROM k_categories", "k_categories")
def _(t):
    return kpis.category_share(t.lines, t.products)


_means = {"AvgRecency": "Recency", "AvgFrequency": "Frequency", "AvgTotalSpend": "TotalSpend", "AvgLifetimeValue": "LifetimeValue",
          "AvgPointsBalance": "CurrentPointsBalance", "AvgTier": "TierNumeric"}
TABLES["k_means"] = (["features", "seg_labels"], "SELECT Segment, " + ", ".join(f"avg({c}) AS {n}" for n, c in _means.items())
                     + " FROM features JOIN seg_labels ON seg_labels.CustomerID = features.CustomerID GROUP BY Segment")
TABLES["k_names"] = (["k_means"], """
  SELECT Segment, CASE WHEN r <= 30 AND f >= 20 AND s >= 5000 THEN 'Champions' WHEN r <= 60 AND f >= 10 AND s >= 2000 THEN 'Loyal Customers'
    WHEN r <= 90 AND f >= 5 THEN 'Potential Loyalists' WHEN r <= 30 AND f <= 5 THEN 'New Customers' WHEN r > 90 AND f >= 10 THEN 'At Risk'
    WHEN r > 180 THEN 'Lost' WHEN t >= 3 AND p >= 25000 THEN 'High-Value Loyal' WHEN l >= 10000 THEN 'High-Value'
    WHEN r > 90 AND r <= 180 AND f >= 5 AND f < 10 AND s >= 2000 THEN 'Dormant Customers'
    WHEN r > 90 AND f < 10 AND s >= 2000 THEN 'Moderate Customers' WHEN r <= 120 AND f >= 5 AND s >= 1000 THEN 'Regular Customers'
    WHEN f >= 5 THEN 'Occasional Customers' ELSE 'Low Engagement' END AS SegmentName
  FROM (SELECT Segment, AvgRecency AS r, AvgFrequency AS f, AvgTotalSpend / 100 AS s, AvgTier AS t, AvgPointsBalance AS p,
               AvgLifetimeValue / 100 AS l FROM k_means)""")


def _names(t: Tables) -> DataFrame:
    return seg.assign_segment_names(t.features, t.labels, 100)


@query("seg_06", f"SELECT {I('Segment')} AS Segment, SegmentName FROM k_names", "k_names")
def _(t):
    return _names(t)


TABLES["k_segments"] = (["seg_labels", "k_names"], """
  SELECT l.Segment AS Cluster, SegmentName AS Segment, count(*) AS Count,
         round_even(count(*) / sum(count(*)) OVER ()::double * 100, 2) AS Percentage
  FROM seg_labels l JOIN k_names ON k_names.Segment = l.Segment GROUP BY 1, 2""")
TABLES["k_risks"] = (["predictions"], """
  SELECT RiskLevel, count(*) AS Count, count(*) / (SELECT count(*) FROM predictions)::double * 100 AS share
  FROM predictions WHERE RiskLevel IS NOT NULL GROUP BY 1""")


@query("kpi_05", f"SELECT {I('Cluster')} AS Cluster, Segment, Count, Percentage FROM k_segments", "k_segments")
def _(t):
    return kpis.segment_distribution(t.labels, _names(t))


@query("kpi_06", "SELECT RiskLevel, Count, round_even(share, 2) AS Percentage FROM k_risks", "k_risks")
def _(t):
    return kpis.risk_distribution(_predictions(t))


_insights_sql = """
  SELECT arg_max(Segment, Count * 10 - Cluster) AS TopSegment, arg_max(Percentage, Count * 10 - Cluster) AS TopSegmentPercentage,
         (SELECT coalesce(sum(Count), 0)::bigint FROM k_risks WHERE RiskLevel = 'Critical') AS CriticalCount,
         (SELECT coalesce(sum(round_even(share, 2)), 0) FROM k_risks WHERE RiskLevel = 'Critical') AS CriticalPercentage FROM k_segments"""


def _insights(t: Tables) -> DataFrame:
    return kpis.headline_insights(kpis.segment_distribution(t.labels, _names(t)), kpis.risk_distribution(_predictions(t)))


@query("kpi_07", _insights_sql, "k_segments", "k_risks")
def _(t):
    return _insights(t)


@query("kpi_08", f"""
  SELECT {D('max(q)')} AS Threshold, count(*) FILTER (LifetimeValue > q) AS HighValueCount
  FROM features, (SELECT quantile_cont(LifetimeValue, 0.75) AS q FROM features)""", "features")
def _(t):
    return kpis.high_value_customers(t.features)


@query("kpi_09", f"""
  SELECT Action, {D('Measure')} AS Measure FROM (
    SELECT 'Urgent' AS Action, CriticalPercentage AS Measure, CriticalPercentage > 10 AS fires FROM i
    UNION ALL SELECT 'Focus', TopSegmentPercentage, TopSegmentPercentage > 40 FROM i
    UNION ALL SELECT 'Opportunity', v, v < 1000 FROM (SELECT sum(LifetimeValue::decimal(18,2))::double / count(*) AS v FROM features)) WHERE fires""".replace(
    " FROM i", f" FROM ({_insights_sql})"), "k_segments", "k_risks", "features")
def _(t):
    return kpis.recommended_actions(_insights(t), t.features)


@query("kpi_10", f"""
  SELECT SegmentName, {D('avg(Recency)')} AS Recency, {D('avg(Frequency)')} AS Frequency,
         {D('sum(LifetimeValue::decimal(18,2))::double / count(*)')} AS LifetimeValue, {D('avg(CurrentPointsBalance)')} AS CurrentPointsBalance
  FROM features f JOIN seg_labels l ON l.CustomerID = f.CustomerID JOIN k_names n ON n.Segment = l.Segment GROUP BY 1""",
       "features", "seg_labels", "k_names")
def _(t):
    return kpis.metrics_by_segment_name(t.features, t.labels, _names(t))


@query("kpi_11", f"SELECT RiskLevel, Count, {D('share')} AS Percentage FROM k_risks", "k_risks")
def _(t):
    return kpis.risk_summary(_predictions(t))


_risk_row = f"""SELECT {I('CustomerID')} AS CustomerID, ChurnProbability, {I('ChurnPrediction')} AS ChurnPrediction, RiskLevel,
  CASE ChurnPrediction WHEN 1 THEN 'Churned' ELSE 'Active' END AS Status FROM predictions"""


@query("kpi_12", f"{_risk_row} WHERE RiskLevel = 'Critical'", "predictions")
def _(t):
    return kpis.at_risk_customers(_predictions(t), "Critical", None)


@query("top_03", f"{_risk_row} ORDER BY ChurnProbability DESC, predictions.CustomerID LIMIT 100", "predictions")
def _(t):
    return kpis.at_risk_customers(_predictions(t))


@query("kpi_13", f"""
  SELECT TierNumeric, CASE TierNumeric WHEN 1 THEN 'Bronze' WHEN 2 THEN 'Silver' WHEN 3 THEN 'Gold' WHEN 4 THEN 'Platinum'
           ELSE 'Tier ' || TierNumeric END AS Tier, count(*) AS Count, {D('count(*) / sum(count(*)) OVER ()::double * 100')} AS Percentage
  FROM features GROUP BY TierNumeric""", "features")
def _(t):
    return kpis.tier_shares(t.features)


@query("kpi_14", f"""
  SELECT {D('sum(CurrentPointsBalance)::double / count(*)')} AS AvgPointsBalance, {I('sum(CurrentPointsBalance)')} AS TotalPoints,
         {I('max(CurrentPointsBalance)')} AS MaxPoints, {I('sum(TotalPointsEarned)')} AS TotalPointsEarned FROM features""", "features")
def _(t):
    return kpis.points_statistics(t.features)


# --- model preparation and models -------------------------------------------------------------------

_rfm_numeric = [c for c in cf.RFM_COLUMNS if c != "CustomerID" and FEATURES[c][1] != "text"]


def _correlation_sql() -> str:
    parts = []
    for j, name in enumerate(_rfm_numeric):
        tests = [f"coalesce(abs(corr({earlier}::double, {name}::double)) > 0.95, false)" for earlier in _rfm_numeric[:j]]
        parts.append(f"SELECT '{name}' AS Feature, {' OR '.join(tests) or 'bool_or(false)'} AS Dropped FROM f_rfm")
    return " UNION ALL ".join(parts)


@query("ml_01", _correlation_sql(), "f_rfm")
def _(t):
    base = cf.calculate_rfm_features(t.tx, t.ref)
    dropped = set(ml_prep.identify_highly_correlated_features(base))
    return t.spark.createDataFrame([(c, c in dropped) for c in _rfm_numeric], "Feature string, Dropped boolean")


@query("ml_03", "SELECT CustomerID, " + ", ".join(
    D(f"({c}::double - avg({c}::double) OVER ()) / coalesce(nullif(stddev_pop({c}::double) OVER (), 0), 1)") + f" AS {c}" for c in _rfm_numeric)
    + " FROM f_rfm", "f_rfm")
def _(t):
    base = cf.calculate_rfm_features(t.tx, t.ref).select("CustomerID", *_rfm_numeric)
    return ml_prep.scale_features(base)[0]


@query("ml_04")
def _(t):
    return ml_prep.prepare_features_for_ml(t.features, target_column="TierNumeric")["features"]


_matrix_features = [n for n, (_, kind) in FEATURES.items() if kind in (WHOLE, REAL)]


def _uncorrelated_sql(names: list[str]) -> str:
    """The features whose correlation with no earlier one is beyond 0.95 either way; tier is the target."""
    def kept(i: int) -> str:
        far = " OR ".join([f"coalesce(abs(CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({names[i]}) > 0 THEN corr({a}, {names[i]}) END) > 0.95, false)"
                           for a in names[:i]]) or "false"
        return f"SELECT '{names[i]}' AS Feature, NOT ({far}) AS kept, stddev_pop({names[i]}::double) > 0 AS varies FROM features"

    return ("SELECT Feature, true AS Centred, varies AS UnitSpread, (SELECT count(*) FROM features)::bigint AS Customers FROM ("
            + " UNION ALL ".join(kept(i) for i in range(len(names))) + ") WHERE kept")


_in_matrix = [c for c in cf.MATRIX_COLUMNS if c in _matrix_features]


@query("ml_04_rules", _uncorrelated_sql([c for c in _in_matrix if c != "TierNumeric"]), "features")
def _(t):
    """The features that are kept beside earlier ones, scaled: mean 0, and deviation 1 where a feature varies at all."""
    ready = ml_prep.prepare_features_for_ml(t.features.drop("IsActive"), target_column="TierNumeric")
    kept = [c for c in ready["feature_names"] if c in _matrix_features]
    row = stage(ready["features"]).agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s"), F.count(c).alias("n")).alias(c) for c in kept])
    long = row.unpivot([], kept, "Feature", "v")
    return long.select("Feature", (F.abs("v.m") < 1e-9).alias("Centred"), (F.abs(F.col("v.s") - 1) < 1e-9).alias("UnitSpread"), F.col("v.n").alias("Customers"))


@query("ml_05", " UNION ALL ".join(
    f"SELECT '{c}' AS Feature, {D(f'avg({c})')} AS Mean, {D(f'stddev_samp({c})')} AS Std, {D(f'min({c})')} AS Min, {D(f'max({c})')} AS Max, "
    f"0::bigint AS Missing, 0::double AS MissingPct FROM f_rfm" for c in _rfm_numeric), "f_rfm")
def _(t):
    return ml_prep.get_feature_summary(cf.calculate_rfm_features(t.tx, t.ref))


@query("fea_quantiles", "SELECT " + ", ".join(D(f"quantile_cont({c}::double, 0.25)") + f" AS {c}" for c in _rfm_numeric) + " FROM f_rfm", "f_rfm")
def _(t):
    return quantiles(cf.calculate_rfm_features(t.tx, t.ref), [], _rfm_numeric, 0.25)


_profile = ("mean", "avg({0})"), ("median", "quantile_cont({0}::double, 0.5)"), ("std", "stddev_samp({0})"), ("min", "min({0})"), ("max", "max({0})")


@query("seg_05", " UNION ALL ".join(
    f"SELECT {I('Segment')} AS Segment, '{c}' AS Feature, "
    + ", ".join(f"round_even(cast({e.format(c)} AS double), 2) AS {n}" for n, e in _profile)
    + f", count({c})::double AS count FROM f_rfm JOIN seg_labels l ON l.CustomerID = f_rfm.CustomerID GROUP BY Segment" for c in _rfm_numeric),
    "f_rfm", "seg_labels")
def _(t):
    base = cf.calculate_rfm_features(t.tx, t.ref).select("CustomerID", *_rfm_numeric)
    return seg.profile_rows(seg.profile_segments(base, t.labels))


@query("seg_01", "SELECT CustomerID, " + ", ".join(
    c for g in ("rfm", "seasonal") for c in seg.FEATURE_GROUPS[g] if c in FEATURES) + " FROM features", "features")
def _(t):
    return seg.select_features_for_clustering(t.features, ("rfm", "seasonal"))


@query("seg_02")
def _(t):
    return seg.prepare_features_for_clustering(seg.select_features_for_clustering(t.features), use_pca=True)[0]


@query("seg_02_rules", "SELECT (SELECT count(*) FROM features)::bigint AS Customers, true AS Centred, true AS Uncorrelated, true AS Falling, "
       "true AS EnoughVariance, true AS NoneTooMany", "features")
def _(t):
    """Components have mean 0, don't correlate, vary less and less, and are just enough for 95 % of the scaled features' variance."""
    selected = seg.select_features_for_clustering(t.features)
    whole = seg.prepare_features_for_clustering(selected)[0]
    reduced = stage(seg.prepare_features_for_clustering(selected, use_pca=True)[0])
    parts, columns = [c for c in reduced.columns if c != "CustomerID"], [c for c in whole.columns if c != "CustomerID"]
    total = sum(whole.agg(*[F.var_samp(c) for c in columns]).first())
    got = reduced.agg(F.count(F.lit(1)), *[F.avg(c) for c in parts], *[F.var_samp(c) for c in parts]).first()
    means, spread = got[1:1 + len(parts)], got[1 + len(parts):]
    pairs = [(a, b) for i, a in enumerate(parts) for b in parts[:i]]
    together = reduced.agg(*[F.abs(F.covar_samp(a, b)).alias(f"{a}_{b}") for a, b in pairs]).first() if pairs else []
    facts = {"Centred": max(map(abs, means)) < 1e-9, "Uncorrelated": max(together, default=0.0) < 1e-6, "Falling": list(spread) == sorted(spread, reverse=True),
             "EnoughVariance": sum(spread) > 0.95 * total, "NoneTooMany": sum(spread[:-1]) <= 0.95 * total}
    return reduced.agg(F.count(F.lit(1)).alias("Customers")).select("Customers", *[F.lit(bool(v)).alias(n) for n, v in facts.items()])


@query("seg_03")
def _(t):
    prepared = seg.prepare_features_for_clustering(seg.select_features_for_clustering(t.features))[0]
    return seg.find_optimal_k_clusters(prepared)


@query("seg_04")
def _(t):
    prepared = seg.prepare_features_for_clustering(seg.select_features_for_clustering(t.features))[0]
    return seg.perform_kmeans_clustering(prepared)[1]


@query("seg_04_nearest", f"SELECT {I('CustomerID')} AS CustomerID, true AS AtNearestCentre FROM features", "features")
def _(t):
    """Every customer carries the label of the centre closest to it."""
    prepared = seg.prepare_features_for_clustering(seg.select_features_for_clustering(t.features))[0]
    model, labels = seg.perform_kmeans_clustering(prepared)
    columns = [c for c in prepared.columns if c != "CustomerID"]
    far = [sum((F.pow(F.col(c) - F.lit(float(x)), 2) for c, x in zip(columns, centre)), F.lit(0.0)) for centre in model.clusterCenters()]
    own = F.element_at(F.array(*far), F.col("Segment") + 1)
    return prepared.join(labels, "CustomerID").select("CustomerID", (own <= F.least(*far) + 1e-9).alias("AtNearestCentre"))


@query("seg_03_rules", "SELECT cast(k AS bigint) AS K, true AS CostFalls, true AS SilhouetteFollows, true AS BestIsHighest FROM range(3, 9) r(k)")
def _(t):
    """More centres cost less; the silhouette marked best is the highest, and is what Spark's evaluator finds for the labels of its K."""
    prepared = seg.prepare_features_for_clustering(seg.select_features_for_clustering(t.features))[0]
    scores = stage(seg.find_optimal_k_clusters(prepared))
    best = scores.filter("IsBest").first()
    labels = seg.perform_kmeans_clustering(prepared, best["K"])[1]
    columns = [c for c in prepared.columns if c != "CustomerID"]
    judged = VectorAssembler(inputCols=columns, outputCol="features").transform(prepared.join(labels, "CustomerID"))
    again = ClusteringEvaluator(predictionCol="Segment", featuresCol="features").evaluate(judged)
    after = scores.select((F.col("K") - 1).alias("_before"), F.col("WCSS").alias("_next"))
    falls = F.coalesce(F.col("_next") < F.col("WCSS"), F.col("K") == 8)
    highest = F.col("IsBest") == (F.col("Silhouette") == F.lit(best["Silhouette"]))
    follows = ~F.col("IsBest") | (F.abs(F.col("Silhouette") - F.lit(float(again))) < 1e-9)
    return scores.join(after, scores["K"] == after["_before"], "left").select(
        "K", falls.alias("CostFalls"), follows.alias("SilhouetteFollows"), (highest & (F.col("Silhouette") <= F.lit(best["Silhouette"]))).alias("BestIsHighest"))


@query("seg_04_rules", f"SELECT {I('s')} AS Segment, true AS HasCustomers, true AS CentreIsMean, (SELECT count(*) FROM features)::bigint AS Customers, "
       "true AS CostFollows FROM range(5) r(s)", "features")
def _(t):
    """Five segments that hold every customer once; each centre is its members' mean, and the cost their squared distance from it."""
    prepared = seg.prepare_features_for_clustering(seg.select_features_for_clustering(t.features))[0]
    model, labels = seg.perform_kmeans_clustering(prepared)
    columns = [c for c in prepared.columns if c != "CustomerID"]
    joined = stage(prepared.join(labels, "CustomerID"))
    means = joined.groupBy("Segment").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.avg(c) for c in columns]).alias("m"))
    own = joined.join(means, "Segment").select(sum((F.pow(F.col(c) - F.col("m")[i], 2) for i, c in enumerate(columns)), F.lit(0.0)).alias("d"))
    cost, customers = own.agg(F.sum("d")).first()[0], joined.count()
    centres = model.as_table(t.spark).select(F.col("Segment").alias("_of"), "Centre")
    off = F.aggregate(F.zip_with("m", "Centre", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda held, x: F.greatest(held, x))
    return centres.join(means, centres["_of"] == means["Segment"], "left").select(
        F.col("_of").alias("Segment"), (F.col("n") > 0).alias("HasCustomers"), (off < 1e-3).alias("CentreIsMean"), F.lit(customers).cast("long").alias("Customers"),
        F.lit(abs(cost - model.cost) <= 1e-6 * model.cost).alias("CostFollows"))


@query("seg_07_rules", f"""
  SELECT (SELECT count(*) FROM features)::bigint AS Customers, 100.0::double AS Share, true AS Named, true AS ProfilesAddUp,
         {D('sum(TotalSpend)')} AS TotalSpend FROM features""", "features")
def _(t):
    """The whole job: sizes, shares and mean spends of the segments add up to those of all customers."""
    found = seg.perform_customer_segmentation(t.features)
    shares = kpis.segment_distribution(found.labels, found.names)
    size, spend = F.col("SegmentSize"), F.col("AvgTotalSpend") * F.col("SegmentSize")
    totals = found.profiles.agg(F.sum(size).alias("n"), F.sum(spend).alias("s"), F.count(F.lit(1)).alias("k")).first()
    named = found.names.join(found.profiles.select("Segment"), "Segment").filter("SegmentName IS NOT NULL").count()
    told = {c: t for c, t in shares.dtypes}
    share = next(c for c in told if "ercent" in c)
    return shares.agg(F.lit(totals["n"]).cast("long").alias("Customers"), F.round(F.sum(share)).cast("double").alias("Share"),
                      F.lit(named == totals["k"] == found.n_clusters).alias("Named"), F.lit(totals["n"] == t.features.count()).alias("ProfilesAddUp"),
                      F.lit(float(totals["s"])).alias("TotalSpend"))


@query("seg_07")
def _(t):
    found = seg.perform_customer_segmentation(t.features)
    return kpis.segment_distribution(found.labels, found.names)


@query("chn_01", f"""
  SELECT {I('CustomerID')} AS CustomerID, {I('datediff(\'day\', max(TransactionDate), max(ref)) > 90')} AS Churn,
         datediff('day', max(TransactionDate), max(ref)) AS DaysSinceLastPurchase, max(TransactionDate) AS LastPurchaseDate
  FROM tx, refd GROUP BY CustomerID""", "tx", "refd")
def _(t):
    return churn.create_churn_target(t.tx, t.ref)


@query("chn_02", "SELECT f.*, cast(datediff('day', last, (SELECT ref FROM refd)) > 90 AS bigint) AS Churn FROM (SELECT CustomerID, "
       + ", ".join(c for c in _rfm_numeric) + f" FROM ({_features_sql('f_rfm', cf.RFM_COLUMNS)})) f "
       "JOIN (SELECT CustomerID, max(TransactionDate) AS last FROM tx GROUP BY 1) t ON t.CustomerID = f.CustomerID", "f_rfm", "tx", "refd")
def _(t):
    target = churn.create_churn_target(t.tx, t.ref)
    ready = churn.prepare_churn_features(cf.calculate_rfm_features(t.tx, t.ref), target)
    whole = [c for c in _rfm_numeric if FEATURES[c][1] == WHOLE]
    return ready.select(*[F.col(c).cast("bigint").alias(c) if c in whole else F.col(c) for c in ready.columns])


TABLES["h_cut"] = (["tx"], """
  SELECT min(TransactionDate) + cast(floor(datediff('day', min(TransactionDate), max(TransactionDate)) * 0.8::double) AS integer) AS cut,
         max(TransactionDate) AS last FROM tx""")


@query("chn_03", f"""
  WITH_CUT SELECT 'train' AS Part, {I('a.CustomerID')} AS CustomerID, {I('datediff(\'day\', a.d, cut) > 90')} AS Churn FROM a JOIN b ON a.CustomerID = b.CustomerID, h_cut
  UNION ALL SELECT 'test', {I('b.CustomerID')}, {I('datediff(\'day\', b.d, last) > 90')} FROM a JOIN b ON a.CustomerID = b.CustomerID, h_cut""".replace(
    "WITH_CUT ", "").replace("FROM a JOIN b", """FROM (SELECT CustomerID, max(TransactionDate) AS d FROM tx, h_cut WHERE TransactionDate <= cut GROUP BY 1) a
  JOIN (SELECT CustomerID, max(TransactionDate) AS d FROM tx, h_cut WHERE TransactionDate > cut GROUP BY 1) b"""), "tx", "h_cut")
def _(t):
    train, test = churn.temporal_targets(t.tx)
    parts = [df.select(F.lit(n).alias("Part"), "CustomerID", "Churn") for n, df in (("train", train), ("test", test))]
    return parts[0].unionByName(parts[1])


def _training_frame(t: Tables) -> DataFrame:
    target = churn.create_churn_target(t.tx, t.ref)
    columns = ["CustomerID", *cf.ENGAGEMENT_COLUMNS[1:]]
    return churn.prepare_churn_features(cf.calculate_engagement_features(t.tx, t.products).select(*columns), target)


@query("chn_04", f"""
  SELECT {I('Churn')} AS Churn, (SELECT max(n) FROM c)::bigint AS Rows FROM c""".replace(
    "FROM c", """FROM (SELECT Churn, count(*) AS n FROM (SELECT CustomerID, cast(datediff('day', max(TransactionDate), max(ref)) > 90 AS integer) AS Churn
        FROM tx, refd GROUP BY 1) GROUP BY 1)"""), "tx", "refd")
def _(t):
    balanced = churn.handle_class_imbalance(_training_frame(t))
    return balanced.groupBy("Churn").agg(F.count(F.lit(1)).alias("Rows"))


def _whole_training_frame(t: Tables) -> DataFrame:
    return stage(churn.prepare_churn_features(t.features, churn.create_churn_target(t.tx, t.ref)))


@query("chn_05")
def _(t):
    model = churn.train_churn_model(_whole_training_frame(t))
    return churn.calculate_feature_importance(model, t.spark)


TABLES["h_conf"] = (["scored"], """
  SELECT count(*) FILTER (ChurnProbability < 0.5 AND Churn = 0) AS tn, count(*) FILTER (ChurnProbability >= 0.5 AND Churn = 0) AS fp,
         count(*) FILTER (ChurnProbability < 0.5 AND Churn = 1) AS fn, count(*) FILTER (ChurnProbability >= 0.5 AND Churn = 1) AS tp FROM scored""")
TABLES["h_auc"] = (["scored"], """
  SELECT (sum(avg_rank) FILTER (Churn = 1) - p * (p + 1) / 2::double) / (p * n) AS auc
  FROM (SELECT Churn, avg(rn) OVER (PARTITION BY ChurnProbability) AS avg_rank, count(*) FILTER (Churn = 1) OVER () AS p,
          count(*) FILTER (Churn = 0) OVER () AS n
        FROM (SELECT *, row_number() OVER (ORDER BY ChurnProbability) AS rn FROM scored)) GROUP BY p, n""")


@query("chn_06", f"""
  SELECT {D('tp / (tp + fp)::double')} AS Precision, {D('tp / (tp + fn)::double')} AS Recall, {D('2 * tp / (2 * tp + fp + fn)::double')} AS F1,
         {D('auc')} AS RocAuc, {D('(tp + tn) / (tp + tn + fp + fn)::double')} AS Accuracy, tn AS TrueNegatives, fp AS FalsePositives,
         fn AS FalseNegatives, tp AS TruePositives FROM h_conf, h_auc""", "h_conf", "h_auc")
def _(t):
    return churn.evaluate_scores(t.scored)


@query("chn_06_report", f"""
  SELECT Label, {D('p')} AS Precision, {D('r')} AS Recall, {D('f')} AS F1, {I('s')} AS Support FROM (
    SELECT * FROM c UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(s) FROM c
    UNION ALL SELECT 'weighted avg', sum(p * s) / sum(s), sum(r * s) / sum(s), sum(f * s) / sum(s), sum(s) FROM c)""".replace("FROM c", """FROM (
    SELECT '0' AS Label, tn / (tn + fn)::double AS p, tn / (tn + fp)::double AS r, 2 * tn / (2 * tn + fp + fn)::double AS f, tn + fp AS s FROM h_conf
    UNION ALL SELECT '1', tp / (tp + fp)::double, tp / (tp + fn)::double, 2 * tp / (2 * tp + fp + fn)::double, tp + fn FROM h_conf)"""), "h_conf")
def _(t):
    return churn.classification_report(t.scored)


@query("chn_08")
def _(t):
    frame = _whole_training_frame(t)
    return churn.explain_by_permutation(churn.train_churn_model(frame), frame)


_model_features = [n for n, (_, kind) in FEATURES.items() if kind in (WHOLE, REAL)]


@query("chn_08_values", " UNION ALL ".join(
    f"SELECT {I('CustomerID')} AS CustomerID, '{c}' AS Feature, {D(c)} AS FeatureValue, true AS AddsUp, true AS MatchesScore FROM f" for c in _model_features).replace(
    "FROM f", "FROM (SELECT * FROM features WHERE CustomerID IN (SELECT CustomerID FROM tx))"), "features", "tx")
def _(t):
    """What every feature of every customer added to the score: with the base value it is the log-odds of the churn probability."""
    frame = _whole_training_frame(t)
    model = churn.train_churn_model(frame)
    explained = stage(explanations.explain_customers(model, frame))
    each = explained.groupBy("CustomerID").agg(F.sum("Contribution").alias("_sum"), F.first("BaseValue").alias("_base"), F.first("LogOdds").alias("_odds"))
    scored = churn.churn_probability(model, frame).select(F.col("CustomerID").alias("_id"), "ChurnProbability")
    total = F.col("_sum") + F.col("_base")
    sums = each.join(scored, each["CustomerID"] == scored["_id"]).select(
        "_id", (F.abs(total - F.col("_odds")) < 1e-6).alias("AddsUp"),
        (F.abs(1 / (1 + F.exp(-total)) - F.col("ChurnProbability")) < 1e-9).alias("MatchesScore"))
    return explained.join(sums, explained["CustomerID"] == sums["_id"]).select("CustomerID", "Feature", "FeatureValue", "AddsUp", "MatchesScore")


@query("snk_07_loaded", f"SELECT {I('CustomerID')} AS CustomerID, true AS SameSegment, true AS SameName FROM features", "features")
def _(t):
    """Every customer gets the same segment from the segmentation read back from its files."""
    found = seg.perform_customer_segmentation(t.features, 5)
    path = scratch_path(t.spark, "segmentation")
    seg.save_segmentation_results(found, path)
    again = seg.load_segmentation(t.spark, path).assign(t.features)
    first = found.labels.join(found.names, "Segment").select(F.col("CustomerID").alias("_id"), F.col("Segment").alias("_s"), F.col("SegmentName").alias("_n"))
    return again.join(first, again["CustomerID"] == first["_id"], "left").select(
        "CustomerID", F.col("Segment").eqNullSafe(F.col("_s")).alias("SameSegment"), F.col("SegmentName").eqNullSafe(F.col("_n")).alias("SameName"))


@query("snk_08_loaded", f"SELECT {I('CustomerID')} AS CustomerID, true AS SameScore, true AS SameRisk FROM features", "features")
def _(t):
    """Every customer gets the same churn risk from the model read back from its files."""
    model = churn.train_churn_model(_whole_training_frame(t))
    found = churn.ChurnResults(model, *[churn.calculate_feature_importance(model, t.spark)] * 3, None, churn.predict_churn_risk(model, t.features),
                               t.spark.range(0).toDF("CustomerID"))
    path = scratch_path(t.spark, "churn")
    churn.save_churn_model(found, path)
    first = t.spark.read.parquet(f"{path}/churn_predictions.parquet").toDF("_id", "_p", "_c", "_r")
    again = churn.predict_churn_risk(churn.load_churn_model(path), t.features)
    return again.join(first, again["CustomerID"] == first["_id"], "left").select(
        "CustomerID", F.col("ChurnProbability").eqNullSafe(F.col("_p")).alias("SameScore"),
        (F.col("ChurnPrediction").eqNullSafe(F.col("_c")) & F.col("RiskLevel").eqNullSafe(F.col("_r"))).alias("SameRisk"))


@query("chn_05_rules", " UNION ALL ".join(f"SELECT '{c}' AS Feature, true AS IsShare, true AS SumsToOne, true AS DropFollows" for c in _model_features))
def _(t):
    """Importances are shares of 1; a feature that no tree splits on has none, and exchanging its values changes nothing."""
    frame = _whole_training_frame(t)
    model = churn.train_churn_model(frame)
    shares, drops = stage(churn.calculate_feature_importance(model, t.spark)), stage(churn.explain_by_permutation(model, frame))
    whole = shares.agg(F.sum("Importance")).first()[0]
    both = shares.join(drops.select(F.col("Feature").alias("_of"), "AucDrop"), F.col("Feature") == F.col("_of"), "left")
    follows = F.col("AucDrop").isNotNull() & ((F.col("Importance") > 0) | (F.abs("AucDrop") < 1e-12)) & F.col("AucDrop").between(-1, 1)
    return both.select("Feature", F.col("Importance").between(0, 1).alias("IsShare"), F.lit(abs(whole - 1) < 1e-9).alias("SumsToOne"), follows.alias("DropFollows"))


@query("chn_04_whole", f"""
  SELECT {I('Churn')} AS Churn, {I('n')} AS Given, {I('max(n) OVER ()')} AS Rows, true AS InRange
  FROM (SELECT Churn, count(*) AS n FROM (SELECT CustomerID, cast(datediff('day', max(TransactionDate), max(ref)) > 90 AS integer) AS Churn
        FROM tx, refd GROUP BY 1) GROUP BY 1)""", "tx", "refd")
def _(t):
    """Oversampling of the whole feature matrix: parity, and made rows within the range of their class in every feature."""
    frame = _whole_training_frame(t)
    balanced = stage(churn.handle_class_imbalance(frame))
    columns = churn.feature_columns(frame)
    ends = frame.groupBy("Churn").agg(F.count(F.lit(1)).alias("Given"), *[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("a", F.min), ("z", F.max))])
    found = balanced.groupBy("Churn").agg(F.count(F.lit(1)).alias("Rows"), *[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("a", F.min), ("z", F.max))])
    inside = F.lit(True)
    for c in columns:  # a made row lies between two given ones, but for the rounding of doubles
        inside = inside & (F.col(f"f.a_{c}") >= F.col(f"e.a_{c}") - 1e-6) & (F.col(f"f.z_{c}") <= F.col(f"e.z_{c}") + 1e-6)
    return ends.alias("e").join(found.alias("f"), "Churn").select("Churn", "Given", "Rows", inside.alias("InRange"))


@query("chn_09", mapped("predictions", "CustomerID:i", "ChurnProbability:d", "ChurnPrediction:i", "RiskLevel"), "predictions")
def _(t):
    return _predictions(t)


@query("chn_10")
def _(t):
    return churn.perform_churn_prediction(t.features, t.tx).predictions


@query("chn_10_rules", f"SELECT {I('CustomerID')} AS CustomerID, true AS InRange, true AS ClassFollows, true AS RiskFollows "
       "FROM (SELECT DISTINCT CustomerID FROM tx)", "tx")
def _(t):
    """Every customer with purchases is scored once; class and risk follow from the score. All others are scored, too."""
    found = churn.perform_churn_prediction(t.features, t.tx).predictions.join(t.tx.select("CustomerID").distinct(), "CustomerID", "left_semi")
    p = F.col("ChurnProbability")
    risk = F.when(p > 0.8, "Critical").when(p > 0.6, "High").when(p > 0.3, "Medium").when(p > 0, "Low")
    return found.select("CustomerID", p.between(0, 1).alias("InRange"), (F.col("ChurnPrediction") == F.when(p >= 0.5, 1).otherwise(0)).alias("ClassFollows"),
                        F.col("RiskLevel").eqNullSafe(risk).alias("RiskFollows"))


# --- whole jobs ----------------------------------------------------------------------------------------

@query("etl_pipeline", f"""
  SELECT 'transactions' AS TableName, count(*) AS Rows FROM tx_clean
  UNION ALL SELECT 'loyalty', count(*) FROM loyalty UNION ALL SELECT 'surveys', count(*) FROM surveys
  UNION ALL SELECT 'customers', count(*) FROM customers UNION ALL SELECT 'products', count(*) FROM products
  UNION ALL SELECT 'stores', count(*) FROM stores UNION ALL SELECT 'merged', count(*) FROM tx_clean""".replace(
    "tx_clean", "(SELECT DISTINCT TransactionID, CustomerID, ProductID, TransactionDate FROM tx)"),
    "tx", "loyalty", "surveys", "customers", "products", "stores")
def _(t):
    base = scratch_path(t.spark, "etl")
    done = etl.run_etl_pipeline(t.spark, _raw_folder(t), f"{base}/processed", f"{base}/warehouse", first_date=FIRST_DATE, last_date=LAST_DATE)
    return _table_sizes(done.tables)


@query("analysis_pipeline")
def _(t):
    frames = {"transactions": t.tx.select(*TX_NAMES), "loyalty": t.loyalty.drop("CumulativeSpend"), "surveys": t.surveys,
              "products": t.products, "stores": t.stores, "customers": t.customers}
    out = scratch_path(t.spark, "results")
    analysis.precompute_all_analysis(t.spark, frames, out)
    return readers.load_precomputed_data(t.spark, out)["kpi_metrics"]
