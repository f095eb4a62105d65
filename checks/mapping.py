"""The engine's input tables, derived from the given order tables.

Every view covers its whole source table. IDs stay numbers.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tillpoint.functions.lineage import stage
from tillpoint.operators import customer_features, loyalty

MONEY = T.DecimalType(18, 2)
LINE_ORDER = ["TransactionDate", "TransactionID", "LineNumber", "ProductID", "StoreID", "Quantity", "LineTotal"]
FIRST_DATE, LAST_DATE = "1995-01-01", "2001-12-31"
POINTS_UNIT = 100
CLEAN_ORDER = ("LineNumber", "StoreID", "Quantity", "UnitPrice", "LineTotal")


_SCHEMAS: dict[str, T.StructType] = {}


class Tables:
    """Lazy views over one data folder. A file's schema is looked up once per process."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, str(folder).rstrip("/")

    def raw(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    @cached_property
    def lines(self) -> DataFrame:
        """Order lines without customer and date: enough for reports on products and baskets."""
        cents = F.rint(F.col("l_extendedprice") * 100).cast("bigint")
        q = F.col("l_quantity").cast("bigint")
        unit_cents = F.call_function("div", 2 * cents + q, 2 * q)

        def from_cents(c):
            return (c.cast("decimal(16,0)") * F.lit("0.01").cast("decimal(2,2)")).cast(MONEY)

        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("TransactionID"),
            F.col("l_suppkey").alias("StoreID"),
            F.col("l_partkey").alias("ProductID"),
            F.col("l_quantity").cast("int").alias("Quantity"),
            from_cents(unit_cents).alias("UnitPrice"),
            from_cents(cents).alias("LineTotal"),
            F.col("l_linenumber").alias("LineNumber"),
            F.col("l_returnflag").alias("ReturnFlag"),
        )

    @cached_property
    def tx(self) -> DataFrame:
        orders = self.raw("orders").select(
            F.col("o_orderkey").alias("TransactionID"), F.col("o_custkey").alias("CustomerID"),
            F.col("o_orderdate").cast("date").alias("TransactionDate"))
        return self.lines.join(orders, "TransactionID")

    @cached_property
    def sold(self) -> DataFrame:
        """The dates of the orders that have lines."""
        dated = self.raw("orders").join(self.raw("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
        return dated.select(F.col("o_orderdate").cast("date").alias("TransactionDate"))

    @cached_property
    def ref(self):
        """Date of the newest order that has lines, as a literal Spark can push into the scan."""
        orders = self.raw("orders")
        dated = orders.join(self.raw("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
        return dated.agg(F.max(F.col("o_orderdate")).cast("date")).first()[0]

    @cached_property
    def products(self) -> DataFrame:
        price = F.col("p_retailprice").cast(MONEY)
        return self.raw("part").select(
            F.col("p_partkey").alias("ProductID"), F.col("p_name").alias("ProductName"), F.col("p_type").alias("Category"),
            price.alias("Price"), F.round(price * F.lit("0.6").cast("decimal(2,1)"), 2).cast(MONEY).alias("Cost"))

    @cached_property
    def stores(self) -> DataFrame:
        nation = self.raw("nation").select("n_nationkey", "n_name")
        return self.raw("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.col("s_suppkey").alias("StoreID"), F.col("s_name").alias("StoreName"),
            F.col("n_name").alias("City"), F.col("n_name").alias("Province"))

    @cached_property
    def customers(self) -> DataFrame:
        joined = self.raw("orders").groupBy("o_custkey").agg(F.min("o_orderdate").cast("date").alias("EnrollmentDate"))
        nation = self.raw("nation").select("n_nationkey", "n_name")
        return (
            self.raw("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(joined, F.col("c_custkey") == F.col("o_custkey"), "left")
            .select(F.col("c_custkey").alias("CustomerID"), F.col("c_name").alias("FirstName"),
                    F.col("c_mktsegment").alias("LastName"), F.col("n_name").alias("City"),
                    F.col("n_name").alias("Province"), "EnrollmentDate")
        )

    @cached_property
    def customer_ids(self) -> DataFrame:
        return self.raw("customer").select(F.col("c_custkey").alias("CustomerID"))

    @cached_property
    def customer_sizes(self) -> int:
        """Lines of the largest customer, from the join columns only: what the ordered scans measure."""
        orders = self.raw("orders").select(F.col("o_orderkey"), F.col("o_custkey").alias("CustomerID"))
        sales = self.raw("lineitem").select("l_orderkey").join(orders, F.col("o_orderkey") == F.col("l_orderkey"))
        return sales.groupBy("CustomerID").count().agg(F.max("count")).first()[0] or 0

    @property
    def points(self):
        return F.col("LineTotal") * F.lit("0.01").cast("decimal(3,2)")

    def ledger(self, record_ids: bool) -> DataFrame:
        redeemed = F.when(F.col("ReturnFlag") == "R", F.lit(500)).otherwise(F.lit(0))
        return loyalty.build_points_ledger(self.tx, LINE_ORDER, redeemed, self.points, record_ids=record_ids,
                                           measure=self.customer_sizes)

    @cached_property
    def loyalty(self) -> DataFrame:
        """Loyalty records numbered per customer, which is all that ordering within a customer needs."""
        return self.ledger(False)

    @cached_property
    def surveys(self) -> DataFrame:
        nps = F.pmod(F.col("event_id"), F.lit(11)).cast("int")
        return self.raw("events").select(
            F.col("event_id").alias("SurveyID"), F.col("user_id").alias("CustomerID"),
            F.col("ts").cast("date").alias("SurveyDate"),
            (F.pmod(F.col("event_id"), F.lit(5)) + 1).cast("int").alias("SatisfactionScore"),
            nps.alias("NPSScore"), F.col("event_type").alias("Feedback"),
            F.when(nps >= 7, "Yes").otherwise("No").alias("WouldRecommend"))

    # --- faulty variants for the repair rules: every row stays, some carry a fault ------------

    @cached_property
    def dirty_tx(self) -> DataFrame:
        def hit(prime: int, rest: int):
            return F.pmod(F.col("TransactionID"), F.lit(prime)) == rest

        faulty = self.tx.select(
            "TransactionID",
            F.when(~hit(97, 0), F.col("CustomerID")).alias("CustomerID"),
            F.when(hit(71, 6), F.lit("2030-01-01").cast("date")).otherwise(F.col("TransactionDate")).alias("TransactionDate"),
            "StoreID", "ProductID",
            F.when(hit(89, 1), F.lit(-1)).when(hit(83, 2), F.lit(5000)).otherwise(F.col("Quantity")).alias("Quantity"),
            F.when(hit(79, 3), F.lit(0).cast(MONEY)).when(hit(101, 4), (F.col("UnitPrice") * 50).cast(MONEY))
            .otherwise(F.col("UnitPrice")).alias("UnitPrice"),
            F.when(hit(73, 5), (F.col("LineTotal") + 5).cast(MONEY)).otherwise(F.col("LineTotal")).alias("LineTotal"),
            "LineNumber",
        )
        copies = F.when(hit(67, 7), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        return faulty.withColumn("_copy", F.explode(copies)).withColumn(
            "LineTotal", (F.col("LineTotal") + F.col("_copy")).cast(MONEY)).drop("_copy")

    @cached_property
    def dirty_loyalty(self) -> DataFrame:
        def hit(prime: int, rest: int):
            return F.pmod(F.col("TransactionID"), F.lit(prime)) == rest

        return self.loyalty.drop("CumulativeSpend").select(
            "LoyaltyRecordID",
            F.when(~hit(97, 0), F.col("CustomerID")).alias("CustomerID"),
            "TransactionID", "TransactionDate",
            F.when(hit(89, 1), -F.col("PointsEarned")).otherwise(F.col("PointsEarned")).alias("PointsEarned"),
            F.when(hit(83, 2), -F.col("PointsRedeemed")).otherwise(F.col("PointsRedeemed")).alias("PointsRedeemed"),
            F.when(hit(79, 3), F.lit(-7).cast("bigint")).otherwise(F.col("PointsBalance")).alias("PointsBalance"),
            F.when(hit(73, 5), F.lit("Diamond")).when(~hit(71, 6), F.col("Tier")).alias("Tier"),
            "PointsPerDollar")

    @cached_property
    def dirty_surveys(self) -> DataFrame:
        def hit(prime: int, rest: int):
            return F.pmod(F.col("SurveyID"), F.lit(prime)) == rest

        return self.surveys.select(
            "SurveyID", F.when(~hit(97, 0), F.col("CustomerID")).alias("CustomerID"), "SurveyDate",
            F.when(hit(89, 1), F.lit(9)).when(hit(83, 2), F.lit(-2)).when(~hit(79, 3), F.col("SatisfactionScore")).alias("SatisfactionScore"),
            F.when(hit(73, 5), F.lit(15)).when(hit(71, 6), F.lit(-1)).when(~hit(67, 7), F.col("NPSScore")).alias("NPSScore"),
            "Feedback", "WouldRecommend")

    # --- fixed scores and labels that let the model-side reports be compared exactly ----------

    @cached_property
    def scored(self) -> DataFrame:
        """A churn probability of 0.00 to 1.00 and a label per customer, by rule."""
        score = F.pmod(F.col("CustomerID") * 37, F.lit(101)).cast("double") / 100
        label = (F.pmod(F.col("CustomerID") * 37, F.lit(101)) + F.pmod(F.col("CustomerID"), F.lit(7)) * 9 >= 75).cast("int")
        return self.customer_ids.select("CustomerID", score.alias("ChurnProbability"), label.alias("Churn"))

    @cached_property
    def labels(self) -> DataFrame:
        return self.customer_ids.select("CustomerID", F.pmod(F.col("CustomerID"), F.lit(5)).cast("int").alias("Segment"))

    @cached_property
    def features(self) -> DataFrame:
        """The matrix, computed once per run and read by every report of the run."""
        return stage(customer_features.create_customer_feature_matrix(
            self.tx, self.loyalty, self.customers, self.products, self.surveys, self.ref, measure=self.customer_sizes))
