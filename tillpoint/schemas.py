"""Table contracts and the fixed values the engine shares with its users."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and types of the six input tables.
TRANSACTIONS = T.StructType([
    T.StructField("TransactionID", T.StringType()),
    T.StructField("CustomerID", T.StringType()),
    T.StructField("TransactionDate", T.DateType()),
    T.StructField("StoreID", T.StringType()),
    T.StructField("ProductID", T.StringType()),
    T.StructField("Quantity", T.IntegerType()),
    T.StructField("UnitPrice", T.DecimalType(10, 2)),
    T.StructField("LineTotal", T.DecimalType(10, 2)),
])
LOYALTY = T.StructType([
    T.StructField("LoyaltyRecordID", T.LongType()),
    T.StructField("CustomerID", T.StringType()),
    T.StructField("TransactionID", T.StringType()),
    T.StructField("TransactionDate", T.DateType()),
    T.StructField("PointsEarned", T.IntegerType()),
    T.StructField("PointsRedeemed", T.IntegerType()),
    T.StructField("PointsBalance", T.LongType()),
    T.StructField("Tier", T.StringType()),
    T.StructField("PointsPerDollar", T.DecimalType(5, 2)),
])
SURVEYS = T.StructType([
    T.StructField("SurveyID", T.LongType()),
    T.StructField("CustomerID", T.StringType()),
    T.StructField("SurveyDate", T.DateType()),
    T.StructField("SatisfactionScore", T.IntegerType()),
    T.StructField("NPSScore", T.IntegerType()),
    T.StructField("Feedback", T.StringType()),
    T.StructField("WouldRecommend", T.StringType()),
])
PRODUCTS = T.StructType([
    T.StructField("ProductID", T.StringType()),
    T.StructField("ProductName", T.StringType()),
    T.StructField("Category", T.StringType()),
    T.StructField("Price", T.DecimalType(10, 2)),
    T.StructField("Cost", T.DecimalType(10, 2)),
])
STORES = T.StructType([
    T.StructField("StoreID", T.StringType()),
    T.StructField("StoreName", T.StringType()),
    T.StructField("City", T.StringType()),
    T.StructField("Province", T.StringType()),
    T.StructField("Address", T.StringType()),
])
CUSTOMERS = T.StructType([
    T.StructField("CustomerID", T.StringType()),
    T.StructField("FirstName", T.StringType()),
    T.StructField("LastName", T.StringType()),
    T.StructField("Email", T.StringType()),
    T.StructField("Phone", T.StringType()),
    T.StructField("Address", T.StringType()),
    T.StructField("City", T.StringType()),
    T.StructField("Province", T.StringType()),
    T.StructField("PostalCode", T.StringType()),
    T.StructField("EnrollmentDate", T.DateType()),
    T.StructField("DateOfBirth", T.DateType()),
])
DATES = T.StructType([
    T.StructField("DateKey", T.IntegerType()),
    T.StructField("Date", T.DateType()),
    T.StructField("Year", T.IntegerType()),
    T.StructField("Quarter", T.IntegerType()),
    T.StructField("Month", T.IntegerType()),
    T.StructField("MonthName", T.StringType()),
    T.StructField("Week", T.IntegerType()),
    T.StructField("DayOfWeek", T.IntegerType()),
    T.StructField("DayName", T.StringType()),
    T.StructField("DayOfMonth", T.IntegerType()),
    T.StructField("IsWeekend", T.BooleanType()),
    T.StructField("IsHolidaySeason", T.BooleanType()),
])

# Columns that must be present when a table is loaded.
REQUIRED = {
    "transactions": ["TransactionID", "CustomerID", "TransactionDate", "StoreID", "ProductID",
                     "Quantity", "UnitPrice", "LineTotal"],
    "loyalty": ["LoyaltyRecordID", "CustomerID", "TransactionID", "TransactionDate",
                "PointsEarned", "PointsBalance", "Tier"],
    "surveys": ["SurveyID", "CustomerID", "SurveyDate", "SatisfactionScore", "NPSScore"],
    "products": ["ProductID", "ProductName", "Category", "Price"],
    "stores": ["StoreID", "StoreName", "City", "Province"],
    "customers": ["CustomerID", "FirstName", "LastName", "EnrollmentDate"],
}

SCHEMAS = {"transactions": TRANSACTIONS, "loyalty": LOYALTY, "surveys": SURVEYS,
           "products": PRODUCTS, "stores": STORES, "customers": CUSTOMERS}

# File names of the raw tables; a folder with other names passes its own mapping.
RAW_FILES = {
    "transactions": "transactions.csv",
    "loyalty": "loyalty.csv",
    "surveys": "surveys.csv",
    "products": "products.csv",
    "stores": "stores.csv",
    "customers": "customers.csv",
}

# Loyalty tiers as (name, smallest running spend, points per dollar, code).
TIERS = [
    ("Bronze", 0, "1.00", 1),
    ("Silver", 10000, "1.15", 2),
    ("Gold", 25000, "1.25", 3),
    ("Platinum", 50000, "1.50", 4),
]
TIER_NAMES = [t[0] for t in TIERS]

# Calendar rules and report parameters.
HOLIDAY_MONTHS = [11, 12, 1, 2]
PERIODS = [30, 60, 90, 365]
RECENT_DAYS, HISTORY_DAYS = 90, 180
TREND_BAND = 0.1
DAYS_PER_MONTH = 30.44
CHURN_DAYS = 90
SEED = 42
