"""Customer features: RFM, periods, loyalty, engagement, trends, seasons, surveys, and their matrix.

All per-line sums and counts are expressions of one conditional aggregation per customer
(``line_metrics``). The single-family operators ask for their own expressions; the matrix asks
for all of them at once, so it scans the facts once for sums and once, narrow, for distinct counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillpoint.functions.lineage import stage
from tillpoint.functions.ordered import quintile, ranks
from tillpoint.functions.stats import as_of, count_if, days_between, mean, number, numeric_columns, ratio, zero_filled
from tillpoint.operators.loyalty import RECORD_ORDER, tier_code, with_previous_tier
from tillpoint.operators.merge import newest
from tillpoint.operators.reports import combined_score
from tillpoint.schemas import DAYS_PER_MONTH, HISTORY_DAYS, HOLIDAY_MONTHS, PERIODS, RECENT_DAYS, TREND_BAND

SPEND, UNITS, LINE = "LineTotal", "Quantity", "TransactionID"


def _since(ref: Column, days: int) -> Column:
    return F.col("TransactionDate") >= F.date_sub(ref, days)


def _recent(ref: Column) -> Column:
    return _since(ref, RECENT_DAYS)


def _historical(ref: Column) -> Column:
    return _since(ref, HISTORY_DAYS) & ~_recent(ref)


# --- expressions over the lines of one customer --------------------------------------

def _life_metrics() -> dict[str, Column]:
    return {
        "LastPurchaseDate": F.max("TransactionDate"),
        "FirstPurchaseDate": F.min("TransactionDate"),
        "Frequency": F.count("TransactionDate"),
        "TotalSpend": F.sum(SPEND),
        "AvgTransactionValue": mean(F.col(SPEND)),
    }


def _period_metrics(ref: Column) -> dict[str, Column]:
    out = {}
    for n in PERIODS:
        inside = _since(ref, n)
        out[f"Frequency_{n}d"] = F.count(F.when(inside, F.col(LINE)))
        out[f"Spend_{n}d"] = F.sum(F.when(inside, F.col(SPEND)))
    return out


def _trend_metrics(ref: Column) -> dict[str, Column]:
    out = {}
    for label, inside in (("Recent", _recent(ref)), ("Historical", _historical(ref))):
        out[f"{label}Frequency"] = F.count(F.when(inside, F.col(LINE)))
        out[f"{label}Spend"] = F.sum(F.when(inside, F.col(SPEND)))
        out[f"{label}AvgTransaction"] = mean(F.when(inside, F.col(SPEND)))
        out[f"{label}AvgBasketSize"] = mean(F.when(inside, F.col(UNITS)))
    return out


def _season_metrics() -> dict[str, Column]:
    out = {
        "TotalTransactions": F.count(LINE),
        "HolidayTransactions": count_if(F.month("TransactionDate").isin(HOLIDAY_MONTHS)),
    }
    for q in range(1, 5):
        out[f"Q{q}_Transactions"] = count_if(F.quarter("TransactionDate") == q)
    return out


def line_metrics(transactions: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    return transactions.groupBy("CustomerID").agg(*[c.alias(n) for n, c in metrics.items()])


# --- RFM ---------------------------------------------------------------------------

# Columns of the RFM table, in order.
RFM_COLUMNS = ["CustomerID", "Recency", "Frequency", "TotalSpend", "AvgTransactionValue", "LifetimeValue",
               "CustomerLifetime", "AvgDaysBetweenPurchases", "RecencyScore", "FrequencyScore",
               "MonetaryScore", "RFMScore", "LastPurchaseDate", "FirstPurchaseDate"]


def _with_life(df: DataFrame, ref: Column) -> DataFrame:
    lifetime = days_between(F.col("FirstPurchaseDate"), F.col("LastPurchaseDate"))
    return df.withColumns({
        "Recency": days_between(F.col("LastPurchaseDate"), ref),
        "CustomerLifetime": lifetime,
        "LifetimeValue": F.col("TotalSpend"),
        "AvgDaysBetweenPurchases": F.coalesce(ratio(lifetime, F.col("Frequency")), F.lit(0.0)),
    })


def with_rfm_scores(df: DataFrame, size: int, limit: int | None = None) -> DataFrame:
    """Quintile scores by first-rank; CustomerID decides ties.

    The three metrics are ranked in one scan; the scores join back by customer, so wide rows are never sorted as a
    whole table. ``df`` should be staged: it is read twice.
    """
    metrics = {"RecencyScore": F.col("Recency"), "FrequencyScore": F.col("Frequency"), "MonetaryScore": F.col("TotalSpend")}
    placed = ranks(df, "CustomerID", metrics, size, limit)
    scores = placed.select("CustomerID", (6 - quintile(F.col("RecencyScore"), size)).alias("RecencyScore"),
                           *[quintile(F.col(c), size).alias(c) for c in ("FrequencyScore", "MonetaryScore")])
    combined = combined_score(F.col("RecencyScore"), F.col("FrequencyScore"), F.col("MonetaryScore")).alias("RFMScore")
    return df.join(scores.select("*", combined), "CustomerID")


def calculate_rfm_features(transactions: DataFrame, reference_date=None, limit: int | None = None) -> DataFrame:
    ref = as_of(transactions, reference_date)
    base = stage(_with_life(line_metrics(transactions.filter("CustomerID is not null"), _life_metrics()), ref))
    return with_rfm_scores(base, base.count(), limit).select(*RFM_COLUMNS)


# --- periods, trends, seasons ----------------------------------------------------------

def calculate_frequency_by_period(transactions: DataFrame, reference_date=None) -> DataFrame:
    """Lines and spend of the last 30, 60, 90 and 365 days, for customers active in the longest."""
    ref = as_of(transactions, reference_date)
    active = transactions.filter(_since(ref, max(PERIODS))).filter("CustomerID is not null")
    return zero_filled(line_metrics(active, _period_metrics(ref)))


def trend_direction(c: Column, up: str = "increasing", down: str = "decreasing") -> Column:
    return F.when(c > TREND_BAND, up).when(c < -TREND_BAND, down).otherwise("stable")


def growth(recent: Column, historical: Column) -> Column:
    """(recent - historical) / (historical + 1): the 1 keeps an empty history finite."""
    return (number(recent) - number(historical)) / (number(historical) + F.lit(1.0))


# Columns of the trend table, in order.
TREND_COLUMNS = ["CustomerID", "RecentFrequency", "RecentSpend", "RecentAvgTransaction", "RecentAvgBasketSize",
                 "HistoricalFrequency", "HistoricalSpend", "HistoricalAvgTransaction", "HistoricalAvgBasketSize",
                 "FrequencyTrend", "SpendingTrend", "BasketSizeTrend",
                 "FrequencyTrendDirection", "SpendingTrendDirection"]


def _with_trends(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "FrequencyTrend": growth(F.col("RecentFrequency"), F.col("HistoricalFrequency")),
        "SpendingTrend": growth(F.col("RecentSpend"), F.col("HistoricalSpend")),
        "BasketSizeTrend": growth(F.col("RecentAvgBasketSize"), F.col("HistoricalAvgBasketSize")),
    }).withColumns({
        "FrequencyTrendDirection": trend_direction(F.col("FrequencyTrend")),
        "SpendingTrendDirection": trend_direction(F.col("SpendingTrend")),
    })


def calculate_behavioral_features(transactions: DataFrame, reference_date=None) -> DataFrame:
    """Last 90 days against the 90 before, for customers active in the last 180."""
    ref = as_of(transactions, reference_date)
    active = transactions.filter(_since(ref, HISTORY_DAYS)).filter("CustomerID is not null")
    return _with_trends(zero_filled(line_metrics(active, _trend_metrics(ref)))).select(*TREND_COLUMNS)


def _with_season(df: DataFrame) -> DataFrame:
    counts = [F.col(f"Q{q}_Transactions") for q in range(1, 5)]
    best = F.greatest(*counts)
    preferred = F.when(counts[0] == best, 1).when(counts[1] == best, 2).when(counts[2] == best, 3).otherwise(4)
    share = F.coalesce(ratio(F.col("HolidayTransactions"), F.col("TotalTransactions")), F.lit(0.0))
    return df.withColumns({"HolidayActivityRatio": share, "PreferredQuarter": preferred})


SEASON_COLUMNS = ["CustomerID", "TotalTransactions", "TotalSpend", "HolidayTransactions", "HolidayActivityRatio",
                  "Q1_Transactions", "Q2_Transactions", "Q3_Transactions", "Q4_Transactions", "PreferredQuarter"]


def calculate_seasonal_features(transactions: DataFrame) -> DataFrame:
    """Holiday share, lines per quarter and the quarter with most lines (the earliest on a tie)."""
    base = line_metrics(transactions.filter("CustomerID is not null"), {**_season_metrics(), "TotalSpend": F.sum(SPEND)})
    return _with_season(base).select(*SEASON_COLUMNS)


# --- engagement ------------------------------------------------------------------------

def _breadth(transactions: DataFrame, products: DataFrame) -> DataFrame:
    """Distinct days, baskets, products and categories per customer.

    Products are reduced to (customer, product) before the category join, so the join sees
    each pair once and a hot product is folded before it.
    """
    seen = transactions.groupBy("CustomerID").agg(
        F.countDistinct("TransactionDate").alias("DaysActive"),
        F.countDistinct("TransactionID").alias("_baskets"),
    )
    pairs = transactions.select("CustomerID", "ProductID").distinct().join(
        products.select("ProductID", "Category"), "ProductID", "left")
    # pairs are distinct, so counting products is a plain count
    wide = pairs.groupBy("CustomerID", "Category").agg(F.count("ProductID").alias("_n")).groupBy("CustomerID").agg(
        F.sum("_n").alias("UniqueProducts"), F.count("Category").alias("UniqueCategories"))
    return seen.join(wide, "CustomerID")


def _with_engagement(df: DataFrame) -> DataFrame:
    months = F.greatest(F.bround(F.col("_span") / F.lit(DAYS_PER_MONTH), 0).cast("int"), F.lit(1))
    return df.withColumns({
        "ActiveMonths": months,
        "AvgBasketSize": ratio(F.col("TotalItemsPurchased"), F.col("_baskets")),
        "PurchaseVelocity": F.coalesce(ratio(F.col("TotalTransactions"), months), F.lit(0.0)),
        "ProductDiversity": F.coalesce(ratio(F.col("UniqueProducts"), F.col("TotalTransactions")), F.lit(0.0)),
    })


ENGAGEMENT_COLUMNS = ["CustomerID", "DaysActive", "ActiveMonths", "UniqueProducts", "UniqueCategories",
                      "TotalItemsPurchased", "TotalTransactions", "AvgBasketSize", "PurchaseVelocity", "ProductDiversity"]


def calculate_engagement_features(transactions: DataFrame, products: DataFrame) -> DataFrame:
    """Activity and breadth. A customer's mean basket is all units over distinct baskets."""
    known = transactions.filter("CustomerID is not null")
    base = line_metrics(known, {
        "TotalItemsPurchased": F.coalesce(F.sum(UNITS), F.lit(0)),
        "TotalTransactions": F.count(LINE),
        "_span": days_between(F.min("TransactionDate"), F.max("TransactionDate")),
    })
    return _with_engagement(base.join(_breadth(known, products), "CustomerID")).select(*ENGAGEMENT_COLUMNS)


# --- loyalty and surveys -----------------------------------------------------------------

LOYALTY_COLUMNS = ["CustomerID", "TotalPointsEarned", "AvgPointsEarned", "PointsTransactions", "TotalPointsRedeemed",
                   "AvgPointsRedeemed", "CurrentPointsBalance", "CurrentTier", "CurrentPointsPerDollar", "RedemptionRate",
                   "EnrollmentDate", "DaysSinceEnrollment", "PointsPerDollarRatio", "TierNumeric", "TierChanges"]


def calculate_loyalty_features(loyalty: DataFrame, customers: DataFrame, reference_date=None,
                               measure: DataFrame | int | None = None, limit: int | None = None) -> DataFrame:
    """Points totals, the newest balance, tier and rate, and how often the tier changed."""
    ref = as_of(loyalty, reference_date)
    changed = F.col("PreviousTier").isNotNull() & (F.col("Tier") != F.col("PreviousTier"))
    rows = with_previous_tier(loyalty.filter("CustomerID is not null"), measure, limit)
    sums = rows.groupBy("CustomerID").agg(
        F.sum("PointsEarned").alias("TotalPointsEarned"),
        mean(F.col("PointsEarned")).alias("AvgPointsEarned"),
        F.count("PointsEarned").alias("PointsTransactions"),
        F.sum("PointsRedeemed").alias("TotalPointsRedeemed"),
        mean(F.col("PointsRedeemed")).alias("AvgPointsRedeemed"),
        newest("PointsBalance", *RECORD_ORDER).alias("CurrentPointsBalance"),
        newest("Tier", *RECORD_ORDER).alias("CurrentTier"),
        newest("PointsPerDollar", *RECORD_ORDER).alias("CurrentPointsPerDollar"),
        count_if(changed).alias("TierChanges"),
    )
    out = sums.withColumn(
        "RedemptionRate", F.coalesce(ratio(F.col("TotalPointsRedeemed"), F.col("TotalPointsEarned")), F.lit(0.0))
    ).withColumn("PointsPerDollarRatio", F.col("CurrentPointsPerDollar")).withColumn(
        "TierNumeric", tier_code(F.col("CurrentTier")))
    columns = list(LOYALTY_COLUMNS)
    if "EnrollmentDate" in customers.columns:
        enrolled = customers.select("CustomerID", F.to_date("EnrollmentDate").alias("EnrollmentDate"))
        out = out.join(enrolled, "CustomerID", "left").withColumn(
            "DaysSinceEnrollment", days_between(F.col("EnrollmentDate"), ref))
    else:
        columns = [c for c in columns if c not in ("EnrollmentDate", "DaysSinceEnrollment")]
    return out.select(*columns)


def calculate_survey_features(surveys: DataFrame) -> DataFrame:
    """Mean scores and the share of 'Yes' among all of a customer's surveys."""
    yes = F.when(F.col("WouldRecommend") == "Yes", 1).otherwise(0)
    return surveys.filter("CustomerID is not null").groupBy("CustomerID").agg(
        mean(F.col("SatisfactionScore")).alias("AvgSatisfactionScore"),
        mean(F.col("NPSScore")).alias("AvgNPSScore"),
        mean(yes).alias("RecommendationRate"),
    )


# --- the matrix ----------------------------------------------------------------------------

def create_customer_feature_matrix(transactions: DataFrame, loyalty: DataFrame, customers: DataFrame, products: DataFrame,
                                   surveys: DataFrame | None = None, reference_date=None, missing_recency: str = "zero",
                                   spend_copies: bool = False, measure: DataFrame | int | None = None,
                                   limit: int | None = None) -> DataFrame:
    """One row per customer with all feature families; missing numbers become 0.

    A customer without purchases gets recency 0 and scores 0 by that rule; ``IsActive`` tells them
    apart, and ``missing_recency='null'`` keeps their recency empty. ``spend_copies`` adds the two
    extra copies of total spend that weigh it in clustering.
    """
    ref = as_of(transactions, reference_date)
    # staged on its own: the shuffles of the ledger are gone before those of the rest are written
    points = stage(calculate_loyalty_features(loyalty, customers, ref, measure, limit))
    known = transactions.filter("CustomerID is not null")
    base = line_metrics(known, {
        **_life_metrics(), **_period_metrics(ref), **_trend_metrics(ref), **_season_metrics(),
        "TotalItemsPurchased": F.coalesce(F.sum(UNITS), F.lit(0)),
    })
    base = _with_life(base, ref).withColumn("_span", F.col("CustomerLifetime"))
    base = _with_season(_with_engagement(base.join(_breadth(known, products), "CustomerID")))
    staged = stage(base)
    scored = with_rfm_scores(staged, staged.count(), limit)

    # Trends belong to customers active in the trend window only; for the others they stay empty until the zero fill.
    moving = F.col("RecentFrequency") + F.col("HistoricalFrequency") > 0
    trends = _with_trends(zero_filled(scored, TREND_COLUMNS[1:9]))
    trends = trends.withColumns({c: F.when(moving, F.col(c)) for c in TREND_COLUMNS[1:]})

    matrix = customers.select("CustomerID").join(trends.drop("_span", "_baskets"), "CustomerID", "left")
    matrix = matrix.join(points, "CustomerID", "left")
    if surveys is not None:
        matrix = matrix.join(calculate_survey_features(surveys), "CustomerID", "left")
    matrix = matrix.withColumn("IsActive", F.col("LastPurchaseDate").isNotNull())
    keep = {"Recency"} if missing_recency == "null" else set()
    filled = zero_filled(matrix, numeric_columns(matrix, exclude={"CustomerID"} | keep))
    if spend_copies:
        filled = filled.withColumn("TotalSpend_x", F.col("TotalSpend")).withColumn("TotalSpend_y", F.col("TotalSpend"))
    return filled.select(*[c for c in MATRIX_COLUMNS if c in filled.columns],
                         *[c for c in filled.columns if c not in MATRIX_COLUMNS])


MATRIX_COLUMNS = (
    RFM_COLUMNS
    + [f"{kind}_{n}d" for n in PERIODS for kind in ("Frequency", "Spend")]
    + LOYALTY_COLUMNS[1:]
    + ENGAGEMENT_COLUMNS[1:]
    + TREND_COLUMNS[1:]
    + SEASON_COLUMNS[3:]
    + ["AvgSatisfactionScore", "AvgNPSScore", "RecommendationRate"]
)


def create_feature_matrix(transactions: DataFrame, loyalty: DataFrame, customers: DataFrame, products: DataFrame,
                          surveys: DataFrame | None = None, reference_date=None, **options) -> DataFrame:
    """Entry point of the feature job."""
    return create_customer_feature_matrix(transactions, loyalty, customers, products, surveys, reference_date, **options)
