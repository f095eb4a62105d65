"""Points programme: the ledger and its reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tillpoint.functions.ordered import Ordered
from tillpoint.functions.stats import mean
from tillpoint.schemas import HOLIDAY_MONTHS, TIERS, TIER_NAMES

RECORD_ORDER = ["TransactionDate", "LoyaltyRecordID"]


def tier_of(spend: Column, tiers=TIERS) -> Column:
    """Highest tier whose smallest spend is reached; the lowest tier otherwise."""
    named = F.lit(tiers[0][0])
    for name, least, _, _ in tiers[1:]:
        named = F.when(spend >= least, F.lit(name)).otherwise(named)
    return named


def rate_of(tier: Column, tiers=TIERS) -> Column:
    rate = F.lit(None).cast(T.DecimalType(5, 2))
    for name, _, per_dollar, _ in tiers:
        rate = F.when(tier == name, F.lit(per_dollar).cast(T.DecimalType(5, 2))).otherwise(rate)
    return F.coalesce(rate, F.lit(1).cast(T.DecimalType(5, 2)))


def tier_code(tier: Column) -> Column:
    """Bronze 1 to Platinum 4; anything else counts as Bronze."""
    code = F.lit(None).cast("int")
    for name, _, _, number in TIERS:
        code = F.when(tier == name, F.lit(number)).otherwise(code)
    return F.coalesce(code, F.lit(TIERS[0][3]))


def tier_name(code: Column) -> Column:
    """Inverse of ``tier_code``; unknown codes read 'Tier n'."""
    name = F.concat(F.lit("Tier "), code.cast("string"))
    for text, _, _, number in TIERS:
        name = F.when(code == number, F.lit(text)).otherwise(name)
    return name


def running_spend(transactions: DataFrame, order: list[str], spend: Column | None = None,
                  measure: DataFrame | int | None = None, limit: int | None = None) -> DataFrame:
    """CumulativeSpend: the customer's spend up to and including each line."""
    amount = F.col("LineTotal") if spend is None else spend
    rows = Ordered.of(transactions, ["CustomerID"], order, measure=measure, limit=limit)
    return rows.running_sum(CumulativeSpend=amount).result()


def build_points_ledger(transactions: DataFrame, order: list[str], redeemed: Column, spend: Column | None = None,
                        tiers=TIERS, record_ids: bool = True, measure: DataFrame | int | None = None,
                        limit: int | None = None) -> DataFrame:
    """One loyalty record per line: tier by running spend, points earned, and a balance that never goes below 0.

    With S the running sum of earned minus redeemed points, the balance after a line is
    S - min(0, smallest S so far), so the recurrence needs running windows only.

    ``order`` puts a customer's lines in a total order. LoyaltyRecordID numbers all records by
    (CustomerID, order): customer totals give each customer's offset, so no window runs over all
    lines. With ``record_ids=False`` the number restarts per customer. Lines without a customer count
    as those of one customer.
    """
    amount = F.col("LineTotal") if spend is None else spend
    lines = transactions.withColumn("_amount", amount).withColumn("PointsRedeemed", redeemed.cast("bigint"))
    rows = Ordered.of(lines, ["CustomerID"], order, measure=measure, limit=limit)
    rows = rows.running_sum(CumulativeSpend=F.col("_amount"), _seq=F.lit(1).cast("bigint"))
    earned = F.bround(F.col("_amount") * F.col("PointsPerDollar"), 0).cast("bigint")
    rows = rows.map(
        lambda df: df.withColumn("Tier", tier_of(F.col("CumulativeSpend"), tiers))
        .withColumn("PointsPerDollar", rate_of(F.col("Tier"), tiers))
        .withColumn("PointsEarned", earned)
    )
    rows = rows.running_sum(_net=F.col("PointsEarned") - F.col("PointsRedeemed"))
    rows = rows.running_min(_lowest=F.col("_net"))
    ledger = rows.result().withColumn("PointsBalance", F.col("_net") - F.least(F.lit(0), F.col("_lowest")))
    if record_ids:
        sizes = transactions.groupBy("CustomerID").agg(F.count(F.lit(1)).alias("_lines"))
        offsets = Ordered.of(sizes, [], ["CustomerID"], limit=limit).running_sum(_upto=F.col("_lines")).result()
        offsets = offsets.select(F.col("CustomerID").alias("_owner"), (F.col("_upto") - F.col("_lines")).alias("_offset"))
        ledger = ledger.join(offsets, F.col("CustomerID").eqNullSafe(F.col("_owner")), "left").withColumn(
            "LoyaltyRecordID", F.col("_offset") + F.col("_seq"))
    else:
        ledger = ledger.withColumn("LoyaltyRecordID", F.col("_seq"))
    return ledger.select("LoyaltyRecordID", "CustomerID", "TransactionID", "TransactionDate", "PointsEarned",
                         "PointsRedeemed", "PointsBalance", "Tier", "PointsPerDollar", "CumulativeSpend")


def latest_records(loyalty: DataFrame) -> DataFrame:
    """All records of each customer's last date; a customer with several keeps several.

    The last dates are reduced first and joined back on (customer, date), so a customer with very
    many records spreads over as many tasks as they have dates.
    """
    last = loyalty.groupBy("CustomerID").agg(F.max("TransactionDate").alias("TransactionDate"))
    return loyalty.join(last, ["CustomerID", "TransactionDate"])


def tier_order(tier: Column) -> Column:
    place = F.lit(None).cast("int")
    for i, name in enumerate(TIER_NAMES, start=1):
        place = F.when(tier == name, F.lit(i)).otherwise(place)
    return place


def tier_distribution(loyalty: DataFrame) -> DataFrame:
    """Members and points per tier over the latest records, Platinum first."""
    return latest_records(loyalty).groupBy("Tier").agg(
        F.countDistinct("CustomerID").alias("CustomerCount"),
        mean(F.col("PointsBalance")).alias("AvgPointsBalance"),
        F.sum("PointsEarned").alias("TotalPointsEarned"),
        F.sum("PointsRedeemed").alias("TotalPointsRedeemed"),
    ).orderBy(F.desc_nulls_last(tier_order(F.col("Tier"))))


def _tier_flags(loyalty: DataFrame, *keys: Column) -> DataFrame:
    """Per key and customer: points, records and whether each tier occurs. Replaces five distinct counts."""
    return loyalty.groupBy(*keys, "CustomerID").agg(
        F.sum("PointsEarned").alias("_earned"),
        F.sum("PointsRedeemed").alias("_redeemed"),
        F.sum("PointsBalance").alias("_balance"),
        F.count("PointsBalance").alias("_balances"),
        *[F.max(F.when(F.col("Tier") == t, 1).otherwise(0)).alias(t) for t in TIER_NAMES],
    )


def _members(suffix: str) -> list[Column]:
    held = F.col("CustomerID").isNotNull()
    return [F.sum(F.when(held, F.col(t)).otherwise(0)).alias(f"{t}{suffix}") for t in reversed(TIER_NAMES)]


def _balance_mean() -> Column:
    return F.try_divide(F.sum("_balance").cast("double"), F.sum("_balances").cast("double"))


def loyalty_overview(loyalty: DataFrame) -> DataFrame:
    """One row over the latest records: members, points, and members per tier."""
    return _tier_flags(latest_records(loyalty)).agg(
        F.count("CustomerID").alias("TotalMembers"),
        F.sum("_earned").alias("TotalPointsEarned"),
        F.sum("_redeemed").alias("TotalPointsRedeemed"),
        _balance_mean().alias("AvgPointsBalance"),
        *_members("Members"),
    )


def _by_month(loyalty: DataFrame) -> DataFrame:
    return _tier_flags(loyalty, F.year("TransactionDate").alias("Year"), F.month("TransactionDate").alias("Month"))


def monthly_points_activity(loyalty: DataFrame) -> DataFrame:
    """Points and active members per month, newest first."""
    return _by_month(loyalty).groupBy("Year", "Month").agg(
        F.sum("_earned").alias("PointsEarned"),
        F.sum("_redeemed").alias("PointsRedeemed"),
        _balance_mean().alias("AvgPointsBalance"),
        F.count("CustomerID").alias("ActiveMembers"),
    ).orderBy(F.desc("Year"), F.desc("Month"))


def monthly_loyalty_summary(loyalty: DataFrame) -> DataFrame:
    """Monthly activity plus members seen in each tier."""
    return _by_month(loyalty).groupBy("Year", "Month").agg(
        F.count("CustomerID").alias("ActiveMembers"),
        F.sum("_earned").alias("TotalPointsEarned"),
        F.sum("_redeemed").alias("TotalPointsRedeemed"),
        _balance_mean().alias("AvgPointsBalance"),
        *_members("Count"),
    )


def with_previous_tier(loyalty: DataFrame, measure: DataFrame | int | None = None, limit: int | None = None) -> DataFrame:
    """PreviousTier: tier of the customer's record before, by date and record number."""
    rows = Ordered.of(loyalty, ["CustomerID"], RECORD_ORDER, measure=measure, limit=limit)
    return rows.previous(PreviousTier=F.col("Tier")).result()


def tier_migration(loyalty: DataFrame, measure: DataFrame | int | None = None, limit: int | None = None) -> DataFrame:
    """How often customers move from one tier to another, most frequent first."""
    moves = with_previous_tier(loyalty, measure, limit).filter(
        F.col("PreviousTier").isNotNull() & (F.col("PreviousTier") != F.col("Tier")))
    return moves.groupBy(F.col("PreviousTier").alias("FromTier"), F.col("Tier").alias("ToTier")).agg(
        F.count(F.lit(1)).alias("MigrationCount")).orderBy(F.desc("MigrationCount"), "FromTier", "ToTier")


def redemption_range(points: Column) -> Column:
    return (
        F.when(points.between(0, 1000), "0-1K")
        .when(points.between(1001, 5000), "1K-5K")
        .when(points.between(5001, 10000), "5K-10K")
        .otherwise("10K+")
    )


def redemption_patterns(loyalty: DataFrame) -> DataFrame:
    """Redemptions by size, ordered by the label's text."""
    redeemed = loyalty.filter(F.col("PointsRedeemed") > 0)
    return redeemed.groupBy(redemption_range(F.col("PointsRedeemed")).alias("RedemptionRange")).agg(
        F.count(F.lit(1)).alias("RedemptionCount"),
        mean(F.col("PointsRedeemed")).alias("AvgRedemption"),
        F.sum("PointsRedeemed").alias("TotalRedeemed"),
    ).orderBy("RedemptionRange")


def apply_seasonal_uplift(transactions: DataFrame, chosen: Column, months=HOLIDAY_MONTHS, most: int = 10) -> DataFrame:
    """One more unit, at most ``most``, on chosen lines of the holiday months; their totals follow.

    ``chosen`` is a deterministic expression, for example a hash of the line's key below a share.
    """
    boosted = F.month("TransactionDate").isin(list(months)) & chosen
    lifted = F.least(F.col("Quantity") + 1, F.lit(most)).cast("int")
    out = transactions.withColumn("_boosted", F.coalesce(boosted, F.lit(False)))
    out = out.withColumn("Quantity", F.when(F.col("_boosted"), lifted).otherwise(F.col("Quantity")))
    total = F.round(F.col("UnitPrice") * F.col("Quantity"), 2).cast(transactions.schema["LineTotal"].dataType)
    return out.withColumn("LineTotal", F.when(F.col("_boosted"), total).otherwise(F.col("LineTotal"))).drop("_boosted")


# How spend shifts satisfaction, and the NPS score from which a customer recommends.
RECOMMENDS_FROM = 7


def satisfaction_bias(spend: Column) -> Column:
    return F.when(spend.isNull(), F.lit(0.0)).when(spend > 5000, F.lit(0.3)).when(spend > 2000, F.lit(0.1)).otherwise(F.lit(-0.1))


def survey_expectations(customers: DataFrame, transactions: DataFrame, base_score: Column, spend_unit: int = 1) -> DataFrame:
    """Expected survey answers per customer from a base score and total spend."""
    spent = transactions.groupBy("CustomerID").agg(F.sum("LineTotal").alias("TotalSpend"))
    joined = customers.withColumn("_base", base_score).select("CustomerID", "_base").join(spent, "CustomerID", "left")
    bias = satisfaction_bias(F.col("TotalSpend") / spend_unit)
    scored = joined.withColumn("SatisfactionBias", bias).withColumn(
        "SatisfactionScore",
        F.greatest(F.lit(1), F.least(F.lit(5), F.bround(F.col("_base") + F.col("SatisfactionBias"), 0).cast("int"))))
    nps = (F.col("SatisfactionScore") - 1).cast("double") / 4 * 10
    return scored.withColumn("NPSBase", nps).select(
        "CustomerID", "TotalSpend", "SatisfactionBias", "SatisfactionScore", "NPSBase",
        F.when(F.bround("NPSBase", 0) >= RECOMMENDS_FROM, "Yes").otherwise("No").alias("WouldRecommend"))
