"""Repair rules for transactions, loyalty records and surveys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from tillpoint.functions.lineage import stage
from tillpoint.functions.ordered import Ordered
from tillpoint.functions.stats import count_if, number
from tillpoint.schemas import TIER_NAMES

# Identifying columns, quantity range, price spread, tolerance and date range.
LINE_KEY = ["TransactionID", "CustomerID", "ProductID", "TransactionDate"]
LARGEST_QUANTITY = 1000
PRICE_SIGMAS = 3
TOTAL_TOLERANCE = 0.01
FIRST_DATE, LAST_DATE = "2020-01-01", "2025-12-31"

PRICE = T.DecimalType(18, 6)
TOTAL = T.DecimalType(18, 2)


def drop_incomplete(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first in ``order``; remaining columns break ties.

    A minimum over a struct combines on the map side, so a key with very many copies
    never meets in one task, as it would under a row_number window.
    """
    lead = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in lead]
    first = df.groupBy(*keys).agg(F.min(F.struct(*lead, *rest)).alias("_row"))
    return first.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def repaired_quantity(q: Column) -> Column:
    return F.when((q <= 0) | (q > LARGEST_QUANTITY), F.lit(1)).otherwise(q).cast("int")


def has_bad_price(price: Column) -> Column:
    return F.coalesce(price <= 0, F.lit(False))


def line_total(price: Column, quantity: Column) -> Column:
    return F.round(price * quantity, 2).cast(TOTAL)


def cap_prices(df: DataFrame) -> DataFrame:
    """Clip UnitPrice to mean +- 3 sample standard deviations (not below 0); totals of capped lines follow."""
    return _with_caps(df).drop("_capped")


def _with_caps(df: DataFrame) -> DataFrame:
    """``cap_prices`` with ``_capped``, which lines it changed."""
    price = number(F.col("UnitPrice"))
    spread = df.agg(F.struct(F.avg(price).alias("mean"), F.stddev_samp(price).alias("sd")).alias("s"))
    stats = spread.scalar()
    mean, sd = stats.getField("mean"), stats.getField("sd")
    high = mean + PRICE_SIGMAS * sd
    low = F.greatest(F.lit(0.0), mean - PRICE_SIGMAS * sd)
    outside = F.coalesce((price > high) | (price < mean - PRICE_SIGMAS * sd), F.lit(False))
    capped = F.when(price > high, high).otherwise(low)
    flagged = df.withColumn("_capped", outside).withColumn(
        "UnitPrice", F.when(F.col("_capped"), capped.cast(PRICE)).otherwise(F.col("UnitPrice").cast(PRICE)))
    total = F.when(F.col("_capped"), line_total(F.col("UnitPrice"), F.col("Quantity")))
    return flagged.withColumn("LineTotal", total.otherwise(F.col("LineTotal").cast(TOTAL)))


def _off_total() -> Column:
    right = line_total(F.col("UnitPrice"), F.col("Quantity"))
    return F.coalesce(F.abs(F.col("LineTotal") - right) > TOTAL_TOLERANCE, F.lit(False))


def repair_totals(df: DataFrame) -> DataFrame:
    """Replace LineTotal where it is off price x quantity by more than a cent; nulls stay."""
    right = line_total(F.col("UnitPrice"), F.col("Quantity"))
    return df.withColumn("LineTotal", F.when(_off_total(), right).otherwise(F.col("LineTotal")).cast(TOTAL))


def within_dates(day: Column, first, last) -> Column:
    """True inside the range and for missing dates, which only explicit bounds can rule out."""
    return ~F.coalesce((day < F.lit(first).cast("date")) | (day > F.lit(last).cast("date")), F.lit(False))


# What each cleaning step reports, in the order of the steps.
STEP_COUNTS = ["Lines", "MissingKey", "Duplicate", "BadQuantity", "BadPrice", "CappedPrice", "WrongTotal", "DateOutside", "Kept"]


class CleaningCounts:
    """Counts of the cleaning steps, observed while the cleaned lines are computed for someone else.

    Pass one to ``clean_transactions`` and write the result once; then ``row`` or ``table`` have the numbers. They are
    of the first run of the plan; reading them before there was one waits for it. A lost executor's tasks that run
    again may count again, as with every accumulator; ``cleaning_steps`` recounts from the lines.
    """

    def __init__(self):
        self.given, self.single, self.ended = (Observation() for _ in range(3))

    @property
    def row(self) -> dict[str, int]:
        given, single, ended = (o.get for o in (self.given, self.single, self.ended))
        found = {**given, **single, **ended}
        found["MissingKey"] = given["Lines"] - given["Complete"]
        found["Duplicate"] = given["Complete"] - single["Single"]
        return {c: found[c] for c in STEP_COUNTS}

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([tuple(self.row.values())], ", ".join(f"{c} long" for c in STEP_COUNTS))


def _bad_quantity() -> Column:
    return F.coalesce((F.col("Quantity") <= 0) | (F.col("Quantity") > LARGEST_QUANTITY), F.lit(False))


def clean_transactions(df: DataFrame, remove_duplicates: bool = True, handle_outliers: bool = True,
                       first_date=FIRST_DATE, last_date=LAST_DATE,
                       order: tuple[str, ...] = ("StoreID", "Quantity", "UnitPrice", "LineTotal"),
                       counts: CleaningCounts | None = None) -> DataFrame:
    """All line repairs in their fixed order: keys, duplicates, quantity, price, outliers, totals, dates.

    ``order`` names the columns that decide which of several lines with one key is the first. ``counts`` learns from
    the run that computes the result what each step dropped or changed.
    """
    if counts is not None:
        whole = F.lit(True)
        for c in LINE_KEY:
            whole = whole & F.col(c).isNotNull()
        df = df.observe(counts.given, F.count(F.lit(1)).alias("Lines"), count_if(whole).alias("Complete"))
    out = drop_incomplete(df, LINE_KEY)
    if remove_duplicates:
        out = keep_first(out, LINE_KEY, list(order))
    if counts is not None:
        out = out.observe(counts.single, F.count(F.lit(1)).alias("Single"), count_if(_bad_quantity()).alias("BadQuantity"),
                          count_if(has_bad_price(F.col("UnitPrice"))).alias("BadPrice"))
    out = out.withColumn("Quantity", repaired_quantity(F.col("Quantity")))
    out = out.filter(~has_bad_price(F.col("UnitPrice")))
    if handle_outliers:
        out = _with_caps(stage(out))  # the price spread and the lines come from one deduplicated copy
    else:
        out = out.withColumn("_capped", F.lit(False))
    inside = within_dates(F.col("TransactionDate"), first_date, last_date)
    if counts is not None:
        out = out.observe(counts.ended, count_if(F.col("_capped")).alias("CappedPrice"), count_if(_off_total()).alias("WrongTotal"),
                          count_if(~inside).alias("DateOutside"), count_if(inside).alias("Kept"))
    return repair_totals(out.drop("_capped")).filter(inside)


def audit_transactions(df: DataFrame, first_date=FIRST_DATE, last_date=LAST_DATE) -> DataFrame:
    """How many raw lines each rule concerns, as one row: every rule judged on the raw line itself."""
    incomplete = F.lit(False)
    for c in LINE_KEY:
        incomplete = incomplete | F.col(c).isNull()
    q = F.col("Quantity")
    off = F.abs(F.col("LineTotal") - line_total(F.col("UnitPrice"), q)) > TOTAL_TOLERANCE
    per_key = df.groupBy(*LINE_KEY).agg(
        F.count(F.lit(1)).alias("n"),
        count_if((q <= 0) | (q > LARGEST_QUANTITY)).alias("quantity"),
        count_if(F.col("UnitPrice") <= 0).alias("price"),
        count_if(off).alias("total"),
    )
    outside = ~within_dates(F.col("TransactionDate"), first_date, last_date)
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("Lines"),
        F.coalesce(F.sum(F.when(incomplete, F.col("n"))), F.lit(0)).alias("MissingKey"),
        F.coalesce(F.sum(F.when(~incomplete, F.col("n") - 1)), F.lit(0)).alias("Duplicate"),
        F.coalesce(F.sum("quantity"), F.lit(0)).alias("BadQuantity"),
        F.coalesce(F.sum("price"), F.lit(0)).alias("BadPrice"),
        F.coalesce(F.sum("total"), F.lit(0)).alias("WrongTotal"),
        F.coalesce(F.sum(F.when(outside, F.col("n"))), F.lit(0)).alias("DateOutside"),
    )


def cleaning_steps(df: DataFrame, first_date=FIRST_DATE, last_date=LAST_DATE,
                   order: tuple[str, ...] = ("StoreID", "Quantity", "UnitPrice", "LineTotal")) -> DataFrame:
    """How many lines each step of ``clean_transactions`` drops or changes, as one row.

    Every step is judged on what the steps before it left, so Lines less the dropped ones (MissingKey, Duplicate,
    BadPrice, DateOutside) are the lines Kept.
    """
    complete = drop_incomplete(df, LINE_KEY)
    single = stage(keep_first(complete, LINE_KEY, list(order)))
    before = df.agg(F.count(F.lit(1)).alias("Lines"))
    keyed = complete.agg(F.count(F.lit(1)).alias("_complete"))
    repaired = single.agg(F.count(F.lit(1)).alias("_single"), count_if(_bad_quantity()).alias("BadQuantity"),
                          count_if(has_bad_price(F.col("UnitPrice"))).alias("BadPrice"))
    priced = single.withColumn("Quantity", repaired_quantity(F.col("Quantity"))).filter(~has_bad_price(F.col("UnitPrice")))
    outside = ~within_dates(F.col("TransactionDate"), first_date, last_date)
    ended = _with_caps(priced).agg(
        count_if(F.col("_capped")).alias("CappedPrice"), count_if(_off_total()).alias("WrongTotal"),
        count_if(outside).alias("DateOutside"), count_if(~outside).alias("Kept"))
    one = before.crossJoin(keyed).crossJoin(repaired).crossJoin(ended)  # one row each
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return one.select(
        "Lines", (F.col("Lines") - F.col("_complete")).alias("MissingKey"), (F.col("_complete") - F.col("_single")).alias("Duplicate"),
        *[zero(c) for c in ("BadQuantity", "BadPrice", "CappedPrice", "WrongTotal", "DateOutside", "Kept")])


def not_negative(c: Column) -> Column:
    return F.when(c < 0, F.lit(0)).otherwise(c)


def valid_tier(c: Column) -> Column:
    return F.when(c.isin(TIER_NAMES), c).otherwise(F.lit(TIER_NAMES[0]))


def clean_loyalty_data(df: DataFrame, flag_suspicious: bool = False, limit: int | None = None) -> DataFrame:
    """Loyalty repairs; optionally flags redemptions above the customer's previous balance."""
    out = drop_incomplete(df, ["CustomerID", "TransactionID", "TransactionDate"])
    for c in ("PointsEarned", "PointsRedeemed", "PointsBalance"):
        out = out.withColumn(c, not_negative(F.col(c)).cast(df.schema[c].dataType))
    out = out.withColumn("Tier", valid_tier(F.col("Tier")))
    return flag_suspicious_redemptions(out, limit) if flag_suspicious else out


def flag_suspicious_redemptions(df: DataFrame, limit: int | None = None, measure: DataFrame | int | None = None) -> DataFrame:
    """IsSuspicious: more points redeemed than the customer's balance before the record (0 before the first)."""
    rows = Ordered.of(df, ["CustomerID"], ["TransactionDate", "LoyaltyRecordID"], measure=measure, limit=limit)
    seen = rows.previous(_before=F.col("PointsBalance")).result()
    flag = F.coalesce(F.col("PointsRedeemed") > F.coalesce(F.col("_before"), F.lit(0)), F.lit(False))
    return seen.withColumn("IsSuspicious", flag).drop("_before")


# Score ranges of a survey.
SCORE_RANGES = {"SatisfactionScore": (1, 5), "NPSScore": (0, 10)}


def clipped(c: Column, low, high) -> Column:
    return F.when(c < low, F.lit(low)).when(c > high, F.lit(high)).otherwise(c)


def clean_survey_data(df: DataFrame) -> DataFrame:
    """Drop surveys without a customer, clip scores, fill missing scores with the exact median.

    Scores have a handful of values after clipping, so the median aggregates keep a handful of counts.
    """
    out = drop_incomplete(df, ["CustomerID"])
    for c, (low, high) in SCORE_RANGES.items():
        out = out.withColumn(c, number(clipped(F.col(c), low, high)))
    medians = out.agg(F.struct(*[F.median(c).alias(c) for c in SCORE_RANGES]).alias("m")).scalar()
    for c in SCORE_RANGES:
        out = out.withColumn(c, F.coalesce(F.col(c), medians.getField(c)))
    return out


def normalize_dates(df: DataFrame, date_columns: list[str], time_columns: tuple[str, ...] = ()) -> DataFrame:
    """Named text columns become dates, those in ``time_columns`` timestamps that keep the time of day.

    Bad text becomes null; columns of dates or timestamps stay, and names that the table lacks are passed over.
    """
    out = df
    for c in [*date_columns, *time_columns]:
        if c in df.columns and not isinstance(df.schema[c].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            out = out.withColumn(c, F.try_to_timestamp(F.col(c).cast("string")).cast("timestamp" if c in time_columns else "date"))
    return out
