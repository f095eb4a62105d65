import pytest
from conftest import by, day

from tillpoint import schemas
from tillpoint.operators import customer_features as cf

REF = "2023-04-10"


@pytest.fixture(scope="module")
def goods(products):
    return products([(f"P{i}", f"Product {i}", "A" if i < 5 else "B", 20, 10) for i in range(10)])


@pytest.fixture(scope="module")
def people(customers):
    return customers([("C1", "2022-01-01"), ("C2", "2022-02-01"), ("C3", "2022-03-01")])


@pytest.fixture(scope="module")
def points(loyalty):
    rows, balance = [], {}
    for i in range(100):
        c = "C1" if i < 50 else "C2"
        rows.append((i + 1, c, f"T{i:03d}", f"{day('2023-01-01').fromordinal(day('2023-01-01').toordinal() + i)}",
                     10 if i % 2 == 0 else 20, 0, (10, 30, 40, 60)[i % 4], "Bronze", 1))
    return loyalty(rows)


def check(row, **expected):
    for name, value in expected.items():
        got = float(row[name]) if isinstance(value, (int, float)) else row[name]
        assert got == pytest.approx(value, abs=1e-6), name


@pytest.mark.parametrize("limit", [None, 1])
def test_rfm(daily, limit):
    got = by(cf.calculate_rfm_features(daily, REF, limit), "CustomerID")
    shared = dict(Frequency=50, TotalSpend=1250, AvgTransactionValue=25, LifetimeValue=1250, CustomerLifetime=49, AvgDaysBetweenPurchases=0.98)
    check(got["C1"], Recency=50, RecencyScore=1, FrequencyScore=1, MonetaryScore=1, RFMScore=111, **shared)
    check(got["C2"], Recency=0, RecencyScore=5, FrequencyScore=5, MonetaryScore=5, RFMScore=555, **shared)


def test_reference_date_defaults_to_newest_line(daily):
    assert by(cf.calculate_rfm_features(daily), "CustomerID")["C1"]["Recency"] == 50


def test_periods(daily):
    got = by(cf.calculate_frequency_by_period(daily, REF), "CustomerID")
    check(got["C1"], Frequency_30d=0, Frequency_60d=11, Frequency_90d=41, Frequency_365d=50,
          Spend_30d=0, Spend_60d=290, Spend_90d=1040, Spend_365d=1250)
    check(got["C2"], Frequency_30d=31, Frequency_60d=50, Frequency_90d=50, Frequency_365d=50,
          Spend_30d=790, Spend_60d=1250, Spend_90d=1250, Spend_365d=1250)


def test_engagement(daily, goods):
    for row in by(cf.calculate_engagement_features(daily, goods), "CustomerID").values():
        check(row, DaysActive=50, ActiveMonths=2, UniqueProducts=10, UniqueCategories=2, TotalItemsPurchased=75,
              TotalTransactions=50, AvgBasketSize=1.5, PurchaseVelocity=25, ProductDiversity=0.2)


def test_trends(daily):
    got = by(cf.calculate_behavioral_features(daily, REF), "CustomerID")
    check(got["C1"], RecentFrequency=41, HistoricalFrequency=9, RecentSpend=1040, HistoricalSpend=210, FrequencyTrend=3.2,
          SpendingTrend=830 / 211, BasketSizeTrend=0.027716, FrequencyTrendDirection="increasing", SpendingTrendDirection="increasing")
    check(got["C2"], RecentFrequency=50, HistoricalFrequency=0, FrequencyTrend=50, SpendingTrend=1250, BasketSizeTrend=1.5)


def test_seasons(daily):
    got = by(cf.calculate_seasonal_features(daily), "CustomerID")
    check(got["C1"], HolidayTransactions=50, HolidayActivityRatio=1.0, Q1_Transactions=50, Q2_Transactions=0, PreferredQuarter=1)
    check(got["C2"], HolidayTransactions=9, HolidayActivityRatio=0.18, Q1_Transactions=40, Q2_Transactions=10, PreferredQuarter=1)


def test_preferred_quarter_tie_goes_to_the_earlier(tx):
    rows = [(f"T{m}", "C1", f"2023-{m:02d}-15", "S", "P", 1, 1, 1) for m in (4, 5, 10, 11)]
    assert cf.calculate_seasonal_features(tx(rows)).first()["PreferredQuarter"] == 2


@pytest.mark.parametrize("limit", [None, 9])
def test_loyalty(points, people, limit):
    got = by(cf.calculate_loyalty_features(points, people, REF, limit=limit), "CustomerID")
    for row in got.values():
        check(row, TotalPointsEarned=750, AvgPointsEarned=15, PointsTransactions=50, TotalPointsRedeemed=0, RedemptionRate=0,
              TierNumeric=1, TierChanges=0, PointsPerDollarRatio=1)
    check(got["C1"], CurrentPointsBalance=30, DaysSinceEnrollment=464)
    check(got["C2"], CurrentPointsBalance=60, DaysSinceEnrollment=433)


@pytest.mark.parametrize("limit", [None, 1])
def test_last_means_newest_non_null_by_date(loyalty, people, limit):
    rows = [(3, "C1", "T3", "2023-03-01", 5, 0, 50, None, "1.25"), (1, "C1", "T1", "2023-01-01", 5, 0, 10, "Bronze", 1),
            (2, "C1", "T2", "2023-02-01", 5, 0, 20, "Gold", "1.25"), (4, "C1", "T4", "2023-02-01", 5, 0, 25, "Silver", "1.15")]
    row = cf.calculate_loyalty_features(loyalty(rows), people, REF, limit=limit).first()
    assert (row["CurrentPointsBalance"], row["CurrentTier"], row["TierNumeric"], row["TierChanges"]) == (50, "Silver", 2, 2)


def test_matrix(daily, points, people, goods, spark):
    surveys = spark.createDataFrame([(1, "C1", day("2023-01-01"), 4, 8, "", "Yes"), (2, "C1", day("2023-01-02"), 5, 3, "", "No")], schemas.SURVEYS)
    matrix = cf.create_feature_matrix(daily, points, people, goods, surveys, REF)
    assert len([c for c, t in matrix.dtypes if t not in ("string", "date", "boolean")]) == 61
    got = by(matrix, "CustomerID")
    check(got["C1"], Recency=50, Frequency_60d=11, CurrentPointsBalance=30, AvgBasketSize=1.5, FrequencyTrend=3.2,
          HolidayTransactions=50, AvgSatisfactionScore=4.5, RecommendationRate=0.5)
    check(got["C2"], AvgSatisfactionScore=0, RecommendationRate=0)
    idle = got["C3"]
    check(idle, Recency=0, RFMScore=0, TotalSpend=0, TierNumeric=0, FrequencyTrend=0)
    assert idle["IsActive"] is False and idle["LastPurchaseDate"] is None and idle["FrequencyTrendDirection"] is None
    kept = by(cf.create_feature_matrix(daily, points, people, goods, None, REF, missing_recency="null", spend_copies=True), "CustomerID")
    assert kept["C3"]["Recency"] is None and "AvgNPSScore" not in kept["C3"] and kept["C1"]["TotalSpend_y"] == kept["C1"]["TotalSpend"]


def test_dates_make_midnight_one_day(spark):
    df = spark.createDataFrame([("C1", "2023-01-01 23:00:00"), ("C1", "2023-01-02 01:00:00")], "CustomerID string, t string")
    row = df.selectExpr("CustomerID", "cast(t as date) as TransactionDate", "'T' as TransactionID", "cast(1 as decimal(10,2)) as LineTotal")
    assert cf.calculate_rfm_features(row).first()["CustomerLifetime"] == 1
