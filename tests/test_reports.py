import itertools
import random
from collections import Counter

import pytest
from conftest import by, day, money
from pyspark.sql import functions as F

from tillpoint.operators import baskets, kpis, loyalty as loy, product_features as pf, reports

LINES = [
    ("T1", "C1", "2023-01-05", "S1", "P1", 1, 10, 10), ("T1", "C1", "2023-01-05", "S1", "P2", 2, 5, 10),
    ("T1", "C1", "2023-01-05", "S1", "P1", 1, 10, 10),
    ("T2", "C2", "2023-02-05", "S1", "P2", 1, 5, 5), ("T3", "C1", "2023-02-06", "S1", "P3", 4, 1, 4),
]


@pytest.fixture(scope="module")
def goods(products):
    return products([("P1", "One", "A", 10, 5), ("P2", "Two", "A", 5, 3), ("P3", "Three", "B", 1, 1), ("P4", "Four", "B", 1, 1)])


@pytest.fixture(scope="module")
def lines(tx):
    return tx(LINES)


def test_lifetime_value_counts_days_and_keeps_idle_customers(lines, customers):
    people = customers([("C1", "2022-01-01"), ("C2", "2022-01-01"), ("C3", "2022-01-01")])
    got = by(reports.customer_lifetime_value(people, lines, "2023-02-10"), "CustomerID")
    assert (got["C1"]["TotalTransactions"], float(got["C1"]["TotalSpent"]), got["C1"]["DaysSinceLastPurchase"]) == (2, 34.0, 4)
    assert (got["C3"]["TotalTransactions"], got["C3"]["TotalSpent"], got["C3"]["LastPurchaseDate"]) == (0, None, None)


@pytest.mark.parametrize("limit", [None, 3])
def test_ntile_scores(tx, limit):
    rows = [(f"T{c}{i}", f"C{c:02d}", f"2023-01-{c + 1:02d}", "S", "P", 1, 1, c % 4 + 1) for c in range(12) for i in range(1)]
    got = by(reports.rfm_scores(tx(rows), "2023-02-01", limit), "CustomerID")
    assert [got[f"C{c:02d}"]["RecencyScore"] for c in range(12)] == [1, 1, 1, 2, 2, 2, 3, 3, 4, 4, 5, 5]
    by_spend = sorted(range(12), key=lambda c: (c % 4, c))
    assert [got[f"C{c:02d}"]["MonetaryScore"] for c in by_spend] == [1, 1, 1, 2, 2, 2, 3, 3, 4, 4, 5, 5]


def test_category_reports(lines, goods):
    got = by(reports.category_performance(lines, goods), "Category")
    a = got["A"]
    assert (a["ProductCount"], a["TransactionCount"], a["TotalUnitsSold"], float(a["TotalRevenue"]), a["AvgTransactionValue"]) == (2, 2, 5, 35.0, 8.75)
    assert by(reports.category_summary(lines, goods), "Category")["A"]["UniqueCustomers"] == 2
    share = by(pf.calculate_category_performance(lines, goods), "Category")
    assert share["A"]["TransactionCount"] == 4 and share["A"]["RevenueShare"] + share["B"]["RevenueShare"] == pytest.approx(1)


def test_daily_and_monthly(lines, goods):
    daily = by(reports.daily_summary(lines), "TransactionDate")
    first = daily[day("2023-01-05")]
    assert (first["TransactionCount"], first["UniqueCustomers"], first["UniqueProducts"], first["TotalQuantity"]) == (1, 1, 2, 4)
    months = [(r["Year"], r["Month"], r["ProductID"]) for r in reports.monthly_product_sales(lines, goods).collect()]
    assert months == [(2023, 2, "P2"), (2023, 2, "P3"), (2023, 1, "P1"), (2023, 1, "P2")]


def test_pairs_by_lines_and_by_baskets(lines, goods):
    assert [tuple(r) for r in baskets.line_pairs(lines, goods, 1).collect()] == [("P1", "P2", "One", "Two", 2)]
    assert baskets.line_pairs(lines, goods, 3).count() == 0
    got = baskets.calculate_cross_sell_opportunities(lines, goods, 1).collect()
    assert [tuple(r) for r in got] == [("P1", "P2", 1, "One", "Two")]


@pytest.mark.parametrize("block", [2, 5, 1000])
def test_pairs_against_brute_force(tx, products, block):
    pick = random.Random(block)
    sold = [(f"T{t}", f"P{pick.randint(0, 14):02d}") for t in range(12) for _ in range(pick.choice([1, 3, 25]))]
    facts = tx([(t, "C", "2023-01-01", "S", p, 1, 1, 1) for t, p in sold])
    goods = products([(f"P{i:02d}", f"N{i}", "A", 1, 1) for i in range(15)])
    by_basket = {t: [p for u, p in sold if u == t] for t, _ in sold}
    lines, sets = Counter(), Counter()
    for content in by_basket.values():
        lines.update(tuple(sorted(pair)) for pair in itertools.combinations(content, 2) if pair[0] != pair[1])
        sets.update(itertools.combinations(sorted(set(content)), 2))
    got = {(r["Product1ID"], r["Product2ID"]): r["CoOccurrence"] for r in baskets.line_pairs(facts, goods, 2, block).collect()}
    assert got == {k: n for k, n in lines.items() if n >= 2}
    got = {(r["Product1"], r["Product2"]): r["CoOccurrence"] for r in baskets.calculate_cross_sell_opportunities(facts, goods, 3, block).collect()}
    assert got == {k: n for k, n in sets.items() if n >= 3}


def test_no_pairs_gives_empty_typed_frame(daily, products):
    goods = products([(f"P{i}", "n", "A", 1, 1) for i in range(10)])
    got = baskets.calculate_cross_sell_opportunities(daily, goods)
    assert got.count() == 0 and got.columns == ["Product1", "Product2", "CoOccurrence", "Product1Name", "Product2Name"]


def test_product_performance_and_affinity(tx, products):
    rows = []
    for i in range(50):
        q, total = ((1, 10), (2, 10), (1, 40), (2, 40))[(i >= 25) * 2 + i % 2]
        when = day("2023-01-01").fromordinal(day("2023-01-01").toordinal() + i).isoformat()
        rows.append((f"T{i}", f"C{i % 3}", when, "S", "P1" if i < 25 else "P2", q, total / q, total))
    goods = products([("P1", "One", "A", 10, 5), ("P2", "Two", "B", 20, 10), ("P3", "Unsold", "B", 20, 10)])
    got = by(pf.calculate_product_performance(tx(rows), goods, "2023-02-19"), "ProductID")
    one, two = got["P1"], got["P2"]
    assert (one["TransactionCount"], one["TotalUnitsSold"], float(one["TotalRevenue"]), one["ProfitMargin"], float(one["TotalProfit"])) == (25, 37, 250, 0.5, 65)
    assert (two["TotalUnitsSold"], float(two["TotalProfit"]), two["ProductAge"]) == (38, 620, 24)
    assert one["SalesVelocity"] == pytest.approx(37 / 49) and two["SalesVelocity"] == pytest.approx(38 / 24)
    matrix = by(pf.create_product_feature_matrix(tx(rows), goods), "ProductID")
    assert float(matrix["P3"]["TotalRevenue"]) == 0 and matrix["P3"]["TrendDirection"] is None and matrix["P2"]["TrendDirection"] == "growing"
    scores = pf.calculate_customer_product_affinity(tx(rows)).collect()
    assert len(scores) == 6 and all(0 <= r["AffinityScore"] <= 1 for r in scores)
    best = max(scores, key=lambda r: r["LastPurchaseDate"])
    assert best["RecencyScore"] == 1 and best["DaysSinceLastPurchase"] == 0


HISTORY = [
    (1, "C1", "T1", "2023-01-01", 100, 0, 100, "Bronze", 1), (2, "C1", "T2", "2023-01-09", 50, 0, 150, "Bronze", 1),
    (3, "C1", "T3", "2023-01-09", 50, 20, 180, "Silver", "1.15"), (4, "C2", "T4", "2023-02-01", 10, 1500, 5, "Gold", "1.25"),
    (5, "C2", "T5", "2023-02-03", 10, 5, 10, "Bronze", 1),
]


def test_latest_date_keeps_ties(loyalty):
    got = by(loy.tier_distribution(loyalty(HISTORY)), "Tier")
    assert {k: r["CustomerCount"] for k, r in got.items()} == {"Silver": 1, "Bronze": 2}
    row = loy.loyalty_overview(loyalty(HISTORY)).first()
    assert (row["TotalMembers"], row["TotalPointsEarned"], row["SilverMembers"], row["BronzeMembers"], row["GoldMembers"]) == (2, 110, 1, 2, 0)


@pytest.mark.parametrize("limit", [None, 1])
def test_migration(loyalty, limit):
    got = {(r["FromTier"], r["ToTier"]): r["MigrationCount"] for r in loy.tier_migration(loyalty(HISTORY), limit=limit).collect()}
    assert got == {("Bronze", "Silver"): 1, ("Gold", "Bronze"): 1}


def test_redemptions_and_months(loyalty):
    got = {r["RedemptionRange"]: r["RedemptionCount"] for r in loy.redemption_patterns(loyalty(HISTORY)).collect()}
    assert got == {"0-1K": 2, "1K-5K": 1}
    months = [(r["Month"], r["ActiveMembers"], r["BronzeCount"]) for r in loy.monthly_loyalty_summary(loyalty(HISTORY)).orderBy("Month").collect()]
    assert months == [(1, 1, 1), (2, 1, 1)]
    assert [r["Month"] for r in loy.monthly_points_activity(loyalty(HISTORY)).collect()] == [2, 1]


@pytest.mark.parametrize("limit", [None, 2])
def test_ledger_against_step_by_step(tx, limit):
    pick = random.Random(11)
    rows = [(f"T{i:02d}", f"C{i % 2}", f"2023-01-{i % 28 + 1:02d}", "S", f"P{i:02d}", 1, 1, pick.choice([100, 4000, 9000.5])) for i in range(40)]
    redeemed = F.when(F.pmod(F.xxhash64("TransactionID"), F.lit(3)) == 0, 6000).otherwise(0)
    facts = tx(rows)
    taken = {r[0]: r[1] for r in facts.select("TransactionID", redeemed).collect()}
    got = by(loy.build_points_ledger(facts, ["TransactionDate", "TransactionID"], redeemed, limit=limit), "TransactionID")
    number = 0
    for c in ("C0", "C1"):
        spend = balance = 0
        for t, _, when, _, _, _, _, total in sorted((r for r in rows if r[1] == c), key=lambda r: (r[2], r[0])):
            number, spend = number + 1, spend + total
            tier, rate = next(x for x in (("Platinum", 1.5), ("Gold", 1.25), ("Silver", 1.15), ("Bronze", 1.0))
                              if spend >= {"Platinum": 50000, "Gold": 25000, "Silver": 10000, "Bronze": 0}[x[0]])
            earned = round(total * rate)
            balance = max(0, balance + earned - taken[t])
            row = got[t]
            assert (row["LoyaltyRecordID"], row["Tier"], row["PointsEarned"], row["PointsBalance"]) == (number, tier, earned, balance)


def test_seasonal_uplift_and_survey_rules(tx, customers):
    rows = [("T1", "C1", "2023-12-01", "S", "P", 10, 2, 20), ("T2", "C1", "2023-12-01", "S", "P", 1, 2, 2), ("T3", "C2", "2023-06-01", "S", "P", 1, 2, 2)]
    got = by(loy.apply_seasonal_uplift(tx(rows), F.lit(True)), "TransactionID")
    assert {k: (r["Quantity"], r["LineTotal"]) for k, r in got.items()} == {"T1": (10, money(20)), "T2": (2, money(4)), "T3": (1, money(2))}
    spent = tx([("T1", "C1", "2023-01-01", "S", "P", 1, 1, 6000), ("T2", "C2", "2023-01-01", "S", "P", 1, 1, 2500), ("T3", "C3", "2023-01-01", "S", "P", 1, 1, 5)])
    people = customers([(c, "2022-01-01") for c in ("C1", "C2", "C3", "C4")])
    got = by(loy.survey_expectations(people, spent, F.lit(4.4)), "CustomerID")
    assert {k: (r["SatisfactionBias"], r["SatisfactionScore"], r["WouldRecommend"]) for k, r in got.items()} == {
        "C1": (0.3, 5, "Yes"), "C2": (0.1, 4, "Yes"), "C3": (-0.1, 4, "Yes"), "C4": (0.0, 4, "Yes")}


def test_kpis(spark, lines, goods):
    assert [tuple(r) for r in kpis.monthly_revenue(lines).collect()] == [("2023-01", money(30)), ("2023-02", money(9))]
    top = kpis.top_products_with_price(lines, goods, 1).collect()
    assert [(r["ProductID"], r["AvgPrice"]) for r in top] == [("P1", 10.0)]
    assert kpis.product_revenue(lines, goods).count() == 3
    labels = spark.createDataFrame([("a", 0), ("b", 1), ("c", 1)], "CustomerID string, Segment int")
    names = spark.createDataFrame([(0, "Same"), (1, "Same")], "Segment int, SegmentName string")
    dist = kpis.segment_distribution(labels, names)
    assert [tuple(r) for r in dist.collect()] == [(0, "Same", 1, 33.33), (1, "Same", 2, 66.67)]
    risks = spark.createDataFrame([("a", 0.9, 1, "Critical"), ("b", 0.0, 0, None), ("c", 0.1, 0, "Low")],
                                  "CustomerID string, ChurnProbability double, ChurnPrediction int, RiskLevel string")
    table = kpis.risk_distribution(risks)
    assert {(r["RiskLevel"], r["Percentage"]) for r in table.collect()} == {("Critical", 33.33), ("Low", 33.33)}
    features = spark.createDataFrame([("a", 10.0, 1.0), ("b", 20.0, 2.0), ("c", 30.0, 3.0)], "CustomerID string, LifetimeValue double, Recency double")
    insights = kpis.headline_insights(dist, table)
    assert tuple(insights.first()) == ("Same", 66.67, 1, 33.33)
    assert [r["Action"] for r in kpis.recommended_actions(insights, features).collect()] == ["Urgent", "Focus", "Opportunity"]
    assert tuple(kpis.high_value_customers(features).first()) == (25.0, 1)
    assert [tuple(r) for r in kpis.metrics_by_segment_name(features, labels, names).collect()] == [("Same", 2.0, 20.0)]
    assert [r["CustomerID"] for r in kpis.at_risk_customers(risks, n=2).collect()] == ["a", "c"]
    headline = kpis.kpi_metrics(lines, labels, risks, features).first()
    assert (headline["total_customers"], headline["total_transactions"], headline["unique_products"], headline["active_customers"]) == (3, 5, 3, 2)


def test_ledger_numbers_lines_without_customer(tx):
    lines = tx([("T1", "C1", "2023-01-01", "S1", "P1", 1, 10, 10), ("T2", None, "2023-01-02", "S1", "P1", 1, 10, 10)])
    for record_ids in (True, False):
        got = loy.build_points_ledger(lines, ["TransactionDate", "TransactionID"], F.lit(0), record_ids=record_ids)
        assert got.count() == 2 and got.filter("LoyaltyRecordID IS NULL").count() == 0
