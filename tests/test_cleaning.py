from decimal import Decimal

import pytest
from conftest import by, day

from tillpoint import schemas
from tillpoint.operators import cleaning, merge, quality

BASE = [
    ("T1", "C1", "2023-01-01", "S1", "P1", 2, 10, 20),
    ("T2", "C2", "2023-01-02", "S1", "P2", 1, 5, 5),
    ("T3", "C1", "2023-01-01", "S1", "P1", 2, 10, 20),
    ("T4", "C3", "2023-01-03", "S2", "P3", 3, 4, 12),
]


def test_clean_lines_stay(tx):
    assert cleaning.clean_transactions(tx(BASE)).count() == 4
    assert cleaning.clean_transactions(tx(BASE + BASE[:1])).count() == 4


def test_duplicates_keep_the_first_in_order(tx):
    rows = [("T1", "C1", "2023-01-01", "S1", "P1", 2, 10, 20), ("T1", "C1", "2023-01-01", "S1", "P1", 1, 10, 10)]
    kept = cleaning.clean_transactions(tx(rows)).collect()
    assert [(r["Quantity"], r["LineTotal"]) for r in kept] == [(1, Decimal("10.00"))]
    assert cleaning.clean_transactions(tx(rows), remove_duplicates=False).count() == 2


def test_missing_key_and_date_range(tx):
    rows = [("T1", None, "2023-01-01", "S1", "P1", 1, 5, 5), ("T2", "C1", "2019-12-31", "S1", "P1", 1, 5, 5),
            ("T3", "C1", "2020-01-01", "S1", "P1", 1, 5, 5), ("T4", "C1", "2025-12-31", "S1", "P1", 1, 5, 5),
            ("T5", "C1", "2026-01-01", "S1", "P1", 1, 5, 5), ("T6", "C1", None, "S1", "P1", 1, 5, 5)]
    assert sorted(by(cleaning.clean_transactions(tx(rows)), "TransactionID")) == ["T3", "T4"]


@pytest.mark.parametrize("quantity, expected", [(-1, 1), (0, 1), (1000, 1000), (1001, 1), (None, None)])
def test_quantity_repair(tx, quantity, expected):
    row = cleaning.clean_transactions(tx([("T1", "C1", "2023-01-01", "S1", "P1", quantity, "10.99", "-10.99")])).first()
    assert row["Quantity"] == expected
    if expected == 1:
        assert row["LineTotal"] == Decimal("10.99")


def test_price_rules(tx):
    rows = [("T1", "C1", "2023-01-01", "S1", "P1", 1, 0, 0), ("T2", "C1", "2023-01-01", "S1", "P1", 1, None, 7),
            ("T3", "C1", "2023-01-01", "S1", "P1", 1, -2, -2)]
    left = cleaning.clean_transactions(tx(rows)).collect()
    assert [(r["TransactionID"], r["LineTotal"]) for r in left] == [("T2", Decimal("7.00"))]


def test_total_is_repaired_beyond_a_cent(tx):
    rows = [("T1", "C1", "2023-01-01", "S1", "P1", 2, 10, "20.01"), ("T2", "C1", "2023-01-01", "S1", "P1", 2, 10, "20.02")]
    got = by(cleaning.clean_transactions(tx(rows)), "TransactionID")
    assert (got["T1"]["LineTotal"], got["T2"]["LineTotal"]) == (Decimal("20.01"), Decimal("20.00"))


def test_outlier_is_capped_and_its_total_follows(tx):
    rows = [(f"T{i}", "C1", "2023-01-01", "S1", "P1", 2, 10, 20) for i in range(30)]
    rows.append(("TX", "C1", "2023-01-01", "S1", "P1", 2, 1000, 2000))
    prices = [10.0] * 30 + [1000.0]
    mean = sum(prices) / 31
    sd = (sum((p - mean) ** 2 for p in prices) / 30) ** 0.5
    got = by(cleaning.clean_transactions(tx(rows)), "TransactionID")
    assert float(got["TX"]["UnitPrice"]) == pytest.approx(mean + 3 * sd, abs=1e-5)
    assert float(got["TX"]["LineTotal"]) == pytest.approx(round((mean + 3 * sd) * 2, 2), abs=0.005)
    assert float(got["T0"]["UnitPrice"]) == 10
    assert float(by(cleaning.clean_transactions(tx(rows), handle_outliers=False), "TransactionID")["TX"]["UnitPrice"]) == 1000


def test_audit(tx):
    rows = BASE + BASE[:1] + [("T9", None, "2023-01-01", "S1", "P1", -1, 0, 3), ("T8", "C1", "2030-01-01", "S1", "P1", 1, 5, 9)]
    got = cleaning.audit_transactions(tx(rows)).first().asDict()
    assert got == {"Lines": 7, "MissingKey": 1, "Duplicate": 1, "BadQuantity": 1, "BadPrice": 1, "WrongTotal": 2, "DateOutside": 1}


def test_loyalty_repairs(loyalty):
    rows = [(1, "C1", "T1", "2023-01-01", -10, -1, -10, "Diamond", 1), (2, "C1", "T2", "2023-01-02", 5, 0, 15, None, 1),
            (3, None, "T3", "2023-01-02", 5, 0, 15, "Gold", 1)]
    got = by(cleaning.clean_loyalty_data(loyalty(rows)), "LoyaltyRecordID")
    assert sorted(got) == [1, 2]
    assert (got[1]["PointsEarned"], got[1]["PointsRedeemed"], got[1]["PointsBalance"], got[1]["Tier"]) == (0, 0, 0, "Bronze")
    assert got[2]["Tier"] == "Bronze"


@pytest.mark.parametrize("limit", [None, 1])
def test_suspicious_redemptions_look_at_the_same_customer(loyalty, limit):
    rows = [(1, "C1", "T1", "2023-01-01", 100, 0, 100, "Bronze", 1), (2, "C2", "T2", "2023-01-02", 10, 50, 0, "Bronze", 1),
            (3, "C1", "T3", "2023-01-03", 10, 90, 20, "Bronze", 1), (4, "C1", "T4", "2023-01-04", 10, 30, 0, "Bronze", 1)]
    got = by(cleaning.clean_loyalty_data(loyalty(rows), flag_suspicious=True, limit=limit), "LoyaltyRecordID")
    assert {k: r["IsSuspicious"] for k, r in got.items()} == {1: False, 2: True, 3: False, 4: True}


def test_survey_repairs(spark):
    rows = [(1, "C1", day("2023-01-01"), 10, 15, "x", "Yes"), (2, "C2", day("2023-01-01"), 0, -1, "x", "No"),
            (3, "C3", day("2023-01-01"), None, None, "x", "No"), (4, None, day("2023-01-01"), 3, 3, "x", "No")]
    got = by(cleaning.clean_survey_data(spark.createDataFrame(rows, schemas.SURVEYS)), "SurveyID")
    assert {k: (r["SatisfactionScore"], r["NPSScore"]) for k, r in got.items()} == {1: (5, 10), 2: (1, 0), 3: (3, 5)}


def test_dates_from_text(spark):
    df = spark.createDataFrame([("2023-05-01", "2023-05-01 23:00:00"), ("soon", None)], "a string, b string")
    got = cleaning.normalize_dates(df, ["a", "b", "c"])
    assert dict(got.dtypes) == {"a": "date", "b": "date"}
    assert {tuple(r) for r in got.collect()} == {(None, None), (day("2023-05-01"), day("2023-05-01"))}
    timed = cleaning.normalize_dates(df, ["a"], ("b",))
    assert dict(timed.dtypes) == {"a": "date", "b": "timestamp"}
    assert timed.filter("b = timestamp'2023-05-01 23:00:00'").count() == 1


def test_orphans_and_null_keys(spark, tx, loyalty, customers, products):
    facts = tx(BASE + [("T9", None, "2023-01-01", "S9", "P1", 1, 5, 5)])
    points = loyalty([(1, "C1", "T1", "2023-01-01", 1, 0, 1, "Bronze", 1), (2, "C9", "T77", "2023-01-01", 1, 0, 1, "Bronze", 1)])
    surveys = spark.createDataFrame([(1, "C1", day("2023-01-01"), 5, 9, "", "Yes")], schemas.SURVEYS)
    stores = spark.createDataFrame([("S1",), ("S2",)], "StoreID string")
    goods = products([(f"P{i}", "n", "c", 1, 1) for i in (1, 2, 3)])
    people = customers([("C1", "2022-01-01"), ("C2", "2022-01-01"), ("C3", "2022-01-01")])
    got = by(quality.validate_referential_integrity(facts, points, surveys, people, goods, stores), "CheckName")
    assert {k: r["OrphanCount"] for k, r in got.items()} == {
        "transactions_customers": 1, "transactions_products": 0, "transactions_stores": 1, "loyalty_transactions": 1,
        "loyalty_customers": 1, "surveys_customers": 0}
    assert [k for k, r in got.items() if r["Passed"]] == ["transactions_products", "surveys_customers"]


def test_quality_metrics(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", float("nan")), (None, None)], "k string, v double")
    got = quality.calculate_data_quality_metrics(df).first()
    assert (got["total_records"], got["total_columns"], got["missing_values"], got["duplicate_records"]) == (4, 2, 3, 1)
    assert got["missing_percentage"] == pytest.approx(37.5) and got["duplicate_percentage"] == 25
    empty = quality.calculate_data_quality_metrics(df.limit(0)).first()
    assert (empty["total_records"], empty["missing_percentage"], empty["duplicate_percentage"]) == (0, 0, 0)


def test_domain_rules(spark):
    df = spark.createDataFrame([(5, 10), (6, -1), (None, 3)], "SatisfactionScore int, NPSScore int")
    assert {r["Rule"]: r["Violations"] for r in quality.check_domains(df, quality.survey_score_rules()).collect()} == {
        "SatisfactionScore": 1, "NPSScore": 1}


def test_merge_keeps_lines_and_names_customer_place(spark, tx, loyalty, customers, products):
    points = loyalty([(1, "C1", "T1", "2023-01-01", 10, 0, 10, "Bronze", 1), (2, "C1", "T1", "2023-01-01", 5, 3, 12, "Silver", "1.15")])
    surveys = spark.createDataFrame([(1, "C1", day("2023-01-01"), 4, 8, "", "Yes"), (2, "C1", day("2023-01-02"), 5, 2, "", "No")], schemas.SURVEYS)
    stores = spark.createDataFrame([("S1", "Main", "Old Town", "QC", "")], schemas.STORES)
    merged = merge.merge_datasets(tx(BASE), points, surveys, customers([("C1", "2022-01-01")]), products([("P1", "n", "c", 12, 6)]), stores)
    assert merged.count() == 4
    got = by(merged, "TransactionID")
    first = got["T1"]
    assert (first["PointsEarned"], first["PointsRedeemed"], first["PointsBalance"], first["Tier"]) == (15, 3, 12, "Silver")
    assert (first["SatisfactionScore"], first["NPSScore"], first["WouldRecommend"]) == (4.5, 5.0, "Yes")
    assert (first["City"], first["City_customer"]) == ("Old Town", "Town")
    assert got["T4"]["PointsEarned"] is None and got["T2"]["SatisfactionScore"] is None


def test_steps_add_up(tx):
    rows = [(f"T{i}", "C1", "2023-01-01", "S1", "P1", 1, 10, 10) for i in range(40)]
    rows += [("T0", "C1", "2023-01-01", "S1", "P1", 1, 10, 10), (None, "C1", "2023-01-01", "S1", "P1", 1, 10, 10), ("Q", "C1", "2023-01-01", "S1", "P1", 0, 10, 10),
             ("N", "C1", "2023-01-01", "S1", "P1", 1, -1, 10), ("X", "C1", "2023-01-01", "S1", "P1", 1, 9000, 9000), ("W", "C1", "2023-01-01", "S1", "P1", 2, 10, 99),
             ("D", "C1", "2019-01-01", "S1", "P1", 1, 10, 10)]
    lines = tx(rows)
    got = cleaning.cleaning_steps(lines).first().asDict()
    assert got == {"Lines": 47, "MissingKey": 1, "Duplicate": 1, "BadQuantity": 1, "BadPrice": 1, "CappedPrice": 1, "WrongTotal": 1,
                   "DateOutside": 1, "Kept": 43}
    assert cleaning.clean_transactions(lines).count() == got["Kept"]


def test_steps_are_observed_in_the_write(spark, tx, tmp_path):
    """The counts come from the one run that writes the cleaned lines, and equal the recount."""
    rows = [(f"T{i}", "C1", "2023-01-01", "S1", "P1", 1, 10, 10) for i in range(40)]
    rows += [("T0", "C1", "2023-01-01", "S1", "P1", 1, 10, 10)] * 3 + [(None, "C1", "2023-01-01", "S1", "P1", 1, 10, 10), ("Q", "C1", "2023-01-01", "S1", "P1", 0, 10, 10),
             ("Q2", "C1", "2023-01-01", "S1", "P1", 5000, 10, 10), ("N", "C1", "2023-01-01", "S1", "P1", 1, -1, 10), ("X", "C1", "2023-01-01", "S1", "P1", 1, 9000, 9000),
             ("W", "C1", "2023-01-01", "S1", "P1", 2, 10, 99), ("D", "C1", "2019-01-01", "S1", "P1", 1, 10, 10), ("M", "C1", None, "S1", "P1", None, None, None)]
    lines = tx(rows).repartition(3)
    counts = cleaning.CleaningCounts()
    cleaning.clean_transactions(lines, counts=counts).write.parquet(str(tmp_path / "clean"))
    want = cleaning.cleaning_steps(lines).first().asDict()
    assert counts.row == want and want["Duplicate"] == 3 and want["BadQuantity"] == 2
    assert counts.table(spark).first().asDict() == want
    assert spark.read.parquet(str(tmp_path / "clean")).count() == want["Kept"]


@pytest.mark.parametrize("options", [{"handle_outliers": False}, {"remove_duplicates": False}, {"handle_outliers": False, "remove_duplicates": False}])
def test_observing_changes_no_line(tx, options):
    lines = tx([(f"T{i % 9}", "C1", "2023-01-01", "S1", "P1", i, 10 + i, 99) for i in range(20)])
    plain = sorted(map(str, cleaning.clean_transactions(lines, **options).collect()))
    counts = cleaning.CleaningCounts()
    assert sorted(map(str, cleaning.clean_transactions(lines, counts=counts, **options).collect())) == plain
    assert counts.row["Kept"] == len(plain) and counts.row["Duplicate"] == (0 if "remove_duplicates" in options else counts.row["Duplicate"])


def test_no_lines_give_zero_counts(tx):
    lines = tx([("T", "C1", "2023-01-01", "S1", "P1", 1, 10, 10)]).filter("false")
    counts = cleaning.CleaningCounts()
    assert cleaning.clean_transactions(lines, counts=counts).collect() == []
    assert set(counts.row.values()) == {0}
