from __future__ import annotations

import datetime as dt
import os

import pytest
from conftest import by, day
from pyspark.sql import functions as F

from checks.plans import exchanges
from tillpoint.operators import churn, customer_features as cf, loyalty as loy, quality, reports, segmentation as seg, sessions
from tillpoint.sources import clustered


def test_sessions_end_after_the_gap(tx):
    lines = tx([("T1", "C1", "2023-01-01", "S", "P", 2, 10, 20), ("T1", "C1", "2023-01-01", "S", "Q", 1, 5, 5), ("T2", "C1", "2023-01-31", "S", "P", 1, 10, 10),
                ("T3", "C1", "2023-03-03", "S", "P", 1, 10, 10), ("T4", "C2", "2023-01-01", "S", "P", 1, 10, 10), ("T5", None, "2023-01-01", "S", "P", 1, 10, 10),
                ("T6", "C1", None, "S", "P", 1, 10, 10)])
    got = sorted((r["CustomerID"], r["SessionStart"], r["SessionEnd"], r["ActiveDays"], r["Lines"], r["Units"], float(r["Spend"]))
                 for r in sessions.purchase_sessions(lines).collect())
    assert got == [("C1", day("2023-01-01"), day("2023-01-31"), 2, 3, 4, 35.0), ("C1", day("2023-03-03"), day("2023-03-03"), 1, 1, 1, 10.0),
                   ("C2", day("2023-01-01"), day("2023-01-01"), 1, 1, 1, 10.0)]
    features = by(sessions.calculate_session_features(lines), "CustomerID")
    assert (features["C1"]["Sessions"], features["C1"]["LongestSessionDays"], features["C1"]["AvgActiveDays"]) == (2, 31, 1.5)
    assert sessions.purchase_sessions(lines.filter("false")).collect() == []
    assert sessions.purchase_sessions(lines, 29).filter("CustomerID = 'C1'").count() == 3


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_only_the_months_of_late_days_are_written_again(spark, tx, tmp_path):
    rows = [(f"T{i}", f"C{i % 4}", (day("2023-01-01") + dt.timedelta(days=3 * i)).isoformat(), "S", f"P{i % 3}", 1, 10, 10 + i) for i in range(60)]
    early, late = tx(rows), tx(rows + [("L1", "C9", "2023-02-10", "S", "P9", 1, 7, 7), ("L2", "C9", "2023-02-11", "S", "P9", 1, 7, 7)])
    path, month = str(tmp_path / "daily"), clustered.month_of(F.col("TransactionDate"))
    clustered.build_by_month(early, reports.daily_summary, month, path)
    before = files(path)
    table = clustered.refresh_months(late, reports.daily_summary, month, path, [day("2023-02-10"), day("2023-02-11")])
    after = files(path)
    same = {f for f in before if after.get(f) == before[f]}
    assert {f for f in before if "2023-02" not in f} == same and not any("2023-02" in f for f in same)
    plain = lambda df: sorted(tuple(str(r[c]) for c in sorted(df.columns)) for r in df.collect())
    assert plain(table) == plain(reports.daily_summary(late))
    # the whole month is taken back: it disappears
    less = early.filter(clustered.month_of(F.col("TransactionDate")) != "2023-03")
    table = clustered.refresh_months(less, reports.daily_summary, month, path, [day("2023-03-01"), day("2023-02-10")])
    assert plain(table) == plain(reports.daily_summary(less))


def test_refresh_reads_only_the_folders_of_its_months(spark, tx, tmp_path):
    rows = [(f"T{i}", "C1", f"2023-{1 + i % 6:02d}-05", "S", "P", 1, 10, 10) for i in range(30)]
    stored = tx(rows).withColumn(clustered.MONTH, clustered.month_of(F.col("TransactionDate")))
    stored.write.partitionBy(clustered.MONTH).parquet(str(tmp_path / "facts"))
    facts, month = spark.read.parquet(str(tmp_path / "facts")), clustered.month_of(F.col("TransactionDate"))
    path = str(tmp_path / "daily")
    clustered.build_by_month(facts, lambda df: reports.daily_summary(df.drop(clustered.MONTH)), month, path)
    seen = []

    def summary(part):
        seen.append(part.inputFiles() and {f.split("SalesMonth=")[1][:7] for r in [part.select(F.input_file_name()).distinct().collect()] for (f,) in r})
        return reports.daily_summary(part)

    clustered.refresh_months(facts, summary, month, path, [day("2023-04-05")])
    assert seen == [{"2023-04"}]


def test_clustered_facts_join_without_a_shuffle(spark, tx, loyalty, products):
    lines = tx([(f"T{i}", f"C{i % 7}", f"2023-01-{1 + i % 28:02d}", "S", f"P{i % 3}", 1, 10, 10) for i in range(80)])
    points = loyalty([(i, f"C{i % 7}", f"T{i}", "2023-01-01", 10, 0, 10, "Bronze", 1) for i in range(40)])
    surveys = spark.createDataFrame([(1, "C1", day("2023-01-01"), 5, 9, "", "Yes")],
                                    "SurveyID long, CustomerID string, SurveyDate date, SatisfactionScore int, NPSScore int, Feedback string, WouldRecommend string")
    names = clustered.cluster_facts(lines, points, surveys, "by_customer", rows_per_bucket=20)
    sales = spark.table(names["fact_transactions"])
    assert sorted(map(str, sales.collect())) == sorted(map(str, lines.select(*sales.columns).collect()))
    metrics = cf.line_metrics(sales, cf._life_metrics())
    assert exchanges(metrics) == 0 and exchanges(cf.line_metrics(lines, cf._life_metrics())) == 1
    ledger = loy.build_points_ledger(sales, ["TransactionDate", "TransactionID", "ProductID"], F.lit(0), record_ids=False, measure=100)
    assert exchanges(ledger) == 0
    both = metrics.hint("merge").join(spark.table(names["fact_loyalty_points"]).groupBy("CustomerID").count(), "CustomerID")
    assert exchanges(both) == 0 and both.count() == 7
    # a customer with more lines than a bucket: spread files, one exchange that combines first
    names = clustered.cluster_facts(lines.withColumn("CustomerID", F.lit("C0")), points, surveys, "one_customer", rows_per_bucket=20)
    assert exchanges(cf.line_metrics(spark.table(names["fact_transactions"]), cf._life_metrics())) == 1
    for database in ("by_customer", "one_customer"):
        spark.sql(f"DROP DATABASE {database} CASCADE")
    assert [clustered.bucket_count(n, 10) for n in (0, 1, 10, 11, 20, 21, 41)] == [1, 1, 1, 2, 2, 4, 8]


def test_primary_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", None), (None, None), ("c", 3), ("c", 3), ("c", 3)], "k string, n int")
    assert quality.key_violations(df, ["k", "n"]).first().asDict() == {"Rows": 8, "IncompleteKeys": 2, "RepeatedKeys": 2, "ExtraRows": 3}
    assert quality.key_violations(df.filter("false"), ["k"]).first().asDict() == {"Rows": 0, "IncompleteKeys": 0, "RepeatedKeys": 0, "ExtraRows": 0}
    assert {tuple(r) for r in quality.repeated_keys(df, ["k", "n"]).collect()} == {("a", 1, 2), ("c", 3, 3)}
    found = by(quality.validate_primary_keys({"dim_stores": df.withColumnRenamed("k", "StoreID"), "fact_surveys": spark.range(3).toDF("SurveyID")}), "TableName")
    assert (found["dim_stores"]["Passed"], found["fact_surveys"]["Passed"]) == (False, True)


@pytest.mark.parametrize("use_pca", [False, True])
def test_a_segmentation_labels_the_same_in_another_session(spark, tmp_path, use_pca):
    rows = [(f"C{i}", float(i % 3) * 50 + i % 5, float(i % 3) * 20 + i % 7, float(i % 3) * 900 + i) for i in range(90)]
    features = spark.createDataFrame(rows, "CustomerID string, Recency double, Frequency double, TotalSpend double")
    found = seg.perform_customer_segmentation(features, 3, feature_types=("rfm",), use_pca=use_pca, n_init=2)
    seg.save_segmentation_results(found, str(tmp_path))
    other = spark.newSession()
    again = seg.load_segmentation(other, str(tmp_path))
    labels = {r["CustomerID"]: (r["Segment"], r["SegmentName"]) for r in again.assign(other.createDataFrame(rows, features.schema)).collect()}
    names = {r["Segment"]: r["SegmentName"] for r in found.names.collect()}
    assert labels == {r["CustomerID"]: (r["Segment"], names[r["Segment"]]) for r in found.labels.collect()}
    assert (again.pca is not None) == use_pca


def test_a_churn_model_scores_the_same_read_back(spark, tmp_path):
    rows = [(f"C{i}", float(i % 10), float(i % 4), int(i % 10 > 6)) for i in range(60)]
    df = spark.createDataFrame(rows, "CustomerID string, a double, b double, Churn int")
    model = churn.train_churn_model(df, {"n_estimators": 2, "max_depth": 2})
    none = spark.range(0)
    churn.save_churn_model(churn.ChurnResults(model, none, none, none, None, churn.predict_churn_risk(model, df), none), str(tmp_path))
    again = churn.load_churn_model(str(tmp_path))
    assert sorted(churn.predict_churn_risk(again, df).collect()) == sorted(churn.predict_churn_risk(model, df).collect())
