import itertools
import math
import random

import pytest
from conftest import by, day
from pyspark.sql import functions as F

from tillpoint.operators import churn, ml_prep, oversampling, segmentation as seg


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame([("a", 1.0, 2.0, 3.0, 1.0, "x"), ("b", 2.0, 4.0, 6.0, 1.0, "y"), ("c", 3.0, 6.0, 9.0, 1.0, "z")],
                                 "CustomerID string, Feature1 double, Feature2 double, Feature3 double, Flat double, Text string")


def test_correlated_features(small):
    assert ml_prep.identify_highly_correlated_features(small) == ["Feature2", "Feature3"]
    assert "Feature2" not in ml_prep.remove_highly_correlated_features(small).columns
    gappy = small.withColumn("Feature2", F.when(F.col("CustomerID") != "b", F.col("Feature2")))
    assert ml_prep.identify_highly_correlated_features(gappy) == ["Feature2", "Feature3"]


def test_scaling_uses_population_deviation_and_is_reusable(small):
    scaled, scaler = ml_prep.scale_features(small)
    got = by(scaled, "CustomerID")
    assert [got[c]["Feature1"] for c in "abc"] == pytest.approx([-1.224745, 0, 1.224745], abs=1e-6)
    assert [got[c]["Flat"] for c in "abc"] == [0, 0, 0] and got["a"]["Text"] == "x"
    again, _ = ml_prep.scale_features(small.filter("CustomerID = 'c'"), scaler=scaler)
    assert again.first()["Feature1"] == pytest.approx(1.224745, abs=1e-6)


def test_missing_and_infinite_become_the_median(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", float("inf")), ("d", 3.0)], "CustomerID string, f double")
    assert [r["f"] for r in ml_prep.impute_median(df, ["f"]).orderBy("CustomerID").collect()] == [1, 2, 2, 3]


def test_prepare_and_summary(small):
    ready = ml_prep.prepare_features_for_ml(small, target_column="Flat")
    assert ready["feature_names"] == ["Feature1", "Text"] and ready["target"].columns == ["CustomerID", "Flat"]
    summary = by(ml_prep.get_feature_summary(small), "Feature")
    assert (summary["Feature2"]["Mean"], summary["Feature2"]["Std"], summary["Feature2"]["Max"], summary["Feature2"]["Missing"]) == (4, 2, 6, 0)


@pytest.fixture(scope="module")
def blobs(spark):
    pick = random.Random(1)
    rows = [(f"C{i:03d}", (i % 3) * 100 + pick.random(), 50.0 - (i % 3) * 10 + pick.random(), (i % 3) * 1000.0, 1 if i % 3 else 0) for i in range(90)]
    return spark.createDataFrame(rows, "CustomerID string, Recency double, Frequency double, TotalSpend double, Churn int")


def test_segmentation(blobs, tmp_path):
    found = seg.perform_customer_segmentation(blobs, feature_types=("rfm",), k_range=range(2, 5), n_init=2)
    assert found.n_clusters == 3
    assert sorted(r["count"] for r in found.labels.groupBy("Segment").count().collect()) == [30, 30, 30]
    again = seg.perform_customer_segmentation(blobs, 3, feature_types=("rfm",), n_init=2)
    assert again.labels.orderBy("CustomerID").collect() == found.labels.orderBy("CustomerID").collect()
    seg.save_segmentation_results(found, str(tmp_path))
    assert blobs.sparkSession.read.parquet(f"{tmp_path}/segment_names.parquet").count() == 3
    with pytest.raises(ValueError):
        seg.select_features_for_clustering(blobs, ("loyalty",))


def test_pca_keeps_enough_variance(blobs):
    reduced, _, model = seg.prepare_features_for_clustering(blobs.drop("Churn"), use_pca=True)
    kept = len(reduced.columns) - 1
    shares = list(model.explainedVariance.toArray())
    assert sum(shares[:kept]) > 0.95 and sum(shares[:kept - 1]) <= 0.95


def test_segments_with_gaps_do_not_fail(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", float("inf"), 2.0), ("c", 3.0, 9.0)], "CustomerID string, Recency double, Frequency double")
    prepared, _, _ = seg.prepare_features_for_clustering(df)
    _, labels = seg.perform_kmeans_clustering(prepared, 2, n_init=1)
    assert labels.count() == 3


def test_profiles_by_customer(spark):
    features = spark.createDataFrame([("a", 10.0, 25.0), ("b", 20.0, 15.0), ("c", 400.0, 1.0)], "CustomerID string, Recency double, Frequency double")
    labels = spark.createDataFrame([("c", 1), ("b", 0), ("a", 0)], "CustomerID string, Segment int")
    got = by(seg.profile_segments(features, labels), "Segment")
    assert (got[0]["Recency_mean"], got[0]["Recency_median"], got[0]["Recency_std"], got[0]["Recency_count"]) == (15, 15, 7.07, 2)
    assert (got[0]["SegmentSize"], got[0]["SegmentPercentage"], got[1]["AvgRecency"]) == (2, 66.67, 400)
    assert got[1]["Recency_std"] is None
    names = {r["Segment"]: r["SegmentName"] for r in seg.assign_segment_names(features, labels).collect()}
    assert names == {0: "Potential Loyalists", 1: "Lost"}


RULES = [((30, 20, 5000, 1, 0, 0), "Champions"), ((60, 10, 2000, 1, 0, 0), "Loyal Customers"), ((90, 5, 0, 1, 0, 0), "Potential Loyalists"),
         ((30, 4, 0, 1, 0, 0), "New Customers"), ((91, 10, 0, 1, 0, 0), "At Risk"), ((181, 1, 0, 1, 0, 0), "Lost"),
         ((100, 1, 0, 3, 25000, 0), "High-Value Loyal"), ((100, 1, 0, 1, 0, 10000), "High-Value"), ((100, 6, 2000, 1, 0, 0), "Dormant Customers"),
         ((100, 2, 2000, 1, 0, 0), "Moderate Customers"), ((100, 6, 1000, 1, 0, 0), "Regular Customers"), ((150, 6, 10, 1, 0, 0), "Occasional Customers"),
         ((100, 1, 0, 1, 0, 0), "Low Engagement")]


def test_segment_names(spark):
    df = spark.createDataFrame([tuple(float(x) for x in v) + (n,) for v, n in RULES], "r double, f double, s double, t double, p double, l double, n string")
    for row in df.withColumn("got", seg.segment_name(*[F.col(c) for c in "rfstpl"])).collect():
        assert row["got"] == row["n"]


def test_churn_label_and_temporal_split(tx):
    rows = [(f"T{i}", "C1" if i < 100 else "C2" if i < 150 else "C3", day("2023-01-01").fromordinal(day("2023-01-01").toordinal() + i).isoformat(),
             "S", "P", 1, 1, 1) for i in range(200)]
    facts = tx(rows)
    labels = by(churn.create_churn_target(facts, "2024-12-31"), "CustomerID")
    assert {k: r["Churn"] for k, r in labels.items()} == {"C1": 1, "C2": 1, "C3": 1}
    assert labels["C3"]["LastPurchaseDate"] == day("2023-07-19")
    assert by(churn.create_churn_target(facts, "2023-07-09"), "CustomerID")["C1"]["Churn"] == 0  # exactly 90 days
    assert churn.split_date(facts) == day("2023-06-09")
    train, test = churn.temporal_targets(facts)
    assert [r["CustomerID"] for r in train.collect()] == ["C3"] and [r["CustomerID"] for r in test.collect()] == ["C3"]


def test_point_in_time_features_end_at_the_cut(tx):
    rows = [(f"T{i}", f"C{i % 5}", f"2023-{i % 12 + 1:02d}-10", "S", "P", 1, 1, 1) for i in range(60)]
    seen = []

    def features(past, cut):
        seen.append((past.agg(F.max("TransactionDate")).first()[0], cut))
        return past.groupBy("CustomerID").agg(F.count("TransactionID").alias("Frequency"))

    train, test = churn.point_in_time_split(tx(rows), features, "2023-08-15", 60)
    assert all(newest <= cut for newest, cut in seen)
    assert train.count() == test.count() == 5


def test_risk_bins(spark):
    df = spark.createDataFrame([(str(p), p) for p in (0.0, 0.3, 0.6, 0.8, 1.0, 0.5)], "CustomerID string, ChurnProbability double")
    got = by(churn.risk_table(df), "CustomerID")
    assert {k: (r["RiskLevel"], r["ChurnPrediction"]) for k, r in got.items()} == {
        "0.0": (None, 0), "0.3": ("Low", 0), "0.6": ("Medium", 1), "0.8": ("High", 1), "1.0": ("Critical", 1), "0.5": ("Medium", 1)}


@pytest.mark.parametrize("limit", [None, 3])
def test_metrics_against_brute_force(spark, limit):
    pick = random.Random(4)
    rows = [(f"C{i}", pick.randint(0, 10) / 10, pick.randint(0, 1)) for i in range(60)]
    df = spark.createDataFrame(rows, "CustomerID string, ChurnProbability double, Churn int")
    wins = [1.0 if p > n else 0.5 if p == n else 0.0 for (_, p, a), (_, n, b) in itertools.product(rows, rows) if a == 1 and b == 0]
    got = churn.evaluate_scores(df, limit=limit).first()
    assert got["RocAuc"] == pytest.approx(sum(wins) / len(wins))
    tp = sum(p >= 0.5 and y for _, p, y in rows)
    assert got["TruePositives"] == tp and got["Recall"] == pytest.approx(tp / sum(y for *_, y in rows))
    report = by(churn.classification_report(df), "Label")
    assert report["weighted avg"]["Support"] == 60 and report["1"]["Recall"] == pytest.approx(got["Recall"])


def test_undefined_rates_are_zero(spark):
    df = spark.createDataFrame([("a", 0.1, 0), ("b", 0.2, 1)], "CustomerID string, ChurnProbability double, Churn int")
    got = churn.evaluate_scores(df).first()
    assert (got["Precision"], got["Recall"], got["F1"]) == (0, 0, 0)


def test_boosted_trees(blobs, spark, tmp_path):
    small = {"n_estimators": 3, "max_depth": 2, "learning_rate": 0.1}
    model = churn.train_churn_model(blobs, small)
    importance = churn.calculate_feature_importance(model, spark).collect()
    assert sum(r["Importance"] for r in importance) == pytest.approx(1)
    scored = churn.predict_churn_risk(model, blobs.drop("Churn"))
    assert all(0 <= r["ChurnProbability"] <= 1 for r in scored.collect())
    assert churn.predict_churn_risk(churn.train_churn_model(blobs, small), blobs.drop("Churn")).orderBy("CustomerID").collect() == scored.orderBy("CustomerID").collect()
    assert churn.evaluate_model(model, blobs).first()["RocAuc"] == pytest.approx(1)
    drops = churn.explain_by_permutation(model, blobs, 60).collect()
    assert len(drops) == 3 and drops[0]["AucDrop"] >= 0
    assert churn.validation_curve(model, blobs).count() == 3
    with pytest.raises(ValueError):
        churn.train_churn_model(blobs.filter("Churn = 1"), small)


def test_class_weights(blobs):
    weights = {r["Churn"]: r["ClassWeight"] for r in churn.with_class_weights(blobs).select("Churn", "ClassWeight").distinct().collect()}
    assert weights == {0: 1.0, 1: 0.5}


@pytest.mark.parametrize("block, lane", [(5, 7), (9, 100), (1000, 1000)])
def test_neighbours_against_brute_force(spark, block, lane):
    """Two clusters, and a third of all rows are copies of one point."""
    pick = random.Random(9)
    points = [[pick.random() + (i % 2) * 5 for _ in range(3)] for i in range(40)] + [[0.5, 0.5, 0.5]] * 20
    points = list(enumerate(points, 1))
    rows = spark.createDataFrame(points, "id long, x array<double>")
    got = {}
    for r in oversampling.nearest_neighbours(rows, len(points), 4, 1, block, lane).collect():
        assert r["id"] != r["nid"] and r["dist"] == pytest.approx(math.dist(dict(points)[r["id"]], dict(points)[r["nid"]]))
        got.setdefault(r["id"], {})[r["nid"]] = r["dist"]
    for i, x in points:
        assert sorted(got[i].values()) == pytest.approx(sorted(math.dist(x, y) for j, y in points if j != i)[:4])


@pytest.mark.parametrize("block", [1000, 4])
def test_oversampling_reaches_parity_inside_the_minority(spark, block):
    pick = random.Random(2)
    rows = [(f"C{i}", 10 + pick.random(), 20 + pick.random(), 1) for i in range(9)] + [(f"D{i}", pick.random(), pick.random(), 0) for i in range(40)]
    df = spark.createDataFrame(rows, "CustomerID string, a double, b double, Churn int")
    out = oversampling.oversample_minority(df, ["a", "b"], "Churn", "CustomerID", 42, block=block)
    assert {r["Churn"]: r["count"] for r in out.groupBy("Churn").count().collect()} == {0: 40, 1: 40}
    made = out.filter("CustomerID is null").collect()
    assert len(made) == 31 and all(10 <= r["a"] <= 11 and 20 <= r["b"] <= 21 for r in made)
    again = oversampling.oversample_minority(df, ["a", "b"], "Churn", "CustomerID", 42, block=block).filter("CustomerID is null")
    assert sorted((r["a"], r["b"]) for r in again.collect()) == sorted((r["a"], r["b"]) for r in made)


def test_whole_churn_job(spark, tx, tmp_path):
    """Split, oversampling, trees, explanation, held-out scores and the saved tables."""
    rows = []
    for i in range(24):
        for k in range(8 if i % 3 else 3):
            rows.append((f"T{i}.{k}", f"C{i}", f"2023-{1 + k:02d}-{1 + i:02d}", "S1", "P1", 1 + i % 4, 10, 10 * (1 + i % 4)))
        rows.append((f"T{i}.z", f"C{i}", "2023-11-20" if i % 2 else "2023-09-01", "S1", "P1", 1, 10, 10))
    rows.append(("T", "C0", "2023-12-31", "S1", "P1", 1, 10, 10))
    lines = tx(rows)
    features = lines.groupBy("CustomerID").agg(F.count("*").alias("Lines"), F.sum("Quantity").alias("Units"))
    small = {"n_estimators": 2, "max_depth": 2, "learning_rate": 0.1}
    done = churn.perform_churn_prediction(features, lines, train_end_date="2023-08-01", hyperparameters=small)
    scores = done.test_scores.collect()
    assert len({r["CustomerID"] for r in scores}) == len(scores) == 24 and all(0 <= r["ChurnProbability"] <= 1 for r in scores)
    assert {r["Feature"] for r in done.explanations.collect()} == {"Lines", "Units"}
    assert done.predictions.count() == 24
    assert len(churn.calculate_feature_importance(done.model, spark, top=1).collect()) == 1
    churn.save_churn_model(done, tmp_path)
    assert spark.read.parquet(f"{tmp_path}/churn_predictions.parquet").count() == 24
    assert spark.read.parquet(f"{tmp_path}/feature_importance.parquet").count() == 2
