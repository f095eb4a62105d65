from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillpoint.operators import churn, explanations as ex


@pytest.fixture(scope="module")
def people(spark):
    pick = random.Random(5)
    rows = []
    for i in range(120):
        a, b, c, d = (pick.random() for _ in range(4))
        rows.append((f"C{i}", a, b, c, round(d, 1), int(a + b * c + 0.2 * d + pick.random() * 0.2 > 0.9)))
    return spark.createDataFrame(rows, "CustomerID string, a double, b double, c double, d double, Churn int")


@pytest.fixture(scope="module")
def model(people):
    return churn.train_churn_model(people, {"n_estimators": 4, "max_depth": 4, "learning_rate": 0.3})


def expected(nodes, at, x, known):
    """A tree's value when only the features ``known`` are known: other splits are averaged by training weight."""
    node = nodes[at]
    if node["leftChild"] < 0:
        return node["prediction"]
    left, right, split = node["leftChild"], node["rightChild"], node["split"]
    if split["featureIndex"] in known:
        return expected(nodes, left if x[split["featureIndex"]] <= split["leftCategoriesOrThreshold"][0] else right, x, known)
    w = [nodes[n]["impurityStats"][0] for n in (left, right)]
    return sum(v * expected(nodes, n, x, known) for v, n in zip(w, (left, right))) / sum(w)


def test_values_equal_brute_force_over_all_subsets(spark, people, model, tmp_path):
    trees = model.stages[-1]
    trees.write().save(str(tmp_path / "t"))
    nodes = {}
    for r in spark.read.parquet(str(tmp_path / "t" / "data")).select("treeID", "nodeData.*").collect():
        nodes.setdefault(r["treeID"], {})[r["id"]] = r.asDict(recursive=True)
    names, n = ["a", "b", "c", "d"], 4
    got = {(r["CustomerID"], r["Feature"]): r for r in ex.explain_customers(model, people.drop("Churn")).collect()}
    assert len(got) == 480
    for row in people.limit(12).collect():
        x = [row[c] for c in names]

        def value(known):
            return sum(2 * trees.treeWeights[t] * expected(of, 0, x, known) for t, of in nodes.items())

        for j, name in enumerate(names):
            others, total = [i for i in range(n) if i != j], 0.0
            for k in range(n):
                for s in itertools.combinations(others, k):
                    total += math.factorial(k) * math.factorial(n - k - 1) / math.factorial(n) * (value({*s, j}) - value(set(s)))
            assert got[row["CustomerID"], name]["Contribution"] == pytest.approx(total, abs=1e-9)
            assert got[row["CustomerID"], name]["BaseValue"] == pytest.approx(value(set()))
            assert got[row["CustomerID"], name]["FeatureValue"] == x[j]


def test_contributions_add_up_to_the_log_odds_of_the_score(people, model):
    explained = ex.explain_customers(model, people)
    sums = explained.groupBy("CustomerID").agg((F.sum("Contribution") + F.first("BaseValue")).alias("Sum"), F.first("LogOdds").alias("LogOdds"))
    rows = sums.join(churn.churn_probability(model, people).select("CustomerID", "ChurnProbability"), "CustomerID").collect()
    assert len(rows) == 120
    for r in rows:
        assert r["Sum"] == pytest.approx(r["LogOdds"]) and 1 / (1 + math.exp(-r["Sum"])) == pytest.approx(r["ChurnProbability"])


def test_long_paths_work_out_patterns_as_they_occur(model, people, monkeypatch):
    rows = np.asarray([[r[c] for c in "abcd"] for r in people.collect()])
    of = ex.leaves(model.stages[-1])
    tabled = ex.Explainer(of).values(rows)
    monkeypatch.setattr(ex, "TABLE_FEATURES", 0)
    assert np.allclose(ex.Explainer(of).values(rows), tabled, atol=1e-12)


def test_an_unused_feature_gets_nothing_and_twins_share(spark):
    """Two equal columns: whatever the trees use, unused columns get zero; constant labels can't be trained at all."""
    rows = [(f"C{i}", i / 50, 7.0, int(i >= 25)) for i in range(50)]
    df = spark.createDataFrame(rows, "CustomerID string, a double, same double, Churn int")
    model = churn.train_churn_model(df, {"n_estimators": 2, "max_depth": 2})
    effects = {r["Feature"]: r for r in ex.feature_effects(ex.explain_customers(model, df)).collect()}
    assert effects["same"]["MeanAbsContribution"] == 0 and effects["a"]["MeanAbsContribution"] > 0
    assert list(effects) == ["a", "same"]


def test_gaps_samples_and_repeats(spark, people, model):
    odd = people.drop("Churn").withColumn("a", F.when(F.col("CustomerID") != "C0", F.col("a"))).unionByName(people.drop("Churn").filter("CustomerID = 'C1'"))
    rows = ex.explain_customers(model, odd).collect()
    assert len(rows) == 121 * 4
    median = float(np.median([r["a"] for r in odd.filter("a IS NOT NULL").collect()]))
    assert next(r for r in rows if r["CustomerID"] == "C0" and r["Feature"] == "a")["FeatureValue"] == pytest.approx(median)
    some = ex.explain_customers(model, people, max_samples=10)
    assert some.count() == 40 and sorted(map(str, some.collect())) == sorted(map(str, ex.explain_customers(model, people, max_samples=10).collect()))
    assert ex.explain_customers(model, people.filter("false")).collect() == []


def test_strongest_features(people, model):
    explained = ex.explain_customers(model, people)
    every = {}
    for r in explained.collect():
        every.setdefault(r["CustomerID"], []).append(r)
    for r in ex.strongest_features(explained, 2).collect():
        ranked = sorted(every[r["CustomerID"]], key=lambda x: (-abs(x["Contribution"]), x["Feature"]))
        assert ranked[r["Rank"] - 1]["Feature"] == r["Feature"] and r["Rank"] <= 2
