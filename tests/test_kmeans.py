from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tillpoint.operators import kmeans, segmentation as seg


@pytest.fixture(scope="module")
def points():
    draw = np.random.default_rng(11)
    centres = draw.normal(size=(5, 4)) * 6
    return np.concatenate([centres[draw.integers(0, 5, 300)] + draw.normal(size=(300, 4)), np.full((60, 4), 2.5)])


@pytest.fixture(scope="module")
def vectors(spark, points):
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "id long, features array<double>").select("id", F.xxhash64("id").alias("h"), "features").repartition(5, "id").cache()


def plain_lloyd(points, centres, max_iter=300):
    for _ in range(max_iter):
        own = ((points[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2).argmin(axis=1)
        new = np.asarray([points[own == c].mean(axis=0) if (own == c).any() else centres[c] for c in range(len(centres))])
        if ((new - centres) ** 2).sum(axis=1).max() <= 1e-8:
            return new
        centres = new
    return centres


def cost(points, centres):
    return ((points[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2).min(axis=1).sum()


def test_all_models_of_one_run_equal_each_on_its_own(points, vectors):
    sizes, seeds = [2, 3, 5, 5, 7], [1, 2, 3, 4, 3]
    starts = kmeans.first_centres(vectors, sizes, seeds)
    assert [len(s) for s in starts] == sizes
    assert all(any(np.array_equal(c, p) for p in points) for s in starts for c in s)  # rows of the table
    for model, start in zip(kmeans.fit_all(vectors, sizes, seeds), starts):
        want = plain_lloyd(points, start)
        assert np.allclose(model.centres, want) and model.cost == pytest.approx(cost(points, want)) and 0 < model.steps < 300


def test_starts_are_drawn_by_squared_distance(spark):
    """Two far groups of unequal size: the second centre always comes from the other group; the same seed draws the same rows."""
    rows = [(i, [float(i % 2 if i < 90 else 1000 + i % 2)]) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, features array<double>").select(F.xxhash64("id").alias("h"), "features")
    starts = kmeans.first_centres(df, [2] * 20, list(range(20)))
    assert all(len({c[0] >= 1000 for c in s}) == 2 for s in starts)
    assert 0 < sum(s[0][0] >= 1000 for s in starts) < 10
    again = kmeans.first_centres(df.repartition(7), [2] * 20, list(range(20)))
    assert [s.tolist() for s in starts] == [s.tolist() for s in again]


def test_no_worse_than_one_fit_after_the_other(spark, vectors):
    best = kmeans.cheapest(kmeans.fit_all(vectors, [5] * 5, list(range(5))))
    frame = vectors.select(array_to_vector("features").alias("features"))
    loop = min(KMeans(k=5, seed=i, maxIter=300).fit(frame).summary.trainingCost for i in range(5))
    assert best.cost <= loop * (1 + 1e-9)


def test_silhouettes_equal_the_evaluators(vectors):
    models = kmeans.fit_all(vectors, [2, 3, 5, 8], [1, 1, 1, 1])
    judge = ClusteringEvaluator(predictionCol="Segment", featuresCol="v")
    for model, s in zip(models, kmeans.silhouettes(vectors, models)):
        labelled = model.transform(vectors).select("Segment", array_to_vector("features").alias("v"))
        assert s == pytest.approx(judge.evaluate(labelled), abs=1e-9)


def test_copies_gaps_and_more_centres_than_rows(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(10)], "id long, features array<double>").select(F.xxhash64("id").alias("h"), "features")
    model, = kmeans.fit_all(same, [3], [1])
    assert model.centres.tolist() == [[1.0, 2.0]] and model.cost == 0 and kmeans.silhouettes(same, [model]) == [-1.0]
    none = same.filter("false")
    assert [len(m.centres) for m in kmeans.fit_all(none, [2, 3], [1, 1])] == [0, 0]


def test_a_model_is_read_back_as_written(spark, vectors, tmp_path):
    model, = kmeans.fit_all(vectors, [4], [9])
    model.as_table(spark).write.parquet(str(tmp_path / "m"))
    again = kmeans.CentreModel.from_table(spark.read.parquet(str(tmp_path / "m")))
    assert np.array_equal(again.centres, model.centres) and (again.cost, again.steps) == (model.cost, model.steps)
    assert sorted(map(str, again.transform(vectors).collect())) == sorted(map(str, model.transform(vectors).collect()))


def test_best_k_is_that_of_the_blobs(spark):
    draw = np.random.default_rng(2)
    rows = [(f"C{i}", *(float(x) for x in np.asarray([(0, 0), (9, 0), (0, 9), (9, 9)][i % 4]) + draw.normal(size=2))) for i in range(200)]
    prepared = spark.createDataFrame(rows, "CustomerID string, a double, b double")
    scores = {r["K"]: r for r in seg.find_optimal_k_clusters(prepared, n_init=3).collect()}
    assert sorted(scores) == list(range(3, 9)) and [k for k, r in scores.items() if r["IsBest"]] == [4]
    costs = [scores[k]["WCSS"] for k in range(3, 9)]
    assert costs == sorted(costs, reverse=True)
