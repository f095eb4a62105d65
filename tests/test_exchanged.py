"""The exchange of one feature's values between customers, in rounds."""

import random

import pytest
from pyspark.sql import functions as F

from tillpoint.operators import churn


@pytest.fixture(scope="module")
def people(spark):
    pick = random.Random(8)
    rows = []
    for i in range(160):
        a, b, c = (pick.random() for _ in range(3))
        rows.append((f"C{i}", a, b, round(c, 1), float(i % 2), int(a + 0.5 * b + pick.random() * 0.4 > 1.0)))
    return spark.createDataFrame(rows, "CustomerID string, a double, b double, c double, d double, Churn int")


def area(scores, labels):
    wins = [1.0 if p > n else 0.5 if p == n else 0.0 for p, x in zip(scores, labels) if x for n, y in zip(scores, labels) if not y]
    return sum(wins) / len(wins)


@pytest.mark.parametrize(("depth", "chunk", "limit"), [(4, 10 ** 6, None), (8, 13, None), (4, 13, 50)])
def test_drops_equal_brute_force_in_rounds_of_any_size(spark, people, monkeypatch, depth, chunk, limit):
    """Every feature's exchange scored by the model itself, one feature after the other."""
    monkeypatch.setattr(churn, "HASH_CHUNK", chunk)
    if limit:
        monkeypatch.setattr("tillpoint.functions.ordered.GROUP_LIMIT", limit)
    model = churn.train_churn_model(people, {"n_estimators": 6, "max_depth": depth, "learning_rate": 0.3})
    rows = sorted(people.collect(), key=lambda r: r["CustomerID"])
    hashed = F.xxhash64(F.col("CustomerID"), F.lit(churn.SEED + 1), F.lit("x"))
    want, plain = {}, churn.churn_probability(model, people).select("CustomerID", "ChurnProbability").collect()
    base = area(*zip(*[(dict(plain)[r["CustomerID"]], r["Churn"]) for r in rows]))
    for c in "abcd":
        order = [r[0] for r in people.select("CustomerID", F.xxhash64(hashed, F.lit(c)).alias("h")).orderBy("h", "CustomerID").collect()]
        given = {r["CustomerID"]: r[c] for r in rows}
        mixed = [{**r.asDict(), c: given[o]} for r, o in zip(rows, order)]
        got = churn.churn_probability(model, spark.createDataFrame(mixed, people.schema)).select("ChurnProbability", "Churn").collect()
        want[c] = base - area(*zip(*got))
    for per_round in (None, 160, 330):
        got = {r["Feature"]: r["AucDrop"] for r in churn.explain_by_permutation(model, people, rows_per_round=per_round).collect()}
        assert got == pytest.approx(want, abs=1e-4) and max(got.values()) > 0.05
