"""Scans give the same result whether groups stay whole or are cut into chunks."""

import random

import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tillpoint.functions.ordered import Ordered, ntile, quintile
from tillpoint.functions.quantiles import quantiles

CHUNKED = 7  # group limit that forces several chunks


@pytest.fixture(scope="module")
def rows(spark):
    pick = random.Random(3)
    data = [("hot", i, pick.randint(-50, 50)) for i in range(60)] + [(f"k{i % 9}", i, pick.randint(-50, 50)) for i in range(45)]
    data += [("gap", i, None if i % 3 else i) for i in range(12)]
    return spark.createDataFrame(data, "k string, at int, v int")


def frame(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_running_sum_and_min(rows):
    def scan(limit):
        o = Ordered.of(rows, ["k"], ["at"], limit=limit)
        assert (o.cut is not None) == (limit == CHUNKED)
        return frame(o.running_sum(s=F.col("v")).running_min(m=F.col("s")).result())

    assert scan(None) == scan(CHUNKED)


def test_previous(rows):
    def scan(limit):
        return frame(Ordered.of(rows, ["k"], ["at"], limit=limit).previous(p=F.col("v"), q=F.col("at")).result())

    assert scan(None) == scan(CHUNKED)


def test_position_over_whole_table(rows):
    def scan(limit):
        return frame(Ordered.of(rows, [], ["v", "k", "at"], limit=limit).position("n").result())

    whole = scan(None)
    assert whole == scan(CHUNKED)
    assert sorted(r[-1] for r in whole) == list(range(1, 118))


@pytest.mark.parametrize("n", [1, 2, 4, 5, 7, 10, 11, 23, 100])
def test_quintile_and_ntile_closed_forms(spark, n):
    got = spark.range(1, n + 1).select("id", quintile(F.col("id"), n).alias("q"), ntile(F.col("id"), n).alias("t")).orderBy("id").collect()
    if n > 1:
        expected = pd.qcut(pd.Series(range(1, n + 1)), 5, labels=False, duplicates="drop") + 1
        assert [r["q"] for r in got] == list(expected)
    else:
        assert [r["q"] for r in got] == [1]
    sizes = [n // 5 + (i < n % 5) for i in range(5)]
    assert [r["t"] for r in got] == [i + 1 for i, size in enumerate(sizes) for _ in range(size)]


def test_quantiles_both_ways(spark):
    pick = random.Random(5)
    data = [(f"g{i % 3}", float(pick.randint(0, 9)), None if i % 7 == 0 else pick.random()) for i in range(101)]
    data += [("g0", float("inf"), float("nan"))]
    df = spark.createDataFrame(data, "g string, a double, b double")
    pdf = pd.DataFrame(data, columns=["g", "a", "b"]).replace(float("inf"), float("nan"))
    for p in (0.5, 0.75):
        expected = pdf.groupby("g")[["a", "b"]].quantile(p)
        for limit in (None, 10):
            for r in quantiles(df, ["g"], ["a", "b"], p, limit).collect():
                assert r["a"] == pytest.approx(expected.loc[r["g"], "a"])
                assert r["b"] == pytest.approx(expected.loc[r["g"], "b"])
    assert quantiles(df, [], ["a"], 0.5, 10).first()["a"] == pytest.approx(pdf["a"].median())


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 200), st.integers(0, 200)), min_size=1, max_size=30))
def test_floored_balance_identity(spark, moves):
    """Balance by running minimum equals the step-by-step rule."""
    df = spark.createDataFrame([(i, e - r) for i, (e, r) in enumerate(moves)], "i int, d int")
    scan = Ordered.of(df, [], ["i"], limit=4).running_sum(s=F.col("d")).running_min(m=F.col("s")).result()
    got = [r["b"] for r in scan.select("i", (F.col("s") - F.least(F.lit(0), "m")).alias("b")).orderBy("i").collect()]
    balance, expected = 0, []
    for earned, redeemed in moves:
        balance = max(0, balance + earned - redeemed)
        expected.append(balance)
    assert got == expected


def test_only_hot_keys_are_cut(spark, rows):
    sizes = {r["k"]: r["count"] for r in rows.groupBy("k").count().collect()}
    limit = max(sizes.values()) - 1
    scan = Ordered.of(rows, ["k"], ["at"], limit=limit)
    cut, plain = ({r["k"] for r in part.select("k").distinct().collect()} for part in (scan.cut, scan.plain))
    assert cut == {k for k, n in sizes.items() if n > limit} and plain == sizes.keys() - cut


def test_quantiles_keep_every_group(spark):
    """A group without any value, a group without a name, and values that are not finite."""
    data = [(1, 1.0, None), (1, 3.0, None), (2, None, 5.0), (2, float("nan"), float("inf")), (None, 7.0, 1.0), (3, None, None)]
    df = spark.createDataFrame(data, "g int, a double, b double")
    for limit in (None, 1):
        got = {r["g"]: (r["a"], r["b"]) for r in quantiles(df, ["g"], ["a", "b"], 0.5, limit).collect()}
        assert got == {1: (2.0, None), 2: (None, 5.0), None: (7.0, 1.0), 3: (None, None)}
    assert quantiles(df.filter("false"), [], ["a"]).first()["a"] is None


@pytest.mark.parametrize("shape", ["spread", "hot", "steps", "tiny"])
def test_bracketed_quantiles_equal_the_sorted_values(spark, monkeypatch, shape):
    """Groups of many sizes, hot values at and beside the wanted rank; a crude sketch, and one that misses, too."""
    pick = random.Random(8)
    draw = {"spread": lambda i: pick.gauss(0, 1), "hot": lambda i: 5.0 if i % 3 else pick.random() * 10, "steps": lambda i: float(i % 4),
            "tiny": lambda i: float(i)}[shape]
    n = 12 if shape == "tiny" else 4000
    data = [(None if i % 11 == 0 else i % 3, draw(i), None if i % 5 else draw(i)) for i in range(n)] + [(9, None, float("nan"))]
    df = spark.createDataFrame(data, "g int, a double, b double").repartition(4)
    have = {}
    for g, a, b in data:
        for c, v in (("a", a), ("b", b)):
            have.setdefault((g, c), []).extend([] if v is None or v != v else [v])

    def by_hand(values, p):
        if not values:
            return None
        values, at = sorted(values), (len(values) - 1) * p
        low, high = values[int(at)], values[-int(-at // 1)]
        return low + (high - low) * (at - int(at))

    def check(*probabilities):
        for p in probabilities:
            rows = quantiles(df, ["g"], ["a", "b"], p).collect()
            assert sorted(str(r["g"]) for r in rows) == sorted({str(g) for g, _ in have})
            for r in rows:
                for c in "ab":
                    assert r[c] == (None if not have[r["g"], c] else pytest.approx(by_hand(have[r["g"], c], p), abs=1e-12))
            whole = quantiles(df, [], ["b", "a"], p).first()
            for c in "ab":
                assert whole[c] == pytest.approx(by_hand([v for (g, k), vs in have.items() if k == c for v in vs], p), abs=1e-12)

    check(0.0, 0.5, 0.99)
    if shape in ("spread", "hot"):
        from tillpoint.functions import quantiles as module

        wrong = lambda narrow, groups, columns, p: narrow.groupBy(*groups).agg(
            *[F.array(F.max(c), F.max(c)).alias(f"_e{i}") for i, c in enumerate(columns)])
        monkeypatch.setattr(module, "brackets", wrong)
        check(0.5)
