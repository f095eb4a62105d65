from __future__ import annotations

import math

import numpy as np
import pytest

from tillpoint.llm import topk
from tillpoint.llm.queries import QUERIES

from .conftest import SF01

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, queries, k=5, scale=256):
    def usable(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    whole = [(i, tuple(math.floor(float(np.float32(x)) * scale) for x in v)) for i, v in rows if i is not None and usable(v)]
    asked = {(i, tuple(math.floor(float(np.float32(x)) * scale) for x in v)) for i, v in queries if i is not None and usable(v)}
    out = []
    for q, a in asked:
        scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q and len(b) == len(a))
        out += [(q, r + 1, i, -s if -2 ** 63 <= -s < 2 ** 63 else None) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()), key=str)


def test_table_matches_brute_force(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF01}/embeddings.parquet").collect()]
    assert found(QUERIES["op1_topk"](spark, SF01)) == brute(rows, [r for r in rows if r[0] % 50 == 0])


@pytest.mark.parametrize("shape", ["spread", "clustered", "ties"])
def test_pruned_search_matches_brute_force(spark, monkeypatch, shape):
    """Small buckets and lengths that differ, so buckets are skipped and both ways of pruning are taken."""
    monkeypatch.setattr(topk, "BUCKET", 16)
    monkeypatch.setattr(topk, "BLOCK", 8)
    draw = np.random.default_rng(5)
    v = draw.normal(size=(400, 6))
    if shape == "spread":
        v *= np.exp(draw.normal(size=(400, 1)) * 2)
    elif shape == "clustered":
        v = v[draw.integers(0, 5, 400)] + draw.normal(size=(400, 6)) * 0.01
    else:
        v = draw.integers(-1, 2, size=(400, 6)) / 256
    rows = [(int(i), [float(x) for x in row]) for i, row in enumerate(v)]
    table = spark.createDataFrame([(*r, 0) for r in rows], VECTORS)
    assert found(topk.top_products(table, table.filter("vec_id % 7 = 0"))) == brute(rows, [r for r in rows if r[0] % 7 == 0])


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, [0.5, -1.0]), (50, [0.5, -1.0]), (1, None), (2, []), (3, [nan, 1.0]), (4, [inf, 0.0]), (5, [None, 1.0]),
            (6, [0.0, 0.0]), (7, [1.0, 2.0, 3.0]), (100, [1.0, 1.0, 1.0]), (None, [9.0, 9.0]), (8, [1e30, 0.0]), (9, [-3.0, -3.0]), (150, [0.0, 0.0]), (200, []), (10, [1e6, 0.0])]
    table = spark.createDataFrame([(*r, 0) for r in rows], VECTORS).selectExpr("*", "1 AS id", "'x' AS v", "0 AS rank")
    asked = [r for r in rows if r[0] is not None and r[0] % 50 == 0]
    assert found(topk.top_products(table, table.filter("vec_id % 50 = 0"))) == brute(rows, asked)
    none = table.filter("false")
    assert found(topk.top_products(none, none)) == []
    assert found(topk.top_products(table, none)) == []


def test_products_beyond_floating_point_are_whole():
    a = np.asarray([[2 ** 25, 2 ** 25 - 1, 3]], dtype="<i4")
    b = np.asarray([[2 ** 25, 2 ** 25 - 1, 1]] * 2, dtype="<i4")
    exact = 2 ** 50 + (2 ** 25 - 1) ** 2 + 3
    assert topk.products(a, b).tolist() == [[exact, exact]]
    wide = np.full((1, 200), 2 ** 25 - 1, dtype="<i4")
    assert topk.products(wide, wide).tolist() == [[200 * (2 ** 25 - 1) ** 2]]


@pytest.mark.parametrize("large", [1e6, 1e15, 1e30, 3e38])
def test_vectors_of_any_size_take_part(spark, monkeypatch, large):
    """Also the hit that a cut of large components would hide: (1e6, 0) for the queries (1, 1) and (1, 2)."""
    monkeypatch.setattr(topk, "BUCKET", 16)
    monkeypatch.setattr(topk, "BLOCK", 8)
    draw = np.random.default_rng(7)
    v = draw.normal(size=(120, 4)) * np.where(np.arange(120) % 6 == 0, large / 4, 1.0)[:, None]
    rows = [(int(i), [float(np.float32(x)) for x in row]) for i, row in enumerate(v)]
    rows += [(150, [1.0, 1.0]), (200, [1.0, 2.0]), (201, [1e6, 0.0]), (202, [float(np.float32(large)), 0.0]), (203, [-float(np.float32(large)), 1.0])]
    table = spark.createDataFrame([(*r, 0) for r in rows], VECTORS)
    assert found(topk.top_products(table, table.filter("vec_id % 5 = 0"))) == brute(rows, [r for r in rows if r[0] % 5 == 0])
