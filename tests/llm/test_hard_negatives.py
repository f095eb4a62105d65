from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillpoint.llm import common, hard_negatives as hn

VECTORS = "vec_id long, embedding array<double>, label long"


def brute(rows, every, k=5, m=5, low=80, high=100, whole=100, scale=256):
    usable = [(i, [math.floor(x * scale) for x in v], lab) for i, v, lab in rows
              if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, a, lab in {(i, tuple(v), lab) for i, v, lab in usable if i % every == 0}:
        scored = [(-sum(x * y for x, y in zip(a, b)), j, other == lab) for j, b, other in usable if j != i and len(b) == len(a)]
        for p, j, _ in sorted(s for s in scored if s[2])[:k]:
            near = sorted(s for s in scored if not s[2] and low * -p <= whole * -s[0] <= high * -p)[:m]
            out += [(i, j, r + 1, n, fits(-p), fits(-s)) for r, (s, n, _) in enumerate(near)]
    return sorted(out, key=str)


def fits(x):
    return x if -2 ** 63 <= x < 2 ** 63 else None


def found(table, every, **options):
    df = hn.hard_negatives(table, F.col("vec_id") % every == 0, F.col("label"), **options)
    return sorted((tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()), key=str)


@pytest.mark.parametrize("shape", ["spread", "clustered", "ties", "copies"])
def test_search_matches_brute_force(spark, monkeypatch, shape):
    """A small sample, small shards and several lanes, so cells are left out and windows certified early."""
    monkeypatch.setattr(hn, "SAMPLE_NUMBERS", 240)
    monkeypatch.setattr(hn, "SHARD", 16)
    monkeypatch.setattr(hn, "LANE", 20)
    draw = np.random.default_rng(9)
    v = draw.normal(size=(400, 6))
    if shape == "clustered":
        v = v[draw.integers(0, 6, 400)] + draw.normal(size=(400, 6)) * 0.05
    elif shape == "ties":
        v = draw.integers(-1, 3, size=(400, 6)) / 256
    elif shape == "copies":
        v[::3] = v[0]
    rows = [(int(i), x.tolist(), int(draw.integers(0, 3))) for i, x in enumerate(v)]
    table = spark.createDataFrame(rows, VECTORS).repartition(3)
    want = brute(rows, 7)
    assert want and found(table, 7) == want
    assert found(table, 7, positives=2, negatives=3, lowest=50, highest=150) == brute(rows, 7, 2, 3, 50, 150)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0, 0.5], 1), (100, [0.5, 1.0, 1.0], 1), (100, [0.5, 1.0, 1.0], 1), (100, [2.0, 1.0, 1.0], 2), (1, None, 1), (2, [], 1), (200, [], 1), (4, [], 2),
            (3, [nan, 1.0, 1.0], 1), (5, [inf, 0.0, 0.0], 1), (6, [None, 1.0, 1.0], 1), (7, [1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0], 1), (8, [0.9, 1.9, 0.5], 2),
            (9, [1.0], 1), (300, [1.0], 2), (10, [0.99], 2), (11, [0.98], 1), (12, [1.0, 2.0, 0.5], 1), (12, [1.0, 2.0, 0.4], 1), (13, [1.0, 1.5, 0.6], 2), (400, [-1.0, 0.0, 0.0], 3)]
    table = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 AS id", "'x' AS v", "2 AS anchor", "3 AS cell")
    assert found(table, 100) == brute(rows, 100)
    assert found(table.filter("false"), 100) == []
    assert found(table.filter("vec_id % 100 <> 0"), 100) == []


@pytest.mark.parametrize("large", [1e6, 1e30, 1e200])
def test_scores_of_any_size_are_exact(spark, large):
    draw = np.random.default_rng(2)
    rows = [(int(i), (x * (large if i % 4 == 0 else 1.0)).tolist(), int(i % 3)) for i, x in enumerate(draw.normal(size=(80, 4)))]
    assert found(spark.createDataFrame(rows, VECTORS), 10, lowest=20) == brute(rows, 10, low=20)


def test_heap_visits_all_cells_by_bound_and_no_vector_is_above_it():
    draw = np.random.default_rng(4)
    m = draw.integers(-50, 50, size=(500, 6)).astype(np.float64)
    books = hn.Books({6: m[:60]}, 5)
    cells, first, second = books.cells(m)
    table = hn.Cells(books.of(6), cells, first, second)
    for a in m[:20]:
        seen = list(table.visit(a))
        assert [b for b, _ in seen] == sorted((b for b, _ in seen), reverse=True)
        assert sorted(at for _, at in seen) == list(range(len(table.place)))
        bound = {at: b for b, at in seen}
        assert all(m[i] @ a <= bound[table.place[int(cells[i])]] for i in range(len(m)))


def test_certified_windows_leave_cells_out(monkeypatch):
    """On clustered vectors the search stops early: most products are never formed."""
    draw = np.random.default_rng(6)
    centres = draw.normal(size=(20, 8)) * 200
    m = np.rint(centres[draw.integers(0, 20, 2000)] + draw.normal(size=(2000, 8)) * 5).astype(np.int64)
    books = hn.Books({8: m[:300].astype(np.float64)}, 12)
    rows = hn.Rows(books, np.arange(2000), np.zeros(2000, dtype=np.int64), m)
    formed = []
    monkeypatch.setattr(hn, "products", lambda a, b, f=hn.products: formed.append(len(b)) or f(a, b))
    wanted = [hn.Wanted(5, None, None)]
    rows.search(wanted, m[0], 0, 0, True)
    assert sum(formed) < 600
    assert [s for s, _ in wanted[0].held] == sorted((m[1:] @ m[0]).tolist(), reverse=True)[:5]


def test_sortable_numbers(spark):
    numbers = [0, 1, -1, 9, 10, -10, 2 ** 63 - 1, -2 ** 63, 2 ** 63, 10 ** 60, -10 ** 60, 99, -99, 12345]
    assert sorted(map(common.sortable, numbers)) == [common.sortable(x) for x in sorted(numbers)]
    assert [common.number(common.sortable(x)) for x in numbers] == numbers
    rows = spark.createDataFrame([(common.sortable(x),) for x in numbers], "s string")
    assert [r[0] for r in rows.select(common.number_column(F.col("s"))).collect()] == [fits(x) for x in numbers]
