from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from tillpoint.llm import value_codes as vc

VECTORS = "vec_id long, embedding array<double>, label int"


def brute(rows, parts, entries, rounds, scale=256):
    """({row: (code, error)}, label errors, digest of the codebooks), with Python's integers, part by part."""
    kept = [(i, [math.floor(x * scale) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2] is None, r[2] or 0))
    dim = next((len(v) for _, v, _ in kept if v and len(v) % parts == 0), 0)
    fit = [r for r in kept if len(r[1]) == dim and dim]
    w = dim // parts
    books = [[v[p * w:(p + 1) * w] for _, v, _ in fit[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            of = defaultdict(list)
            for _, v, _ in fit:
                x = v[p * w:(p + 1) * w]
                of[near(x, books[p])[1]].append(x)
            books[p] = [[sum(c) // len(of[n]) for c in zip(*of[n])] if n in of else e for n, e in enumerate(books[p])]
    out, total = [], defaultdict(int)
    for i, v, lab in kept:
        if len(v) != dim or not dim:
            out.append((i, lab, None, None))
            continue
        found = [near(v[p * w:(p + 1) * w], books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        total[lab] += error
        out.append((i, lab, "".join(f"{n:02x}" for _, n in found), error))
    fits = lambda x: x if x is not None and x < 2 ** 63 else None
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, lab, c, fits(e), None if c is None else fits(total[lab])) for i, lab, c, e in out), key=str), digest


def found(rows, **options):
    df, books = vc.vector_codes(rows, **options)
    return sorted((tuple(r) for r in df.select("vec_id", "label", "code", "error", "label_error").collect()), key=str), vc.digest(books)


@pytest.mark.parametrize("shape", ["spread", "ties", "copies"])
def test_codes_match_brute_force(spark, monkeypatch, shape):
    """Blocks of a few vectors, so a round's sums come from many dictionaries."""
    monkeypatch.setattr(vc, "BLOCK_NUMBERS", 64)
    draw = np.random.default_rng(3)
    v = {"spread": draw.normal(size=(300, 8)) * 3, "ties": draw.integers(-1, 2, size=(300, 8)) / 256,
         "copies": np.where(np.arange(300)[:, None] % 3 == 0, 0.5, draw.normal(size=(300, 8)))}[shape]
    rows = [(int(i), x.tolist(), None if i % 7 == 0 else int(i % 4)) for i, x in enumerate(v)]
    table = spark.createDataFrame(rows, VECTORS).repartition(5)
    for options in ({"parts": 4, "entries": 16, "rounds": 2}, {"parts": 2, "entries": 256, "rounds": 3}, {"parts": 8, "entries": 1, "rounds": 0}):
        assert found(table, **options) == brute(rows, **options)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(3, [1.0, 2.0], 1), (1, [0.5, -1.0], None), (1, [0.5, -2.0], None), (None, [4.0, 4.0], 2), (2, None, 1), (5, [], 1), (6, [nan, 1.0], 1),
            (7, [None, 1.0], 1), (8, [inf, 1.0], 3), (9, [1.0, 2.0, 3.0], 2), (10, [-0.001, 0.001], 2), (10, [-0.001, 0.001], 2), (11, [0.0, 0.0], 3)]
    table = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 AS id", "'x' AS code", "2 AS v", "3 AS error")
    assert found(table, parts=2, entries=2, rounds=2) == brute(rows, 2, 2, 2)
    assert found(table.filter("false"), parts=2)[0] == []
    assert found(table.filter("vec_id = 9"), parts=2)[0] == [(9, 2, None, None, None)]


@pytest.mark.parametrize("large", [1e6, 3e15, 1e30, 1e200])
def test_numbers_of_any_size_are_exact(spark, large):
    draw = np.random.default_rng(1)
    rows = [(int(i), (x * (large if i % 5 == 0 else 1.0)).tolist(), int(i % 3)) for i, x in enumerate(draw.normal(size=(60, 4)))]
    assert found(spark.createDataFrame(rows, VECTORS), parts=2, entries=8, rounds=2) == brute(rows, 2, 8, 2)


def test_limbs_add_up():
    for x in (0, 1, -1, 2 ** 40, -(2 ** 40), 2 ** 200 + 12345, -(3 ** 150)):
        assert sum(part << (vc.LIMB * i) for i, part in enumerate(vc.limbs(x))) == x and all(abs(p) < 2 ** vc.LIMB for p in vc.limbs(x))
