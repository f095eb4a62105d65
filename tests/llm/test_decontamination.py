from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tillpoint.llm import decontamination as dec

from .helpers import LOWER, documents, odd_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def brute(docs, items, size=10):
    """(doc_id, n_words, n_hit, sorted items) by looking for every window at every place."""
    windows = {}
    for i, t in items:
        w = TERM.findall((t or "").translate(LOWER))
        n = min(len(w), size)
        for s in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[s:s + n]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, named = TERM.findall((t or "").translate(LOWER)), set(), set()
        for n in {len(x) for x in windows}:
            for s in range(len(w) - n + 1):
                found = windows.get(tuple(w[s:s + n]))
                if found:
                    hit.update(range(s, s + n))
                    named |= found
        out.append((d, len(w), len(hit), tuple(sorted(str(i) for i in named if i is not None))))
    return sorted(out, key=str)


def found(df):
    rows = df.collect()
    assert all(r["contaminated"] == (r["n_hit"] > 0) and r["n_items"] == len(r["item_ids"]) for r in rows)
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["item_ids"])) for r in rows), key=str)


def test_odd_texts_and_items(spark):
    items = [(1, "One two; three four FIVE six seven eight nine ten eleven"), (2, "a b"), (3, "é"), (4, None), (5, " .,;"), (None, "other text"),
             (10, "word " * 12), (9, "word word"), (2, "naïve café bar"), (1, "x y"), (11, "日本 語")]
    docs = odd_documents(spark)
    more = documents(spark, [(300, "zero one TWO three-four,five six seven eight nine ten eleven one two"),
                             (301, "one two three four five six seven eight nine"), (302, "a b a b"), (303, "wordy words, word. WORD")])
    every = docs.unionByName(more).selectExpr("*", "1 AS item_id", "'x' AS words", "2 AS row")
    bench = spark.createDataFrame(items, ITEMS).selectExpr("*", "1 AS doc_id", "'x' AS window")
    rows = [(r["doc_id"], r["text"]) for r in every.collect()]
    assert found(dec.decontamination(every, bench)) == brute(rows, items)
    clean = dec.clean_documents(every, bench)
    assert clean.columns == every.columns
    dirty = {d for d, _, n, _ in brute(rows, items) if n and d is not None}
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(str(d) for d, _ in rows if d not in dirty)


@pytest.mark.parametrize("size", [1, 2, 3, 10])
def test_every_shared_window_is_found(spark, monkeypatch, size):
    """Few different words, so texts share windows of all kinds; a bitmap of two bits lets everything through."""
    draw = random.Random(size)
    say = lambda n, of: " ".join(draw.choice("abcdefgh"[:of]) for _ in range(n))
    items = [(i, say(draw.randint(0, 30), 8)) for i in range(40)]
    docs = [(i, say(draw.randint(0, 200), 8) + " " + (items[draw.randrange(40)][1][:draw.randint(0, 60)] if i % 3 else "")) for i in range(150)]
    want = brute(docs, items, size)
    assert any(n for _, _, n, _ in want) and found(dec.decontamination(documents(spark, docs), spark.createDataFrame(items, ITEMS), size)) == want
    monkeypatch.setattr(dec, "bitmap", lambda prints: np.full(2 ** dec.BITS // 8, 255, dtype=np.uint8))
    assert found(dec.decontamination(documents(spark, docs), spark.createDataFrame(items, ITEMS), size)) == want


def test_equal_windows_keep_equal_fingerprints():
    text = " ".join(f"w{i}" for i in range(40))
    there = "x y " + text + " z"
    parse = lambda t: dec.Words(np.frombuffer(t.encode(), dtype=np.uint8), np.asarray([0, len(t)]))
    for size in (1, 2, 5, 10):
        (_, a, _), (_, b, _) = parse(text).windows(size), parse(there).windows(size)
        assert a.tolist() == b[2:-1].tolist()
        assert len(set(a.tolist())) <= 40  # fewer than windows, where windows are longer than k-grams


def test_bitmap_has_every_fingerprint_and_few_others(spark):
    prints = [0, 1, -1, 2 ** 63 - 1, -2 ** 63, 1 << 40, 12345678901234567]
    bits = dec.bitmap(spark.createDataFrame([(x,) for x in prints], "fp long"))
    places = sorted({(x % 2 ** 64) >> (64 - dec.BITS) for x in prints})
    assert np.flatnonzero(np.unpackbits(bits, bitorder="little")).tolist() == places


def test_no_documents_and_no_items(spark):
    docs, items = documents(spark, [(1, "a b c"), (2, None)]), spark.createDataFrame([(1, "a")], ITEMS)
    assert found(dec.decontamination(docs, items.filter("false"))) == [(1, 3, 0, ()), (2, 0, 0, ())]
    assert found(dec.decontamination(docs.filter("false"), items)) == []


def test_a_passage_in_a_third_of_the_documents_and_a_very_long_one(spark):
    passage = " ".join(f"p{i}" for i in range(15))
    items = [(i, f"i{i} {passage} j{i}") for i in range(20)] + [(100, "alone it stands " * 4)]
    docs = [(i, f"d{i} " + (passage if i % 3 == 0 else "nothing")) for i in range(300)] + [(1000, "long " * 200_000 + passage + " end" * 1000)]
    assert found(dec.decontamination(documents(spark, docs), spark.createDataFrame(items, ITEMS))) == brute(docs, items)
