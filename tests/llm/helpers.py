"""Fixtures with awkward rows, and plain versions of what the operators compute."""

from __future__ import annotations

import re
from collections import defaultdict

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

ODD_TEXTS = ["", " ", "a", "A", "a b", "É", "é", "naïve  café\n\nbar ", "x\n \ny", "<|endoftext|> z", "\x00 \x1c \x85", "日本 語",
             "one two three four five six", "ONE two three four five six", "same line\nsame line\nsame line\nsame line"]


def documents(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, source)"""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOCS)


def odd_documents(spark):
    rows = [(i, t, ("a", "b", None)[i % 3]) for i, t in enumerate(ODD_TEXTS)]
    rows += [(100, None, "a"), (None, "no id here", "b"), (0, "", "a"), (3, "A", "a"), (200, "word " * 30_000, "b"), (7, "other text", "a")]
    return documents(spark, rows)


def shingles(text, k):
    w = WORDS.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < k else (tuple(w[i:i + k]) for i in range(len(w) - k + 1)))


def groups(pairs, nodes):
    """node -> least node of its component"""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def jaccard_groups(rows, k, part, whole=100):
    """doc_id -> (size of its set, component), by comparing all pairs that share a shingle"""
    sets = {i: shingles(t, k) for i, t in rows}
    having = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            having[x].append(i)
    common = defaultdict(int)
    for ids in having.values():
        for a in range(len(ids)):
            for b in range(a):
                common[ids[a], ids[b]] += 1
    linked = [p for p, n in common.items() if whole * n >= part * (len(sets[p[0]]) + len(sets[p[1]]) - n)]
    found = groups(linked, sets)
    return {i: (len(sets[i]), found[i]) for i in sets}
