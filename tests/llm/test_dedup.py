from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tillpoint.llm import components, exact_dedup, jaccard_join, line_dedup, shingles
from tillpoint.llm.queries import QUERIES

from .conftest import SF, SF01
from .helpers import LOWER, documents, jaccard_groups, odd_documents
from .helpers import shingles as plain_shingles


def plain_dedup(rows):
    norm = [(i, (t or "").translate(LOWER)) for i, t in rows]
    keep, size = {}, Counter(t for _, t in norm)
    for i, t in norm:
        if i is not None:
            keep[t] = max(i, keep.get(t, i))
    return sorted(((i, keep.get(t), size[t], t not in keep or i == keep[t], hashlib.sha256(t.encode()).hexdigest()) for i, t in norm), key=str)


@pytest.mark.parametrize("clash", [False, True])
def test_exact_dedup_of_table_and_odd_rows(spark, clash):
    """With a digest of two letters many texts share one, and only their whole texts tell them apart."""
    options = {"digest": lambda c: F.substring(F.sha2(c, 256), 1, 1)} if clash else {}
    for docs in (spark.read.parquet(f"{SF}/documents.parquet"), odd_documents(spark).selectExpr("*", "1 AS keep_id", "'x' AS digest")):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        got = sorted((tuple(r) for r in exact_dedup.exact_dedup(docs, salts=3, **options).collect()), key=str)
        want = plain_dedup(rows)
        assert [r[:4] for r in got] == [r[:4] for r in want]
        if not clash:
            assert got == want
    assert exact_dedup.exact_dedup(docs.filter("false")).collect() == []


def plain_hash(lines):
    """Spark's hash of an array of line hashes."""
    out = 42
    for x in lines:
        line = xxhash.xxh64(x.encode(), seed=42).intdigest()
        out = xxhash.xxh64(line.to_bytes(8, "little"), seed=out).intdigest()
    return out - 2 ** 64 if out >= 2 ** 63 else out


def plain_chunks(lines, least, modulus):
    solid = [i for i, x in enumerate(lines) if x.strip(" \t\x0b\x0c\r")]
    windows = range(len(solid) - least + 1)
    begins = [k for k in windows if modulus == 1 or plain_hash(lines[solid[k]:solid[k + least - 1] + 1]) % modulus == 0]
    return [(solid[k], solid[after + least - 2] if after is not None else solid[-1]) for k, after in zip(begins, [*begins[1:], None])]


def plain_line_dedup(rows, least=line_dedup.LEAST, modulus=line_dedup.MODULUS):
    first = {}
    cut = [(i, (t or "").split("\n")) for i, t in rows]
    for i, lines in cut:
        for a, b in plain_chunks(lines, least, modulus) if i is not None else ():
            piece = "\n".join(lines[a:b + 1])
            first[piece] = min(first.get(piece, (i, a)), (i, a))
    out = []
    for i, lines in cut:
        chunks = plain_chunks(lines, least, modulus) if i is not None else ()
        gone = {x for a, b in chunks if (i, a) > first["\n".join(lines[a:b + 1])] for x in range(a, b + 1)}
        out.append((i, "\n".join(x for n, x in enumerate(lines) if n not in gone), len(gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("least", "modulus", "clash"), [(2, 1, False), (3, 1, False), (2, 4, False), (3, 3, False), (2, 1, True), (2, 4, True)])
def test_line_dedup_of_table_and_odd_rows(spark, least, modulus, clash):
    """With a hash of seven values nearly all chunks share one, and only their whole texts tell them apart."""
    options = {"digest": lambda c: F.pmod(F.xxhash64(c), F.lit(7 * modulus))} if clash else {}
    shared = "\n".join(f"shared line number {i}" + "\n \n" * (i % 3 == 0) for i in range(30))
    more = [(300 + i, f"own {i}\n{shared}\nend {i}") for i in range(6)] + [(400, shared), (401, shared), (402, "\n\n\n\n"), (403, "\n\n\n\n"),
                                                                          (404, "a\nb\nc\nd"), (404, "b\nc\nd\ne"), (404, "b\nc\nd\ne")]
    odd = odd_documents(spark).unionByName(documents(spark, more)).selectExpr(
        "*", "1 AS _id", "'x' AS _text", "2 AS _row", "3 AS _gone", "4 AS _print", "5 AS _asked", "6 AS key", "7 AS _lines")
    for docs in (spark.read.parquet(f"{SF if clash else SF01}/documents.parquet"), odd):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        got = line_dedup.line_dedup(docs, least, modulus, salts=3, **options)
        assert got.columns == [*docs.columns, "removed_lines"]
        assert sorted((tuple(r) for r in got.select("doc_id", "text", "removed_lines").collect()), key=str) == plain_line_dedup(rows, least, modulus)
        extra = [c for c in docs.columns if c not in ("text", "doc_id")]
        assert pairs(got, *extra) == pairs(docs, *extra)
    assert line_dedup.line_dedup(odd.filter("false"), least, modulus).collect() == []


@pytest.mark.parametrize("modulus", [1, 4])
def test_passages_shift_without_harm(spark, modulus):
    shared = [f"passage line {i} of a text that stands in two documents" for i in range(60)]
    rows = [(1, "\n".join(["a", "b", *shared, "z"])), (2, "\n".join(["other start", *shared[:30], "an insertion", *shared[30:], "other end"]))]
    text = {r.doc_id: r.text for r in line_dedup.line_dedup(documents(spark, rows), modulus=modulus).collect()}
    assert text[1] == rows[0][1]
    assert len(text[2].split("\n")) < 25 and "an insertion" in text[2] and "other start" in text[2]
    if modulus == 1:
        assert text[2] == "other start\nan insertion\nother end"


def test_short_passages_between_own_lines_go(spark):
    """Passages of 2 to 6 lines, and none of the lines around them."""
    own = lambda i, side: [f"{side} {n} of document {i}" for n in range(8)]
    passage = {n: [[f"line {x} of passage {p} with {n}" for x in range(n)] for p in range(20)] for n in range(2, 7)}
    rows = []
    for n, each in passage.items():
        for p, lines in enumerate(each):
            rows += [(i, "\n".join([*own(i, "before"), *lines, *own(i, "after")])) for i in (1000 * n + p, 1000 * n + 500 + p)]
    text = {r.doc_id: r.text for r in line_dedup.line_dedup(documents(spark, rows)).collect()}
    for i, t in rows:
        assert text[i] == (t if i % 1000 < 500 else "\n".join(own(i, "before") + own(i, "after")))


def pairs(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_components(spark):
    links = [(1, 2), (2, 3), (10, 9), (5, 5), (4, 3), (20, 21), (21, 22), (22, 23), (23, 24), (24, 20)] + [(100 + i, 101 + i) for i in range(40)]
    got = dict(pairs(components.components(spark.createDataFrame(links, "a long, b long")), "node", "component"))
    want = {n: 1 for n in (1, 2, 3, 4)} | {9: 9, 10: 9} | {n: 20 for n in range(20, 25)} | {n: 100 for n in range(100, 141)}
    assert got == want
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_links_that_are_stars_take_no_step(spark, monkeypatch):
    """A step takes some twenty stages of the driver's memory."""
    names = []
    monkeypatch.setattr(components, "staged", lambda df, name, staged=components.staged: (names.append(name), staged(df, name))[1])
    stars = [(9, 1), (8, 1), (1, 7), (5, 4), (4, 6), (9, 1), (3, 3)]
    got = dict(pairs(components.components(spark.createDataFrame(stars, "a long, b long")), "node", "component"))
    assert got == {1: 1, 7: 1, 8: 1, 9: 1, 4: 4, 5: 4, 6: 4}
    assert names == ["links"]
    text = "one two three four five six seven eight nine ten"
    docs = documents(spark, [(i, f"{text} {'x' * (i // 3)}") for i in range(30)])
    names.clear()
    found = dict(pairs(jaccard_join.near_groups(docs, words=1, part=80), "doc_id", "component_id"))
    assert found == {i: 0 for i in range(30)}
    assert names[-1] == "links"  # the second search begins with the stars of the first


@pytest.mark.parametrize(("k", "part"), [(3, 90), (5, 80)])
def test_shingle_sets(k, part):
    texts = ["", "  ", "a", "A b", "one two THREE four", "é è\x85x y z", "a b a b a b a b", "x\ty\nz\x0bw\x0cv\rq"]
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    starts = np.cumsum([0, *(len(t.encode()) for t in texts)])
    assert [len(x) for x in shingles.shingle_sets(data, starts, k)] == [len(plain_shingles(t, k)) for t in texts]


def test_linked_sets_share_a_key():
    """Random sets just similar enough, of all sizes, at both similarities in use."""
    draw = np.random.default_rng(2)
    for s in (jaccard_join.Similarity(3, 90), jaccard_join.Similarity(5, 80)):
        for n in [*range(1, 60), 100, 333, 1000, 3000] * 3:
            base = draw.integers(0, 2 ** 63, n, dtype=np.uint64)
            for _ in range(4):
                most = s.differences(2 * n)  # about
                cut = int(draw.integers(0, most + 1))
                new = int(draw.integers(0, most - cut + 1))
                a = np.unique(base)
                b = np.unique(np.concatenate([draw.permutation(base)[cut:], draw.integers(0, 2 ** 63, new, dtype=np.uint64)]))
                inter = len(np.intersect1d(a, b))
                if not len(b) or len(a) == len(b) == inter or s.whole * inter < s.part * (len(a) + len(b) - inter):
                    continue
                for share in (0, 0.3, 0.8, 1):  # any n-grams can be taken for common
                    common = np.sort(draw.permutation(np.union1d(a, b))[:int(share * len(a))])
                    sides = [dict(zip(*(x.tolist() for x in jaccard_join.piece_keys(x, s, common)))) for x in (a, b)]
                    shared = sides[0].keys() & sides[1].keys()
                    per_class = Counter(k & 255 for k in shared)
                    assert shared, (n, cut, new, share)
                    for needs in sides:  # in some class, the pieces shared are as many as a link leaves
                        assert any(per_class[k & 255] >= needs[k] for k in shared), (n, cut, new, share)


def test_short_sets_with_a_common_passage_share_no_key():
    """Sets of 20 common n-grams and 10 of their own can't link, so a group of them needs no star."""
    draw, s = np.random.default_rng(5), jaccard_join.Similarity(5, 80)
    common = np.unique(draw.integers(0, 2 ** 63, 20, dtype=np.uint64))
    having = Counter()
    for _ in range(200):
        own = np.unique(np.concatenate([common, draw.integers(0, 2 ** 63, 10, dtype=np.uint64)]))
        having.update(set(jaccard_join.piece_keys(own, s, common)[0].tolist()))
    assert max(having.values()) == 1


def test_overlaps_are_exact():
    draw = np.random.default_rng(4)
    sets = [np.unique(draw.integers(0, 2 ** 64, 50, dtype=np.uint64) * (np.arange(50) % 3 > 0).astype(np.uint64)) for _ in range(7)]
    sets += [np.unique(np.concatenate([sets[0][:20], sets[1]])), np.asarray([2 ** 64 - 1], dtype=np.uint64)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert jaccard_join.overlaps(sets, sets).tolist() == want


@pytest.mark.parametrize(("words", "part"), [(3, 90), (5, 80)])
def test_near_groups_of_table(spark, words, part):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    want = jaccard_groups([(r.doc_id, r.text) for r in docs.collect()], words, part)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_groups(docs, words, part).collect()}
    assert got == want
    kept = {r.doc_id for r in jaccard_join.one_of_each(docs, words=words, part=part).collect()}
    assert kept == {c for _, c in want.values()}


def plain_links(rows, k, part, whole=100):
    """By row: shingles and the number of other rows that link."""
    sets = [plain_shingles(t, k) for _, t in rows]
    out = []
    for x, (i, _) in enumerate(rows):
        near = sum(1 for y in range(len(rows)) if x != y and sets[x] and sets[y] and min(len(sets[x]), len(sets[y])) * whole >= part * max(len(sets[x]), len(sets[y]))
                   and whole * len(sets[x] & sets[y]) >= part * len(sets[x] | sets[y]))
        out.append((i, len(sets[x]), near))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [512, 4])
def test_link_counts_of_table_and_odd_rows(spark, monkeypatch, block):
    """Every link counts, also those within large stars cut into blocks; copies are not written out as pairs."""
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    base = [f"w{i}" for i in range(100)]
    near = [(300 + i, " ".join(base[:100 - i % 14] + [f"x{i % 14}.{j}" for j in range(i % 14)])) for i in range(40)]
    odd = odd_documents(spark).unionByName(documents(spark, near)).selectExpr("*", "1 AS low", "'x' AS class_id", "2 AS component")
    for docs in (spark.read.parquet(f"{SF}/documents.parquet"), odd):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        got = jaccard_join.link_counts(docs, 3, 80, salts=3)
        assert sorted((tuple(r) for r in got.select("doc_id", "n_shingles", "n_links").collect()), key=str) == plain_links(rows, 3, 80)
    links, members = jaccard_join.class_links(odd, 3, 80)
    assert links.count() == links.distinct().count() > 0
    assert members.filter("class_id IS NULL").count() == members.filter("n_shingles = 0").count()
    assert jaccard_join.link_counts(odd.filter("false"), 3, 80).collect() == []


def test_registered_near_groups(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = jaccard_groups([(r.doc_id, r.text) for r in docs.collect()], 3, 90)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op10_jaccard_join"](spark, SF).collect()}
    assert got == want


def test_many_near_copies_in_small_blocks(spark, monkeypatch):
    """A group cut into many blocks, a chain that links only step by step, and sizes too far apart."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 5)
    monkeypatch.setattr(jaccard_join, "COMMON", 6)
    draw = np.random.default_rng(9)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(40):
        own = list(base)
        for p in draw.integers(0, 120, int(draw.integers(0, 4))):
            own[p] = f"x{i}.{p}"
        rows.append((i, " ".join(own)))
    chain = [f"c{i}" for i in range(90)]
    for i in range(12):
        chain[i * 7] = f"y{i}"
        rows.append((100 + i, " ".join(chain)))
    rows += [(200 + i, " ".join(base[:40 + 6 * i])) for i in range(12)]
    docs = documents(spark, [rows[i] for i in draw.permutation(len(rows))])
    for words, part in ((3, 90), (5, 80), (2, 95)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_groups(docs, words, part).collect()}
        assert got == jaccard_groups(rows, words, part)


def test_chained_candidates_stay_in_small_stars(spark):
    """Neighbours share a passage, far from a link: no star has more than a document and its two neighbours."""
    words = lambda a, n: [f"{a}.{i}" for i in range(n)]
    rows = [(i, " ".join(words(f"p{i}", 40) + words(f"own{i}", 20) + words(f"p{i + 1}", 40))) for i in range(60)]
    docs = documents(spark, rows)
    s = jaccard_join.Similarity(5, 80)
    stars = {(r.grp, r.low) for r in jaccard_join.candidates(docs, s).collect()}
    assert max(Counter(g for g, _ in stars).values(), default=0) <= 3
    assert all(r.component_id == r.doc_id for r in jaccard_join.near_groups(docs, 5, 80).collect())


def test_blocks_of_a_star(spark, monkeypatch):
    """A large star is cut, blocks of the centre's component are marked, and a star of one component is left out."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 5)
    rows = [(1, i, 100 + i % 30, 1) for i in range(1, 41)] + [(1, i, 100, i) for i in (50, 51, 52)]
    rows += [(2, i, 10, 2) for i in range(2, 30)] + [(7, 7, 10, 7), (7, 8, 10, 8)]
    stars = spark.createDataFrame(rows, "grp long, low long, n_shingles long, component long")
    got = jaccard_join.star_blocks(stars, jaccard_join.Similarity(5, 80)).collect()
    assert sorted((r.grp, r.low) for r in got) == sorted((g, i) for g, i, _, _ in rows if g != 2)
    assert {r.low for r in got if r.core} == set(range(1, 41))
    assert len({r.block for r in got if r.core}) >= 8
    assert len({r.block for r in got if r.grp == 7}) == 1


def test_partial_counts_of_fragments(spark, monkeypatch):
    """Pairs with a centre of several parts; a text that stands twice counts once."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    base = [f"w{i}" for i in range(100)]
    texts = [" ".join(base[:100 - i] + [f"x{i}.{j}" for j in range(i)]) for i in range(30)]
    s = jaccard_join.Similarity(1, 80)
    low = [r.low for r in jaccard_join.document_sets(documents(spark, list(enumerate(texts))), s).orderBy("doc_id").collect()]
    held = spark.createDataFrame([(low[i], t) for i, t in enumerate(texts)] * 2, "low long, text string")
    asked = spark.createDataFrame([(x, low[0]) for x in low[1:]], "low long, centre long")
    got = {(r.a, r.b) for r in jaccard_join.centre_links(held, asked, s).collect()}
    assert got == {(low[i], low[0]) for i in range(1, 30) if 100 * (100 - i) >= 80 * (100 + i)}


def test_odd_rows_of_near_groups(spark):
    odd = odd_documents(spark).selectExpr("*", "1 AS low", "'x' AS keys", "2 AS component_id", "3 AS _left")
    got = jaccard_join.near_groups(odd, 3, 90).collect()
    assert len(got) == odd.count()
    by = {(r.doc_id, r.n_shingles): r.component_id for r in got}
    assert by[12, 4] == by[13, 4] == 12  # equal but for case
    assert by[2, 1] == by[3, 1] == 2  # a, A, and the repeated row
    assert by[0, 0] == 0 and by[100, 0] == 100 and by[None, 1] is None
    assert jaccard_join.near_groups(odd.filter("false"), 3, 90).collect() == []
    kept = jaccard_join.one_of_each(odd, words=3, part=90)
    assert kept.columns == odd.columns and kept.filter("doc_id = 13").count() == 0 and kept.filter("doc_id IS NULL").count() == 1
