from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from tillpoint.llm import chat, mixing, quality
from tillpoint.llm.queries import QUERIES

from .conftest import SF, SF01
from .helpers import WORDS, documents, odd_documents

TURNS = "conv_id long, turn long, role string, text string"


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """Share by weight, stop at the cap, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, total = {s: 0.0 for s in order}, float(sum(sizes.values()))
    open_, left = set(order), total
    while left > 1e-9 * max(total, 1) and open_:
        each = left / sum(w[s] for s in open_)
        for s in list(open_):
            target[s] += each * w[s]
        left = 0.0
        for s in list(open_):
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
                open_.discard(s)
    return target


def check_mix(rows, got):
    words = [(i, len(WORDS.findall(t or "")), s) for i, t, s in rows]
    sizes = defaultdict(int)
    for _, n, s in words:
        sizes[s] += n
    target = plain_targets(sizes)
    want = sorted(((i, n, sizes[s], round(target[s], 6)) for i, n, s in words), key=str)
    assert sorted(((r.doc_id, r.size, r.source_size, round(r.target, 6)) for r in got), key=str) == want
    assert all(r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0) for r in got)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        taken[r.source_size, round(r.target, 6)] += r.taken
        largest[r.source_size, round(r.target, 6)] = max(largest[r.source_size, round(r.target, 6)], r.size)
    for key, n in taken.items():
        same = sum(1 for s in sizes if (sizes[s], round(target[s], 6)) == key)
        assert abs(n - same * key[1]) <= 2 * same * largest[key] + 1e-6


def test_mix_of_table_and_odd_rows(spark):
    table = spark.read.parquet(f"{SF01}/documents.parquet")
    got = QUERIES["op3_mixing"](spark, SF01).collect()
    check_mix([(r.doc_id, r.text, r.source) for r in table.collect()], got)
    again = QUERIES["op3_mixing"](spark, SF01).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))
    odd = odd_documents(spark).selectExpr("*", "1 AS p", "'x' AS copies", "2 AS target", "3 AS size")
    check_mix([(r.doc_id, r.text, r.source) for r in odd.collect()], mixing.mix_report(odd).collect())
    assert mixing.mix_report(odd.filter("false")).collect() == []


def test_mix_takes_rows_as_reported(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 4)
    monkeypatch.setattr(mixing, "FAN", 2)
    rows = [(i, "w " * (1 + i % 7), "hot" if i % 3 else f"s{i % 5}") for i in range(200)]
    docs = documents(spark, rows).selectExpr("*", "'kept' AS _c")
    report = mixing.mix_report(docs).collect()
    check_mix(rows, report)
    copies = defaultdict(int)
    for r in mixing.mix(docs).collect():
        assert r._c == "kept"
        copies[r.doc_id] += 1
    assert {r.doc_id: r.taken // r.size for r in report if r.taken} == dict(copies)


def test_draws_keep_the_expected_number_of_copies():
    import pandas as pd

    rows = pd.DataFrame({"source": "s", "doc_id": [str(i) for i in range(40)], "size": np.arange(1, 41), "n": 1, "source_size": 1,
                         "target": 1.0, "copies": 0, "p": 0.3, "block": 0})
    total = sum(mixing.settle(rows, seed, 0, True)["copies"].to_numpy() for seed in range(3000)) / 3000
    assert np.abs(total - 0.3).max() < 0.05


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_chats(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        convs[c].append((-(2 ** 63) if t is None else t, r or "", x or ""))
    out = []
    for c, turns in convs.items():
        turns = [(r, x) for _, r, x in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        out.append((c, len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(loss), sha(loss),
                    sum(len(chat.default_template([t])) for t in turns)))
    return sorted(out, key=str)


def test_chats_of_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = r"\### Assistant: </turn> ok"
    rows += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    assert sorted((tuple(r) for r in QUERIES["op8_chat"](spark, SF).collect()), key=str) == plain_chats(rows)


def test_odd_chats(spark):
    marks = ["</turn>\n", "### assistant: ", "\\", "\\#", "### assistant: x</turn>\n### user: y", "", None, "a", "<", "é😀"]
    rows = [(i, k, "assistant" if k % 2 else "user", m + n if m and n else m) for i, m in enumerate(marks) for k, n in enumerate(marks)]
    rows += [(50, 1, "assistant", "x"), (50, 1, "assistant", "x"), (50, 1, None, "y"), (51, None, "a: b\n", "t"), (None, 0, "assistant", "z"),
             (52, 0, "tool", "long " * 100_000)]
    turns = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 AS formatted", "'x' AS spans")
    done = chat.format_chats(turns)
    assert done.filter("rewrites").count() == 0
    assert sorted((tuple(r) for r in chat.digests(done).collect()), key=str) == plain_chats(rows)
    assert chat.format_chats(turns.filter("false")).collect() == []


def test_black_boxes():
    def forgetful(turns, opened=False):  # shows the last question only
        return "|".join(x for _, x in turns[-2:])

    def trimming(turns, opened=False):
        return "".join(f"[{r}]{x.strip()}[end]" for r, x in turns) + ("[assistant]" if opened else "")

    turns = [("user", "one"), ("assistant", "[end] two[end]"), ("user", "three"), ("assistant", "")]
    _, rewrites, spans = chat.render(turns, forgetful)
    assert rewrites and spans == []
    text, rewrites, spans = chat.render(turns, trimming)
    assert not rewrites and [text[a:b] for _, _, a, b, _ in spans] == ["one", "[end] two[end]", "three", ""]
    assert "".join(text[a:b] for a, b, *_ in spans) == text


def test_quality_holds_out(spark):
    """Fit on four fifths of the labelled documents, told right on the rest."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.quality(docs, labels.filter("doc_id % 5 != 0")).join(labels.filter("doc_id % 5 = 0"), "doc_id")
    right = got.selectExpr("avg(int(kept = (quality = 1))) AS all", "avg(int(kept)) FILTER (WHERE quality = 1) AS good",
                           "avg(int(kept)) FILTER (WHERE quality = 0) AS bad").first()
    assert right["all"] > 0.97 and right["good"] > 0.99 and right["bad"] < 0.15, right


def test_quality_of_odd_rows(spark):
    odd = odd_documents(spark).selectExpr("*", "1 AS _p", "'x' AS bins", "2 AS ratio", "3 AS row")
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, 0), (None, 1), (5, None), (11, 1)], "doc_id long, quality int")
    got = quality.quality(odd, labels)
    assert got.count() == odd.count() and got.filter("p_good IS NULL OR kept IS NULL").count() == 0
    assert quality.good_documents(odd, labels).columns == odd.columns
    none = quality.quality(odd, labels.filter("false"))
    assert none.filter("kept").count() == odd.count()
    assert quality.quality(odd.filter("false"), labels).collect() == []


def test_sparse_sites_shrink_to_their_host(spark):
    good, bad = "plain words in a plain text " * 5, "SHOUT!! LOUD!! " * 20
    rows = [(i, bad if i % 10 < 8 else good, "bad") for i in range(400)] + [(1000 + i, good if i % 20 else bad, "good") for i in range(400)]
    rows += [(5000, good, "new")]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(r[0], int(r[1] == good)) for r in rows if r[0] % 3 == 0], "doc_id long, quality int")
    rate = {r.doc_id: r for r in quality.quality(docs, labels).collect()}
    overall = sum(r[1] == good for r in rows) / len(rows)
    assert rate[0].host_rate < 0.3 and rate[1000].host_rate > 0.85
    assert abs(rate[5000].host_rate - overall) < abs(1 - overall)  # one document says little
    assert all(rate[i].kept == (t == good) for i, t, _ in rows)


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 1000, None: 3}, {"é": 5}, {"a": 0, "b": 7}, {}])
def test_targets(spark, sizes):
    rows = [(s, 1, n) for s, n in sizes.items()]
    units = spark.createDataFrame(rows, "source string, n long, size long")
    got = {r.source: r.target for r in mixing.source_targets(units, (5, 2, 1), 3).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)
