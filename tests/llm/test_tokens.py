from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillpoint.functions.lineage import scratch_path
from tillpoint.llm import mixing, packing, token_counts, token_files
from tillpoint.llm.encoding import ChunkEncoder
from tillpoint.llm.queries import QUERIES, tokenizer

from .conftest import SF
from .helpers import DOCS, documents, odd_documents

SIGNS = [" ", " ", "\n", "\t", "a", "b", "th", "'s", "É", "é", "1", ".", "<|endoftext|>", "日", "😀", "́", "\x85", "\x1c", "İ", "Σ", "▁", "\x00", "<s>", "ﬁ"]
TEXTS = st.lists(st.sampled_from(SIGNS), max_size=25).map("".join)
BYTE, WORD, PIECE = "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"


@pytest.mark.parametrize(("name", "dropped"), [(BYTE, False), (WORD, True)])
def test_chunks_give_the_ids_of_whole_texts(name, dropped):
    encoder = ChunkEncoder(tokenizer(name), dropped)

    @settings(max_examples=400, deadline=None)
    @given(TEXTS)
    def same(text):
        assert encoder.encode([text, text + " " + text]) == [encoder.whole(text), encoder.whole(text + " " + text)]

    same()


@pytest.mark.parametrize(("name", "dropped"), [(BYTE, False), (WORD, True)])
def test_words_need_the_models_merges_only(name, dropped, monkeypatch):
    """The whole library takes several times as long for a new chunk."""
    encoder, others = ChunkEncoder(tokenizer(name), dropped), []
    assert encoder.by_words
    monkeypatch.setattr(encoder, "_encode_new", lambda chunks, f=encoder._encode_new: (others.extend(chunks), f(chunks)))
    letters = [chr(i) for i in range(0x250) if chr(i).isalpha()]
    words = [*letters, *(a + "x" + a for a in letters), "Stra\u00DFe", "don", "s", "ll", "endoftext"]
    signs = ["", *(chr(i) for i in range(33, 127) if not chr(i).isalnum() and chr(i) not in "'<"), "...", "&&&", ".\"", "|>", "_-_"]
    texts = [" ".join(words), "\n".join(words), *(f"{x}{words[-1]}{x} b{x}\nc{x} d{x}" for x in signs), *(f"\u00E9t\u00E9{x} s{x} X{x}" for x in signs)]
    assert encoder.encode(texts) == [encoder.whole(t) for t in texts]
    assert all(dropped and ("\u0130" in c or max(c.lower()) >= "\u0250") or not c[0].isalpha() for c in others)
    odd = ["it's", "I'll.", "a'b", "x<|endoftext|>y", "a1", "1a", "a.b", "\u0130a", "e\u0301", "\u023A", "a\n\nb", "\na", "a\n", "a\tb", "", "a,'s"]
    texts = [x for a in odd for b in odd for x in (a, f"{a} {b}", f"{a}\n{b}", f"w {a}{b}")]
    assert encoder.encode(texts) == [encoder.whole(t) for t in texts]


def test_merging_counts_what_the_library_gives():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer(PIECE))
    counter = token_counts.PieceCounter(tokenizer(PIECE))

    @settings(max_examples=600, deadline=None)
    @given(TEXTS | st.text(max_size=30))
    def same(text):
        assert counter.count(text) == len(library.encode(text))

    same()
    draw = random.Random(3)
    long = "".join(draw.choice("etaoin shrdlu") for _ in range(50_000)) + "x" * 5000
    assert counter.count(long) == len(library.encode(long))


def test_token_counts_of_table_and_odd_rows(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer(PIECE))

    def expected(rows):
        out = []
        for i, text in rows:
            n = len(library.encode(text or ""))
            out.append((i, len((text or "").encode()), n, n > 4096))
        return sorted(out, key=str)

    table = spark.read.parquet(f"{SF}/documents.parquet")
    got = sorted((tuple(r) for r in QUERIES["op4_token_counts"](spark, SF).collect()), key=str)
    assert got == expected([(r.doc_id, r.text) for r in table.collect()])
    odd = odd_documents(spark).selectExpr("*", "1 AS n_tokens")
    got = sorted((tuple(r) for r in token_counts.token_counts(odd, tokenizer(PIECE)).collect()), key=str)
    assert got == expected([(r.doc_id, r.text) for r in odd.collect()])
    assert token_counts.token_counts(odd.filter("false"), tokenizer(PIECE)).collect() == []


def encoded(library, text, end):
    return np.asarray([*library.encode(text or "", add_special_tokens=False).ids, end], dtype="<u4")


def expected_files(rows, library, end=2):
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = encoded(library, text, end)
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return sorted(out, key=str)


def test_token_files_of_table_and_odd_rows(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer(WORD))
    table = spark.read.parquet(f"{SF}/documents.parquet")
    got = sorted((tuple(r) for r in QUERIES["op2_token_files"](spark, SF).collect()), key=str)
    assert got == expected_files([(r.doc_id, r.text) for r in table.collect()], library)
    odd = odd_documents(spark).selectExpr("*", "'x' AS start", "2 AS ids")
    for options in ({}, {"id_bytes": 4, "partitions": 1}, {"partitions": 9}):
        read = token_files.token_files(odd, tokenizer(WORD), 2, **options).selectExpr("doc_id", "start", "n_tokens", "crc32(ids) AS c")
        assert sorted((tuple(r) for r in read.collect()), key=str) == expected_files([(r.doc_id, r.text) for r in odd.collect()], library)
    assert token_files.token_files(odd.filter("false"), tokenizer(WORD), 2).collect() == []


def test_token_files_are_flat_and_whole(spark):
    docs = documents(spark, [(i, "some words " * i) for i in range(40)])
    folder = scratch_path(spark, "flat")
    manifest = token_files.write_tokens(docs, folder, tokenizer(WORD), 2, partitions=4).collect()
    at = token_files.Folder(folder)
    assert sum(m.documents for m in manifest) == 40
    for m in manifest:
        name = m.path.rpartition("/")[2]
        offsets = at.array(f"{name}.idx", "<i8")
        ids = at.array(f"{name}.bin", "<u2")
        assert offsets[0] == 0 and offsets[-1] == len(ids) == m.tokens
        assert all(ids[x - 1] == 2 for x in offsets[1:])
    # a second run of a shard's task leaves the same files
    again = token_files.write_tokens(docs, folder, tokenizer(WORD), 2, partitions=4)
    assert again.groupBy().sum("tokens").first()[0] == sum(m.tokens for m in manifest)


def check_packing(rows, docs, capacity, library):
    """rows: as pack returns them. Every document is there once, cut as stated, and sequences are gapless."""
    expected = []
    for i, text in docs:
        ids = encoded(library, text, 0)
        start, piece = 0, 0
        while start < len(ids):
            stop = start + ((len(ids) - start) % capacity or capacity)
            expected.append((i, piece, start, stop - start, zlib.crc32(ids[start:stop].tobytes())))
            start, piece = stop, piece + 1
    assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(expected, key=str)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(x[3] for x in expected)
    return len(by), -(-total // capacity)


def test_packing_of_table_and_odd_rows(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer(BYTE))
    table = spark.read.parquet(f"{SF}/documents.parquet")
    used, least = check_packing(QUERIES["op7_packing"](spark, SF).collect(), [(r.doc_id, r.text) for r in table.collect()], 2048, library)
    assert used <= least * 1.03 + 1
    odd = odd_documents(spark).selectExpr("*", "'x' AS sequence_id", "3 AS length")
    check_packing(packing.pack(odd, tokenizer(BYTE), 0, 64).collect(), [(r.doc_id, r.text) for r in odd.collect()], 64, library)
    assert packing.pack(odd.filter("false"), tokenizer(BYTE), 0).collect() == []


def test_packed_sequences_hold_the_ids(spark):
    docs = documents(spark, [(i, "some words " * (1 + i % 9)) for i in range(60)])
    found = packing.pieces(docs, tokenizer(BYTE), 0, 32)
    got = packing.sequences(found, packing.pack(docs, tokenizer(BYTE), 0, 32)).collect()
    assert all(len(r.ids) <= 4 * 32 for r in got)
    assert sum(len(r.ids) for r in got) == sum(len(r.ids) for r in found.collect())


def test_packed_sequences_of_repeated_and_mixed_documents(spark):
    """Every piece stands once, at its place, also where documents share an id, are copies or have none."""
    rows = [(i, "some words " * (1 + i % 9), "ab"[i % 2]) for i in range(30)]
    rows += [(3, "some words " * 4, "a")] * 2 + [(5, "another text", "b"), (5, "a third text, " * 20, "b"), (None, "no id", "a"), (None, "no id", "a")]
    mixed = spark.createDataFrame(mixing.mix(documents(spark, rows), weights=(5, 1)).collect(), DOCS)
    assert mixed.count() > mixed.distinct().count()
    for docs in (documents(spark, rows), mixed):
        found = packing.pieces(docs, tokenizer(BYTE), 0, 32)
        places = packing.pack(docs, tokenizer(BYTE), 0, 32)
        ids = {r.sequence_id: r.ids for r in packing.sequences(found, places).collect()}
        assert all(len(x) <= 4 * 32 for x in ids.values())
        each = places.collect()
        assert sum(map(len, ids.values())) == 4 * sum(r.length for r in each) == sum(len(r.ids) for r in found.collect())
        for r in each:
            assert zlib.crc32(ids[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)]) == r.ids_crc32


@settings(max_examples=60, deadline=None)
@given(st.integers(2, 64).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.tuples(st.integers(1, c), st.integers(1, 400)), max_size=12))))
def test_plans_place_every_piece_once(case):
    capacity, lengths = case
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in lengths:
        counts[length] += n
    runs, sequences = packing.plan(counts, capacity)
    fill = {}
    for length in range(1, capacity + 1):
        at = 0
        for _, first, n, sequence, offset in sorted(r.tolist() for r in runs[runs[:, 0] == length]):
            assert first == at
            at += n
            for s in range(sequence, sequence + n):
                fill.setdefault(s, []).append((offset, length))
        assert at == counts[length]
    assert len(fill) == sequences
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


def test_patterns_fill_large_histograms():
    draw = np.random.default_rng(1)
    counts = np.bincount(np.minimum(2048, draw.lognormal(6.0, 1.2, 2_000_000).astype(int) + 1), minlength=2049)
    runs, sequences = packing.plan(counts, 2048)
    least = -(-int((counts * np.arange(2049)).sum()) // 2048)
    assert sequences <= least * 1.001
    assert len(runs) < 100_000
