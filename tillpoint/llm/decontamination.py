"""Benchmark decontamination by winnowing.

A window is ``size`` consecutive words of a benchmark item, or all words of an item that has fewer. Of every window of a
text, the least hash of its runs of k = (size + 1) // 2 words is kept (winnowing): equal windows keep equal fingerprints, so
every shared span of ``size`` words shares one. An item of n < ``size`` words brings the same rule for n words, so at most
``size`` rules are in use.

*One pass over the texts* keeps the fingerprints that a bitmap of the benchmark's fingerprints has (a fixed number of bits,
8 MB; a bit too many lets a fingerprint through and changes no result), each with the words that any window around it can
reach. *The join* of these fingerprints with those of the benchmark is salted, so a passage that very many documents hold
is dealt out. *Extension* makes every window around a joined fingerprint and compares its words with the benchmark's windows,
so hash collisions don't count. Documents that hit the same windows share one list of items.

The texts aren't shuffled: what leaves the pass is one narrow row a document, and the reach of the fingerprints kept. A
benchmark so large that its bitmap is full lets every fingerprint through; the result stays, the traffic becomes some four
times the text.

A null text has no words; an item without words has no window. Rows that repeat a document's id, or have none, are documents
of their own. Items that share an id are one; the windows of an item without an id are hit, but name no item. Other
columns are ignored. An empty benchmark leaves all documents clean; no documents give no rows. A text of any length is one
row of a task, which holds some 40 bytes for each of its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import salted_join, slices, staged, text_of
from tillpoint.llm.shingles import BYTES, PLACES, U, mix, text_bytes

#: Bits of the benchmark's bitmap: the leading ones of a fingerprint are its place.
BITS = 26
#: Bits in a group of Spark's bitmap functions (fixed value).
GROUP_BITS = 32768

LOWER_BYTE = np.arange(256, dtype=np.uint8)
LOWER_BYTE[65:91] += 32
#: Words are runs of letters, digits and bytes beyond ASCII.
IN_WORD = np.zeros(256, dtype=bool)
for _from, _to in ((48, 58), (65, 91), (97, 123), (128, 256)):
    IN_WORD[_from:_to] = True


def run_length(size: int) -> int:
    """k of the k-grams whose least hash stands for a window of ``size`` words."""
    return (size + 1) // 2


class Words:
    """The words of a batch of texts: their bytes, hashes and texts."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        inside = IN_WORD[data]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        edges = bounds[(bounds > 0) & (bounds < len(data))]
        begins[edges] |= inside[edges]
        ends[edges - 1] |= inside[edges - 1]
        self.data = data
        self.first, self.last = np.flatnonzero(begins), np.flatnonzero(ends)
        #: words before each text, and all of them
        self.at = np.searchsorted(self.first, bounds)
        self.hashes = self._hashes(inside)

    def _hashes(self, inside: np.ndarray) -> np.ndarray:
        if not len(self.first):
            return np.empty(0, dtype=U)
        length = self.last - self.first + 1
        values = BYTES[LOWER_BYTE[self.data[inside]]]
        at = np.concatenate([[0], np.cumsum(length)[:-1]])
        place = np.arange(len(values)) - np.repeat(at, length)
        # bytes of a word weigh by their place; every 64th byte on, the sums so far weigh anew
        weights = PLACES[place % len(PLACES)] + (place // len(PLACES)).astype(U) * U(2)
        return mix(np.add.reduceat(values * weights, at) + length.astype(U))

    def text(self, i: int) -> str:
        return LOWER_BYTE[self.data[self.first[i]:self.last[i] + 1]].tobytes().decode("utf-8", "replace")

    def ends(self) -> np.ndarray:
        """For every word the place after the last word of its text."""
        return np.repeat(self.at[1:], np.diff(self.at))

    def grams(self, k: int) -> np.ndarray:
        n = max(0, len(self.hashes) - k + 1)
        out = np.zeros(n, dtype=U)
        for i in range(k):
            out += self.hashes[i:n + i] * PLACES[i]
        return mix(out)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the first words of all windows of ``size`` words, their fingerprints, and the hashes of all k-grams."""
        k = run_length(size)
        grams = self.grams(k)
        n = max(0, len(self.hashes) - size + 1)
        least = grams[:n].copy()
        for i in range(1, size - k + 1):
            np.minimum(least, grams[i:n + i], out=least)
        whole = np.flatnonzero(self.ends()[:n] - np.arange(n) >= size)
        return whole, least[whole], grams


def item_windows(items: DataFrame, size: int) -> DataFrame:
    """item_id, size, fp and words (joined by blanks) of every window of ``items`` (item_id, text)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text"):
                found = Words(*text_bytes(some.column("text")))
                counts = np.diff(found.at)
                own = np.repeat(np.arange(some.num_rows), counts)
                for n in sorted({int(min(c, size)) for c in counts if c}):
                    starts, prints, _ = found.windows(n)
                    fit = np.minimum(counts[own[starts]], size) == n
                    starts, prints = starts[fit], prints[fit]
                    texts = [" ".join(found.text(i) for i in range(a, a + n)) for a in starts.tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [some.column("item_id").take(pa.array(own[starts])), pa.array(np.full(len(starts), n, dtype=np.int32)),
                         pa.array(prints.view(np.int64)), pa.array(texts, pa.string())], ["item_id", "size", "fp", "words"])

    rows = items.select(F.col("item_id").cast("string").alias("item_id"), text_of().alias("text"))
    return rows.mapInArrow(scan, "item_id string, size int, fp long, words string")


def bitmap(prints: DataFrame) -> np.ndarray:
    """2 ^ BITS bits as bytes: those at the leading bits of the fingerprints are set."""
    bit = F.shiftrightunsigned("fp", 64 - BITS) + 1
    groups = (prints.select(F.bitmap_bucket_number(bit).alias("at"), F.bitmap_bit_position(bit).alias("bit"))
              .groupBy("at").agg(F.bitmap_construct_agg("bit").alias("bits")))
    out = np.zeros(2 ** BITS // 8, dtype=np.uint8)
    for row in groups.toLocalIterator():  # at most 2 ^ BITS / GROUP_BITS groups of 4 KB
        at = (row["at"] - 1) * GROUP_BITS // 8
        out[at:at + GROUP_BITS // 8] = np.frombuffer(row["bits"], dtype=np.uint8)
    return out


def scanned(docs: DataFrame, sizes: list[int], bits: np.ndarray) -> DataFrame:
    """row, doc_id, n_words and hits of every document: the fingerprints the bitmap has, with the words in reach.

    A hit is (size, fp, at, words): the words from place ``at`` on that a window of ``size`` words around it can hold.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bits)  # 2 ^ BITS / 8 bytes
    hit = pa.struct([("size", pa.int32()), ("fp", pa.int64()), ("at", pa.int64()), ("words", pa.list_(pa.string()))])

    def hits_of(found: Words, n_texts: int) -> list[list]:
        out: list[list] = [[] for _ in range(n_texts)]
        own = np.repeat(np.arange(n_texts), np.diff(found.at))
        for size in sizes:
            starts, prints, grams = found.windows(size)
            bit = prints >> U(64 - BITS)
            here = np.flatnonzero((shared.value[bit >> U(3)] >> (bit & U(7)).astype(np.uint8)) & 1)
            if not len(here):
                continue
            k = run_length(size)
            starts = starts[here]
            around = np.lib.stride_tricks.sliding_window_view(grams, size - k + 1)[starts]
            for p in np.unique(starts + around.argmin(axis=1)).tolist():
                text = int(own[p])
                low, high = max(int(found.at[text]), p - (size - k)), min(int(found.at[text + 1]), p + size)
                out[text].append({"size": size, "fp": int(grams[p].view(np.int64)), "at": low - int(found.at[text]),
                                  "words": [found.text(i) for i in range(low, high)]})
        return out

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for some in slices(batch, "text"):
                found = Words(*text_bytes(some.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(number, number + some.num_rows)), some.column("doc_id"), pa.array(np.diff(found.at)),
                     pa.array(hits_of(found, some.num_rows), pa.list_(hit))], ["row", "doc_id", "n_words", "hits"])
                number += some.num_rows

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(scan, "row long, doc_id long, n_words long, hits array<struct<size int, fp long, at long, words array<string>>>")


def occurrences(documents: DataFrame, windows: DataFrame) -> DataFrame:
    """row, start, size and window of every window of the benchmark in the scanned documents.

    windows: window, size, fp, words, one row for each different one.
    """
    kept = documents.select("row", F.explode("hits").alias("h")).select("row", "h.*")
    joined = salted_join(kept, windows.select("size", "fp").distinct(), ["size", "fp"], by="row")
    place = F.explode(F.sequence(F.lit(0), F.size("words") - F.col("size")))
    around = joined.select("row", "size", "at", "words", place.alias("i")).select(
        "row", (F.col("at") + F.col("i")).alias("start"), "size",
        F.array_join(F.slice("words", F.col("i") + 1, F.col("size")), " ").alias("words"))
    return salted_join(around, windows.select("window", "words"), ["words"], by="row").select("row", "start", "size", "window")


def covered(spans) -> F.Column:
    """Number of places in the union of (start, end) spans, given in any order."""
    first = F.struct(F.lit(0).cast("long").alias("upto"), F.lit(0).cast("long").alias("n"))

    def add(held, span):
        upto = F.greatest(held["upto"], span["end"])
        return F.struct(upto.alias("upto"), (held["n"] + F.greatest(F.lit(0), span["end"] - F.greatest(held["upto"], span["start"]))).alias("n"))

    return F.aggregate(F.array_sort(spans), first, add, lambda held: held["n"])


def decontamination(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, item_ids (as sorted strings) and contaminated of every row of ``docs`` (doc_id, text).

    ``items``: item_id, text.
    """
    every = staged(item_windows(items, size), "item-windows")
    windows = staged(every.groupBy("words").agg(F.first("size").alias("size"), F.first("fp").alias("fp"))
                     .withColumn("window", F.monotonically_increasing_id()), "windows")
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # at most ``size`` rows
    documents = staged(scanned(docs, sizes, bitmap(windows)), "scanned")
    spans = occurrences(documents, windows).groupBy("row").agg(
        F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("end"))).alias("spans"),
        F.array_sort(F.collect_set("window")).alias("windows"))
    hit = staged(spans.select("row", covered(F.col("spans")).alias("n_hit"), F.sha2(F.array_join("windows", ","), 256).alias("set"), "windows"), "hit")
    # one list of items for all documents that hit the same windows
    sets = hit.groupBy("set").agg(F.first("windows").alias("windows")).select("set", F.explode("windows").alias("window"))
    of_window = every.filter("item_id IS NOT NULL").select("words", "item_id").distinct().join(windows.select("words", "window"), "words")
    named = sets.join(of_window.select("window", "item_id"), "window").groupBy("set").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    listed = sets.select("set").distinct().join(named, "set", "left")
    found = salted_join(hit.select("row", "n_hit", "set"), listed, ["set"], by="row").drop("set")
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return documents.select("row", "doc_id", "n_words").join(found, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        ids.alias("item_ids"), F.col("n_hit").isNotNull().alias("contaminated"))


def clean_documents(docs: DataFrame, items: DataFrame, size: int = 10, most: float = 0.0) -> DataFrame:
    """The rows of ``docs``, with all their columns, of whose words at most the share ``most`` is hit; rows of one id stay or go together."""
    found = decontamination(docs, items, size).filter(F.col("n_hit") > F.col("n_words") * F.lit(float(most)))
    leave = found.filter("doc_id IS NOT NULL").select("doc_id").distinct()
    return docs.join(leave, docs["doc_id"].cast("long") == leave["doc_id"], "left_anti")
