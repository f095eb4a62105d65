"""Packing documents into training sequences by patterns fitted with non-negative least squares.

A document is its token ids and an end id. Only documents longer than a sequence are cut; all their pieces are full
but the first. What is planned is the histogram of piece lengths, which has at most ``capacity`` bins at any size of
the input:

1. a piece as long as a sequence stands alone;
2. patterns of two or three lengths that fill a sequence exactly are enumerated, at most ``PATTERNS`` of them, and
   their repeat counts are fitted to the histogram by non-negative least squares;
3. the counts are rounded down and never exceed the pieces there are;
4. what is left is packed best-fit, longest first, in runs of equal lengths.

The plan is a list of runs: so many pieces of one length, by rank, go to so many consecutive sequences at one offset.
Its size follows from the capacity, not from the number of documents. Every piece gets its rank among the pieces of
its length from prefix sums over (length, bucket), so that a common length is spread over many tasks, and finds its
run by its rank.

A null text counts as empty, which is the end id alone. Repeated rows are packed one by one. An empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.llm.common import shuffle_partitions, slices, staged, text_of
from tillpoint.llm.encoding import encoder

PATTERNS, STEPS = 20_000, 300
PIECES = "doc_id long, piece int, start long, length long, ids binary"


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, spaces_dropped: bool = False) -> DataFrame:
    """doc_id, piece, start, length and ids (unsigned little-endian 32-bit integers) of the pieces of ``docs``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer, spaces_dropped).encode, np.asarray([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for some in slices(batch, "text"):
                columns: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids")}
                for doc, ids in zip(some.column("doc_id").to_pylist(), encode(some.column("text").to_pylist())):
                    ids += end
                    n, start, piece = len(ids) // 4, 0, 0
                    while start < n:
                        stop = start + ((n - start) % capacity or capacity)
                        for k, v in zip(columns, (doc, piece, start, stop - start, ids[4 * start:4 * stop])):
                            columns[k].append(v)
                        start, piece = stop, piece + 1
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_pydict({k: pa.array(v, t) for (k, v), t in zip(columns.items(), kinds)})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(cut, PIECES)


def full_patterns(counts: np.ndarray, capacity: int) -> np.ndarray:
    """Patterns of two or three present lengths that sum to the capacity: rows of three, 0 for no third.

    Where there are more than ``PATTERNS``, those whose scarcest length is the most frequent.
    """
    present = np.flatnonzero(counts[:capacity])
    present = present[present > 0]
    here = counts > 0
    two = present[(present * 2 <= capacity) & here[capacity - present]]
    found = [np.stack([capacity - two, two, np.zeros_like(two)], axis=1)]
    for c in present[present * 3 <= capacity]:
        b = present[(present >= c) & (present * 2 <= capacity - c)]
        b = b[here[capacity - c - b]]
        found.append(np.stack([capacity - c - b, b, np.full_like(b, c)], axis=1))
    patterns = np.concatenate(found)
    if len(patterns) > PATTERNS:
        padded = np.where(np.arange(len(counts)) == 0, counts.max(), counts)
        scarce = padded[patterns].min(axis=1)
        patterns = patterns[np.argsort(-scarce, kind="stable")[:PATTERNS]]
    return patterns


def fit(patterns: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Repeat counts x >= 0 that minimise the squared distance between the histogram and what x uses of it
    (accelerated projected gradient steps)."""
    b = counts.astype(float)
    b[0] = 0
    scale = max(b.max(), 1.0)
    b /= scale
    used = lambda x: np.bincount(patterns.ravel(), np.repeat(x, 3), minlength=len(b)) * (np.arange(len(b)) > 0)
    share = np.bincount(patterns.ravel(), minlength=len(b))
    share[0] = 0
    rate = 1.0 / max(1.0, 3.0 * share.max())
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(STEPS):
        gap = used(y) - b
        new = np.maximum(0, y - rate * gap[patterns].sum(axis=1))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / t_new * (new - x), new, t_new
    return x * scale


def plan(counts: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Runs (length, first rank, pieces, first sequence, offset) for ``counts[length]`` pieces of each length, and the
    number of sequences."""
    left, rank = counts.astype(np.int64).copy(), np.zeros(capacity + 1, dtype=np.int64)
    runs: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def place(length: int, n: int, first: int, offset: int) -> None:
        runs.append((length, int(rank[length]), n, first, offset))
        rank[length] += n
        left[length] -= n

    if left[capacity]:
        n = int(left[capacity])
        place(capacity, n, sequences, 0)
        sequences += n
    patterns = full_patterns(left, capacity)
    if len(patterns):
        repeats = np.floor(fit(patterns, left) + 1e-9).astype(np.int64)
        for i in np.argsort(-repeats, kind="stable"):
            n = int(repeats[i])
            if n <= 0:
                break
            lengths = [int(x) for x in patterns[i] if x]
            n = min(n, *(int(left[x]) // lengths.count(x) for x in lengths))
            if n > 0:
                offset = 0
                for x in lengths:
                    place(x, n, sequences, offset)
                    offset += x
                sequences += n
    room: dict[int, list[tuple[int, int]]] = {}
    free = np.zeros(capacity + 1, dtype=bool)

    def keep(space: int, first: int, n: int) -> None:
        if space and n:
            room.setdefault(space, []).append((first, n))
            free[space] = True

    for length in range(capacity - 1, 0, -1):
        while left[length]:
            fits = np.flatnonzero(free[length:])
            if len(fits):
                space = length + int(fits[0])
                first, n = room[space].pop()
                free[space] = bool(room[space])
                take = min(n, int(left[length]))
                place(length, take, first, capacity - space)
                keep(space - length, first, take)
                keep(space, first + take, n - take)
                continue
            each = capacity // length
            whole, rest = divmod(int(left[length]), each)
            n = whole or 1
            for k in range(each if whole else rest):
                place(length, n, sequences, k * length)
            keep(capacity - (each if whole else rest) * length, sequences, n)
            sequences += n
    return np.asarray(runs, dtype=np.int64).reshape(-1, 5), sequences


def ranked(found: DataFrame) -> DataFrame:
    """``found`` (doc_id, piece, length and others) with ``rank``, from 0, among the pieces of equal length."""
    buckets = shuffle_partitions(found.sparkSession)
    spread = found.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (spread.groupBy("length", "bucket").agg(F.count("*").alias("n"))
             .withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long"))).drop("n"))
    order = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", *[c for c in found.columns if c.endswith("crc32")])
    within = spread.withColumn("place", F.row_number().over(order) - 1)
    return within.join(bases, ["length", "bucket"]).withColumn("rank", F.col("base") + F.col("place")).drop("base", "place", "bucket")


def assign(found: DataFrame, capacity: int) -> DataFrame:
    """``found`` (staged: doc_id, piece, length and others) with ``sequence_id`` and ``offset``."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in found.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[length] = n
    runs, _ = plan(counts, capacity)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    starts = (runs[:, 0] << 44) + runs[:, 1]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            run = runs[np.searchsorted(starts, (length << 44) + rank, side="right") - 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(run[:, 3] + rank - run[:, 1]), pa.array(run[:, 4])],
                [*names, "sequence_id", "offset"])

    names = found.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema)
    return ranked(found).select(*names, "rank").mapInArrow(look_up, f"{kinds}, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 2048, spaces_dropped: bool = False) -> DataFrame:
    """The place of every piece of ``docs``: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    found = pieces(docs, tokenizer, end_id, capacity, spaces_dropped)
    narrow = found.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return assign(staged(narrow, "pieces"), capacity)


def sequences(found: DataFrame, places: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id and the ids of its pieces, in order, as one binary of at most ``capacity`` ids.

    ``found`` has ``ids`` (see ``pieces``), ``places`` comes from ``pack`` of the same documents. Ids may repeat or be null:
    equal pieces are numbered on both sides, and each meets one place.
    """
    keys = ["doc_id", "piece", "length", "ids_crc32"]

    def numbered(rows: DataFrame, *order: str) -> DataFrame:
        return rows.withColumn("copy", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))

    left = numbered(places.select(*keys, "sequence_id", "offset"), "sequence_id", "offset").alias("p")
    right = numbered(found.select("doc_id", "piece", "length", F.crc32("ids").alias("ids_crc32"), "ids"), "ids").alias("f")
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"f.{c}")) for c in (*keys, "copy")]
    both = left.join(right, same).select("sequence_id", "offset", "ids")
    parts = both.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda held, part: F.concat(held, part["ids"]))
    return parts.select("sequence_id", joined.alias("ids"))
