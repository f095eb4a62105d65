"""Vector codes by product quantisation over per-dimension value dictionaries.

Components become whole numbers floor(scale * x). Vectors are cut into equal consecutive parts, each with a codebook of at
most ``entries`` entries: it starts as that part of the vectors with the smallest ids, and every round assigns all parts to their
nearest entry (squared Euclidean distance, ties to the lower index) and moves an entry to the floor of its parts' mean.

*Dictionaries.* Vectors are written once, in blocks; a block holds for each dimension the distinct numbers that occur in it and
every vector's place among them. A round tabulates, for each dimension, the squared differences of every distinct number
to all entries; a part's distances are rows gathered from its tables by those places, and added. The sums an entry
moves to come from how often an entry met a dictionary's numbers. The vectors themselves are read in no round.

*Across tasks* go one count and one sum for each entry and dimension, from each task; the driver holds the codebooks only
(entries x dimensions). Numbers of any size are exact: blocks whose squares leave 64 bits are computed with Python's integers,
and sums travel in limbs.

A row whose vector is null or holds a null or non-finite component is dropped. Codebooks are for one length of vectors: that of
the smallest id among those that ``parts`` divide. Vectors of another length stay, with null code and errors, and belong to no
label's sum. Rows without an id come after all others and may repeat; so may ids, ordered by vector and label. An error beyond
64 bits is null, as is the sum of a label with such an error or beyond 64 bits. Fewer vectors than entries make smaller
codebooks. Labels of any type are compared as they are, nulls together. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import exact, matrices, salted_join, staged, whole_vectors

#: Numbers in a block at most: bounds a task's memory.
BLOCK_NUMBERS = 262_144
#: Sums of whole numbers travel in limbs of so many bits.
LIMB = 40
LARGEST = 2 ** 63 - 1
Codebooks = list[list[list[int]]]  # part, entry, position


def blocks(vectors: DataFrame, dim: int) -> DataFrame:
    """Rows of up to BLOCK_NUMBERS numbers: ids, labels, and by dimension the distinct numbers and their places."""
    label = vectors.schema["label"].dataType
    most = max(1, BLOCK_NUMBERS // dim)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                some = batch.slice(at, most)
                numbers = next(m for _, _, m in matrices(some.column("v")))
                values, places = [], []
                for d in range(dim):
                    distinct, place = np.unique(numbers[:, d], return_inverse=True)
                    values.append(distinct)
                    places.append(place.astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([some.column(c).to_pylist()], pa.list_(some.column(c).type)) for c in ("id", "label")]
                    + [pa.array([values], pa.list_(pa.list_(pa.float64()))), pa.array([places], pa.list_(pa.binary()))],
                    ["ids", "labels", "numbers", "places"])

    return vectors.mapInArrow(fold, f"ids array<long>, labels array<{label.simpleString()}>, numbers array<array<double>>, places array<binary>")


def dictionaries(numbers: list[list[float]], places: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Distinct numbers of each dimension, and every vector's place among them."""
    return [exact(np.asarray(of)) for of in numbers], [np.frombuffer(p, dtype="<u4") for p in places]


def nearest(values: list[np.ndarray], places: list[np.ndarray], book: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """For every vector's part the index of its nearest entry and the squared distance: table rows gathered and added."""
    top = max((abs(int(x)) for of in values for x in (of[0], of[-1])), default=0) + max((abs(x) for e in book for x in e), default=0)
    kind = np.int64 if len(values) * top * top < 2 ** 62 else object
    total = np.zeros((len(places[0]) if places else 0, len(book)), dtype=kind)
    for d, (distinct, place) in enumerate(zip(values, places)):
        entries = np.asarray([e[d] for e in book], dtype=kind)
        table = (distinct.astype(kind)[:, None] - entries[None, :]) ** 2
        total += table[place]
    best = total.argmin(axis=1)
    return best, total[np.arange(len(best)), best]


def assigned(values, places, books: Codebooks) -> list[tuple[np.ndarray, np.ndarray]]:
    width = len(values) // len(books)
    return [nearest(values[p * width:(p + 1) * width], places[p * width:(p + 1) * width], book) for p, book in enumerate(books)]


def limbs(x: int) -> list[int]:
    """Signed limbs of a whole number, lowest first."""
    sign, rest, out = (-1 if x < 0 else 1), abs(x), []
    while rest:
        out.append(sign * (rest & (2 ** LIMB - 1)))
        rest >>= LIMB
    return out


def moved(data: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after one round over the blocks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [[0] * len(book) for book in books]
        sums = [[[0] * len(e) for e in book] for book in books]
        for batch in batches:
            for row in batch.to_pylist():
                values, places = dictionaries(row["numbers"], row["places"])
                width = len(values) // len(books)
                for p, (best, _) in enumerate(assigned(values, places, books)):
                    met = np.bincount(best, minlength=len(books[p]))
                    for e in np.flatnonzero(met):
                        counts[p][e] += int(met[e])
                    for d in range(width):
                        distinct, place = values[p * width + d], places[p * width + d]
                        often = np.bincount(best * len(distinct) + place, minlength=len(books[p]) * len(distinct)).reshape(-1, len(distinct))
                        plain = distinct.dtype != object and len(place) * max(abs(int(distinct[0])), abs(int(distinct[-1]))) < 2 ** 62
                        of = often @ distinct if plain else often.astype(object) @ distinct.astype(object)
                        for e in np.flatnonzero(met):
                            sums[p][e][d] += int(of[e])
        rows = []
        for p, of_part in enumerate(counts):
            for e, n in enumerate(of_part):
                if n:
                    rows.append((p, e, -1, 0, n))
                    rows += [(p, e, d, i, x) for d, total in enumerate(sums[p][e]) for i, x in enumerate(limbs(total))]
        if rows:
            names = ["part", "entry", "position", "limb", "n"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)

    told = data.select("numbers", "places").mapInArrow(count, "part long, entry long, position long, limb long, n long")
    found: dict[tuple, int] = {}
    for r in told.groupBy("part", "entry", "position", "limb").agg(F.sum("n").alias("n")).collect():  # entries x dimensions
        key = r["part"], r["entry"], r["position"]
        found[key] = found.get(key, 0) + (r["n"] << (LIMB * r["limb"]))
    return [[[found.get((p, e, d), 0) // found[p, e, -1] for d in range(len(entry))] if (p, e, -1) in found else entry
             for e, entry in enumerate(book)] for p, book in enumerate(books)]


def coded(data: DataFrame, books: Codebooks, label: str) -> DataFrame:
    """id, label, code and error of every vector of the blocks."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, labels = (batch.column(c)[i].values for c in ("ids", "labels"))
                values, places = dictionaries(*(batch.column(c)[i].as_py() for c in ("numbers", "places")))
                parts = assigned(values, places, books)
                hexes = [np.asarray([f"{e:02x}" for e in range(len(book))])[best] for book, (best, _) in zip(books, parts)]
                errors = [sum(int(x) for x in of) for of in zip(*(error.tolist() for _, error in parts))]
                yield pa.RecordBatch.from_arrays(
                    [ids, labels, pa.array(["".join(h) for h in zip(*hexes)], pa.string()),
                     pa.array([x if x <= LARGEST else None for x in errors], pa.int64())], ["id", "label", "code", "error"])

    return data.mapInArrow(code, f"id long, label {label}, code string, error long")


def digest(books: Codebooks) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


def vector_codes(rows: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: float = 256.0, id_column: str = "vec_id",
                 vector_column: str = "embedding", label_column: str = "label") -> tuple[DataFrame, Codebooks]:
    """(vec_id, label, code, error and label_error of every row that takes part, codebooks).

    A code is two hex digits for each part; ``entries`` is 256 at most.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code of two hex digits tells 1 to 256 entries apart")
    usable = rows.select(F.col(id_column).cast("long").alias("id"), whole_vectors(F.col(vector_column), scale).alias("v"),
                         F.col(label_column).alias("label")).filter("v IS NOT NULL")
    fit = (F.size("v") > 0) & (F.size("v") % parts == 0)
    order = [F.col("id").asc_nulls_last(), "v", F.col("label").asc_nulls_last()]
    first = usable.filter(fit).orderBy(*order).limit(1).collect()
    dim = len(first[0]["v"]) if first else 0
    label = usable.schema["label"].dataType.simpleString()
    other = usable.filter(F.size("v") != dim) if dim else usable
    none = other.select(F.col("id").alias("vec_id"), "label", F.lit(None).cast("string").alias("code"),
                        F.lit(None).cast("long").alias("error"), F.lit(None).cast("long").alias("label_error"))
    if not dim:
        return none, [[] for _ in range(parts)]
    vectors = usable.filter(F.size("v") == dim)
    width = dim // parts
    start = [[int(x) for x in r["v"]] for r in vectors.orderBy(*order).limit(entries).collect()]
    books: Codebooks = [[v[p * width:(p + 1) * width] for v in start] for p in range(parts)]
    data = staged(blocks(vectors, dim), "vector-blocks")
    for _ in range(rounds):
        books = moved(data, books)
    found = staged(coded(data, books, label), "codes")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    fits = (F.count("error") == F.count(F.lit(1))) & (total <= F.lit(LARGEST).cast("decimal(38,0)"))
    labels = found.groupBy("label").agg(F.when(fits, total).cast("long").alias("label_error"))
    # nulls are one label: a flag and a stand-in make them a key of a plain join
    named = lambda df: df.withColumn("_null", F.col("label").isNull()).withColumn("_key", F.coalesce(F.col("label").cast("string"), F.lit("")))
    joined = salted_join(named(found), named(labels).drop("label"), ["_null", "_key"], by="id")
    done = joined.select(F.col("id").alias("vec_id"), "label", "code", "error", "label_error")
    return done.unionByName(none), books
