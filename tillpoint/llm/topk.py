"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are sorted by length and cut into buckets of vectors of like length. A query's k-th best product in the bucket of
the longest vectors is a bound that its final k-th product cannot fall below. For another bucket, the bound divided by
the query's length and the bucket's greatest length is the least cosine that can still matter there. Above 1 the bucket
is skipped. A high one confines the candidate's coordinate on the axis where the query is longest to an interval
(coordinate pruning); otherwise candidates too short to reach the bound are cut off (length pruning). What is left is
verified with whole-number products, so the result is exact, ties to the smaller id.

Queries and buckets are packed into rows of numbers; every pair of a query block and a bucket that may matter is one
small unit of work, dealt out over all tasks, and returns at most k products for each query.

A vector that is null or holds a null or non-finite component takes no part, nor does one without an id. Vectors meet
vectors of their own dimension, empty ones too. Products of any size are exact (Python's integers beyond 64 bits) and
travel as text that sorts like the numbers; a score beyond 64 bits is null in the result, in its right place. A query
never meets a row of its own id. Rows that repeat a candidate's id are candidates each; a query repeated with its vector is answered once.
Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.llm.common import exact, number_column, shuffle_partitions, sortable, staged, whole_vectors

#: Vectors in a bucket and queries in a block: one unit of work is their product.
BUCKET, BLOCK = 2048, 1024
#: Least local cosine from which coordinates prune better than lengths.
COORDINATE_FROM = 0.7
PACKED = "pack long, dim int, longest double, ids binary, numbers binary"
SLACK = 1e-9


def scaled_vectors(rows: DataFrame, id_column: str, vector_column: str, scale: float) -> DataFrame:
    """``id``, ``v`` (whole numbers floor(scale * x), as doubles), ``norm2`` and ``dim`` of the rows that take part."""
    v = rows.select(F.col(id_column).cast("long").alias("id"), whole_vectors(F.col(vector_column), scale).alias("v"))
    square: Column = F.aggregate("v", F.lit(0.0), lambda held, x: held + x * x)
    return v.filter("id IS NOT NULL AND v IS NOT NULL").select("id", "v", square.alias("norm2"), F.size("v").alias("dim"))


def packed(vectors: DataFrame, most: int) -> DataFrame:
    """Rows of at most ``most`` vectors of one dimension, longest first within each range of lengths."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []

        def out() -> pa.RecordBatch:
            nonlocal number
            number += 1
            matrix = np.asarray([x[1] for x in held], dtype="<f8").reshape(len(held), held[0][3])
            if np.abs(matrix).max(initial=0.0) < 2.0 ** 31:
                matrix = matrix.astype("<i4")
            return pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), pa.array([matrix.shape[1]], pa.int32()), pa.array([float(np.sqrt(held[0][2]))]),
                pa.array([np.asarray([x[0] for x in held], dtype="<i8").tobytes()], pa.binary()),
                pa.array([matrix.tobytes()], pa.binary())], ["pack", "dim", "longest", "ids", "numbers"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("id", "v", "norm2", "dim"))):
                if held and (len(held) == most or held[0][3] != row[3]):
                    yield out()
                    held.clear()
                held.append(row)
        if held:
            yield out()

    order = ["dim", F.col("norm2").desc(), "id"]
    n = shuffle_partitions(vectors.sparkSession)
    return vectors.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(pack, PACKED)


def unpack(row: dict, side: str = "") -> tuple[np.ndarray, np.ndarray]:
    ids, data = np.frombuffer(row[f"{side}ids"], dtype="<i8"), row[f"{side}numbers"]
    wide = len(data) > 4 * len(ids) * row["dim"]
    numbers = np.frombuffer(data, dtype="<f8" if wide else "<i4").reshape(len(ids), row["dim"])
    return ids, exact(numbers) if wide else numbers


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of all rows of a with all of b: in floating point where no sum can exceed 2^53, in 64 bits or Python's integers."""
    top = lambda m: int(np.abs(m if m.dtype == object else m.astype(np.int64)).max(initial=0))
    most = a.shape[1] * top(a) * top(b)
    if most < 2 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    kind = np.int64 if most < 2 ** 63 else object
    return a.astype(kind) @ b.astype(kind).T


def below(x: int) -> float:
    """A float that is no larger than a whole number of any size."""
    try:
        return float(x) if abs(x) <= 2 ** 53 else float(np.nextafter(float(x), -np.inf))
    except OverflowError:
        return -np.inf if x < 0 else float(np.finfo(np.float64).max)


def lengths(m: np.ndarray) -> np.ndarray:
    """Infinite where the sum of squares leaves a float's range."""
    with np.errstate(over="ignore"):
        return np.sqrt((m.astype(np.float64) ** 2).sum(axis=1))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if scores.dtype == object:
        return np.asarray(sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i]))[:k], dtype=np.int64)
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


def local_best(q_ids, q, bounds, ids, v, k) -> Iterator[tuple[int, int, int]]:
    """(query place, vec_id, score) of every query's k best in one bucket that reach its bound."""
    v_length, q_length = lengths(v), lengths(q)  # those of v descending
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        reach = q_length * v_length[0]
        cosine = np.where(reach > 0, bounds / reach, np.where(bounds > 0, np.inf, -np.inf))
    cosine = np.where(np.isfinite(reach), cosine, -np.inf)  # beyond a float's range nothing is left out
    alive = np.flatnonzero(cosine <= 1 + SLACK)
    by_length = alive[cosine[alive] < COORDINATE_FROM]
    if len(by_length):  # rows are sorted by length: those long enough for some query are a prefix
        with np.errstate(divide="ignore", invalid="ignore"):
            need = np.nan_to_num(np.where(bounds[by_length] > 0, bounds[by_length] / q_length[by_length] * (1 - SLACK), 0.0))
        prefix = int(np.searchsorted(-v_length, -need.min(), side="right"))
        scores = products(q[by_length], v[:prefix])
        for i, row in zip(by_length, scores):
            yield from chosen(i, q_ids[i], bounds[i], ids[:prefix], row, k)
    for i in alive[cosine[alive] >= COORDINATE_FROM]:
        axis = int(np.argmax(np.abs(q[i])))
        along = float(q[i, axis]) / q_length[i]
        # a vector that reaches the bound has at least this cosine with the query, whatever its own length
        c = min(1.0, cosine[i]) * (1 - SLACK)
        spread = np.sqrt(max(0.0, 1 - along * along)) * np.sqrt(max(0.0, 1 - c * c)) + SLACK
        with np.errstate(divide="ignore", invalid="ignore"):
            place = np.where(v_length > 0, v[:, axis].astype(np.float64) / v_length, np.nan)
        if along < 0:
            near = np.flatnonzero(place <= along * c + spread)
        else:
            near = np.flatnonzero(place >= along * c - spread)
        if len(near):
            yield from chosen(i, q_ids[i], bounds[i], ids[near], products(q[i:i + 1], v[near])[0], k)


def chosen(i, own, bound, ids, scores, k) -> Iterator[tuple[int, int, int]]:
    ok = np.flatnonzero((ids != own) & (scores >= bound).astype(bool))
    for j in ok[best(scores[ok], ids[ok], k)]:
        yield int(i), int(ids[j]), int(scores[j])


def top_products(rows: DataFrame, queries: DataFrame, k: int = 5, scale: float = 256.0, id_column: str = "vec_id",
                 vector_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the k best of ``rows`` for each of ``queries`` (tables of ids and vectors)."""
    spark = rows.sparkSession
    buckets = staged(packed(scaled_vectors(rows, id_column, vector_column, scale), BUCKET), "buckets")
    blocks = packed(scaled_vectors(queries, id_column, vector_column, scale).distinct(), BLOCK)

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, q = unpack(row)
                ids, v = unpack(row, "top_")
                scores = products(q, v)
                bounds, reach = np.full(len(q), -np.inf), 0.0
                for i, own in enumerate(q_ids):
                    of = scores[i][ids != own]
                    if len(of) >= k:
                        bounds[i] = below(sorted(of.tolist())[-k] if of.dtype == object else int(np.partition(of, len(of) - k)[len(of) - k]))
                length = lengths(q)
                with np.errstate(divide="ignore", invalid="ignore"):  # the least length of a bucket's longest that matters
                    least = np.nan_to_num(np.where(bounds > 0, bounds / length, 0.0))
                reach = float(least.min())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["pack"]], pa.int64()), pa.array([row["dim"]], pa.int32()), pa.array([reach * (1 - SLACK)]),
                     pa.array([row["ids"]], pa.binary()), pa.array([row["numbers"]], pa.binary()), pa.array([bounds.astype("<f8").tobytes()], pa.binary())],
                    ["block", "dim", "least", "q_ids", "q_numbers", "bounds"])

    # the bucket of the longest vectors, one for each dimension
    longest = buckets.groupBy("dim").agg(F.max(F.struct("longest", "pack")).getField("pack").alias("pack"))
    top = (buckets.join(longest, ["dim", "pack"])
           .select("dim", F.col("ids").alias("top_ids"), F.col("numbers").alias("top_numbers")))
    bounded = staged(blocks.join(top, "dim").repartition(shuffle_partitions(spark), "pack")
                     .mapInArrow(bound, "block long, dim int, least double, q_ids binary, q_numbers binary, bounds binary"), "blocks")
    # every pair of a block and a bucket that may matter, by their numbers alone; blocks are salted, bucket numbers copied
    salts = shuffle_partitions(spark)
    pairs = (bounded.select("block", "dim", "least", F.pmod(F.xxhash64("block"), F.lit(salts)).alias("salt"))
             .join(buckets.select("pack", "dim", "longest", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")), ["dim", "salt"])
             .filter("longest >= least").select("block", "pack"))
    pairs = staged(pairs, "block-pairs")
    work = (pairs.join(buckets.select("pack", "dim", "ids", "numbers"), "pack")
            .join(bounded.select("block", "q_ids", "q_numbers", "bounds"), "block")
            .repartition(max(1, -(-pairs.count() // 16)), "block", "pack"))  # some 16 units to a task

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                q_ids, q = unpack(row, "q_")
                ids, v = unpack(row)
                bounds = np.frombuffer(row["bounds"], dtype="<f8")
                found = list(local_best(q_ids, q, bounds, ids, v, k))
                place = [row["block"] * BLOCK + x[0] for x in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place, pa.int64()), pa.array([int(q_ids[x[0]]) for x in found], pa.int64()),
                     pa.array([x[1] for x in found], pa.int64()), pa.array([sortable(x[2]) for x in found], pa.string())],
                    ["place", "query_id", "vec_id", "score"])

    local = work.mapInArrow(verify, "place long, query_id long, vec_id long, score string")
    order = Window.partitionBy("place").orderBy(F.col("score").desc(), "vec_id")
    return (local.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", number_column(F.col("score")).alias("score")))
