"""Hard-negative mining with an inverted multi-index.

Vectors of whole numbers floor(scale * x) are cut into two half-spaces, each with its codebook; the pair of nearest codes is a
vector's cell. For an anchor, a half's score with a code's vectors is at most (anchor half . centroid) + length of the anchor half x
radius of the code, and a product is at most the sum of its halves' bounds. The multi-sequence heap visits cells by descending
sum without listing all pairs of codes.

*Index.* The codebooks are fitted on a bounded sample (``SAMPLE_NUMBERS`` numbers, the rows of smallest hash); every row is
indexed. Rows are ordered by cell and cut into shards of ``SHARD`` rows, so a cell of any size is many shards. The directory of
radii (codes x 2) and of occupied cells (at most codes squared for each dimension) is sent to all tasks.

*Search*, once for the positives and once for the negatives. What the sample alone holds for an anchor is a bound that its answer
cannot fall below; the heap over the directory lists the cells that may hold better, and stops at the first sum below. An
anchor is sent, in one narrow row, to the shards of its cells, and a shard's rows once to each lane of ``LANE`` anchors. In the
shard the heap goes over its own cells, with its own radii, best first, and stops when the window is certified: when the next
sum is below what every wanted place holds already. Results are exact; the sample only decides how much is visited.

Scores of any size are exact (Python's integers beyond 64 bits), and travel as text that sorts like the numbers.

Rows with a null id, label or vector, or a null or non-finite component, take no part. Vectors meet those of their own
length, empty ones too. Rows that repeat an anchor's id are no other rows to it. Equal anchor rows are answered once; unequal
ones with one id each. Rows that repeat another id are candidates each. A score beyond 64 bits is null in the result, in its
right place. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.llm.common import (
    exact, matrices, number, number_column, salted_join, shuffle_partitions, sortable, staged, whole_vectors)

#: Numbers in the sample that codebooks and first bounds come from; rows in a shard; anchors that share one copy of a shard.
SAMPLE_NUMBERS, SHARD, LANE = 1_048_576, 4096, 100_000
#: Codes of a half: the fourth root of the number of rows, within these; the cells stay some sqrt(rows).
LEAST_CODES, MOST_CODES = 4, 256
#: Rounds of fitting the codebooks.
ROUNDS = 8
#: Relative slack of bounds in floating point.
SLACK = 1e-9


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of a vector with all rows: in floating point, 64 bits or Python's integers, as the numbers need."""
    if not a.size or not b.size:
        return np.zeros(len(b), dtype=np.int64)
    top = a.size * int(abs(a).max()) * int(abs(b).max())
    if top < 2 ** 53:
        return (b.astype(np.float64) @ a.astype(np.float64)).astype(np.int64)
    kind = np.int64 if top < 2 ** 63 else object
    return b.astype(kind) @ a.astype(kind)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(score, -id) of the k highest scores, ties to smaller ids."""
    if len(scores) > 4 * k and scores.dtype != object:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)
        scores, ids = scores[near], ids[near]
    return heapq.nlargest(k, zip(scores.tolist(), (-ids).tolist()))


def lengths(m: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        return np.nan_to_num(np.sqrt((m * m).sum(axis=1)), nan=np.inf, posinf=np.inf)


def fit(points: np.ndarray, codes: int) -> np.ndarray:
    """Centroids of ``points`` (a half of the sample): Lloyd's rounds from distinct points spread over the sample."""
    _, first = np.unique(points, axis=0, return_index=True)
    first = np.sort(first)
    centres = points[first[np.linspace(0, len(first) - 1, min(codes, len(first))).astype(int)]].copy()
    for _ in range(ROUNDS):
        own = nearest(points, centres)
        for c in range(len(centres)):
            if (own == c).any():
                centres[c] = points[own == c].mean(axis=0)
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        away = (centres * centres).sum(axis=1)[None, :] - 2 * (points @ centres.T)
    return np.nan_to_num(away, nan=np.inf).argmin(axis=1)


class Books:
    """Codebooks of both halves for each length of vectors; lengths that the sample lacks have one code at zero."""

    def __init__(self, sample: dict[int, np.ndarray], codes: int):
        self.halves = {dim: tuple(fit(h, codes) for h in (m[:, :dim // 2], m[:, dim // 2:])) for dim, m in sample.items()}

    def of(self, dim: int) -> tuple[np.ndarray, np.ndarray]:
        return self.halves.get(dim) or (np.zeros((1, dim // 2)), np.zeros((1, dim - dim // 2)))

    def cells(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Both codes of every row and the distances of its halves from them."""
        dim = m.shape[1]
        codes, away = [], []
        for half, centres in zip((m[:, :dim // 2], m[:, dim // 2:]), self.of(dim)):
            own = nearest(half, centres)
            codes.append(own)
            away.append(lengths(half - centres[own]))
        return codes[0] * MOST_CODES + codes[1], away[0], away[1]


class Cells:
    """Occupied cells with the radius of every code in use: what the heap needs."""

    def __init__(self, centres: tuple[np.ndarray, np.ndarray], cells: np.ndarray, first: np.ndarray, second: np.ndarray):
        """cells: codes of rows or cells; first, second: distances from the codes."""
        self.place = {int(c): i for i, c in enumerate(np.unique(cells))}
        self.codes, self.centres, self.radii = [], [], []
        for own, away, of in ((cells // MOST_CODES, first, centres[0]), (cells % MOST_CODES, second, centres[1])):
            used, at = np.unique(own, return_inverse=True)
            radius = np.zeros(len(used))
            np.maximum.at(radius, at, away)
            self.codes.append(used)
            self.centres.append(of[used])
            self.radii.append(radius)

    def visit(self, a: np.ndarray) -> Iterator[tuple[float, int]]:
        """(bound, place of the cell) of the occupied cells, highest bound first: the multi-sequence heap."""
        cut = len(a) // 2
        sides = []
        for half, codes, centres, radii in zip((a[:cut], a[cut:]), self.codes, self.centres, self.radii):
            with np.errstate(over="ignore", invalid="ignore"):
                near, length = centres @ half, float(lengths(half[None, :])[0])
                reach = length * (lengths(centres) + radii)
                bound = np.nan_to_num(near + length * radii + SLACK * reach, nan=np.inf, posinf=np.inf, neginf=-np.inf) + SLACK
            order = np.argsort(-bound, kind="stable")
            sides.append((bound[order].tolist(), codes[order].tolist()))
        (x, i_of), (y, j_of) = sides
        heap, seen = [(-(x[0] + y[0]), 0, 0)], {(0, 0)}
        while heap:
            below, i, j = heapq.heappop(heap)
            at = self.place.get(i_of[i] * MOST_CODES + j_of[j])
            if at is not None:
                yield -below, at
            for n in ((i + 1, j), (i, j + 1)):
                if n[0] < len(x) and n[1] < len(y) and n not in seen:
                    seen.add(n)
                    heapq.heappush(heap, (-(x[n[0]] + y[n[1]]), *n))


class Wanted:
    """The best ``k`` scores so far in one window of scores, and what a further score must reach."""

    def __init__(self, k: int, high: int | None, low: int | None):
        self.k, self.high, self.low, self.held = k, high, low, []

    @property
    def need(self) -> int | None:
        own = self.held[-1][0] if len(self.held) == self.k else None
        return own if self.low is None else self.low if own is None else max(own, self.low)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        ok = np.ones(len(scores), dtype=bool)
        if self.high is not None:
            ok &= (scores <= self.high).astype(bool)
        if self.need is not None:
            ok &= (scores >= self.need).astype(bool)
        if ok.any():
            self.held = heapq.nlargest(self.k, self.held + best(scores[ok], ids[ok], self.k))


def needed(wanted: list[Wanted]) -> int | None:
    """The least score that still matters to any window; None: all do."""
    needs = [w.need for w in wanted]
    return None if None in needs else min(needs)


class Rows:
    """Some rows of one length, by cell: ids, labels and numbers."""

    def __init__(self, books: Books, ids: np.ndarray, labels: np.ndarray, m: np.ndarray):
        cells, first, second = books.cells(m.astype(np.float64))
        order = np.argsort(cells, kind="stable")
        self.ids, self.labels, self.m = ids[order], labels[order], m[order]
        self.cells = Cells(books.of(m.shape[1]), cells, first, second)
        _, starts = np.unique(cells[order], return_index=True)
        self.bounds = np.append(starts, len(cells))

    def search(self, wanted: list[Wanted], a: np.ndarray, own: int, label: int, same: bool) -> None:
        """Cells best first, until no window can gain: every one is certified."""
        for bound, at in self.cells.visit(a.astype(np.float64)):
            need = needed(wanted)
            if need is not None and bound < need:
                return
            low, high = self.bounds[at], self.bounds[at + 1]
            fit = np.flatnonzero(((self.labels[low:high] == label) == same) & (self.ids[low:high] != own)) + low
            if len(fit):
                scores = products(a, self.m[fit])
                for w in wanted:
                    w.add(scores, self.ids[fit])


def tables(books: Books, ids: pa.Array, labels: pa.Array, vectors: pa.Array) -> dict[int, Rows]:
    """The rows by length of their vectors, ready to be searched."""
    ids, labels = ids.to_numpy(zero_copy_only=False), labels.to_numpy(zero_copy_only=False)
    return {dim: Rows(books, ids[at], labels[at], exact(m)) for dim, at, m in matrices(vectors)}


def _indexed(rows: DataFrame, books: Books) -> DataFrame:
    """rows (id, label, anchor, v) with cell, first and second: the cell and the distances from its codes."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, away = np.zeros(batch.num_rows, dtype=np.int64), np.zeros((2, batch.num_rows))
            for dim, at, m in matrices(batch.column("v")):
                found, away[0, at], away[1, at] = books.cells(m)
                cell[at] = found + dim * MOST_CODES * MOST_CODES
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(away[0]), pa.array(away[1])], [*batch.schema.names, "cell", "first", "second"])

    return rows.mapInArrow(place, "id long, label long, anchor boolean, v array<double>, cell long, first double, second double")


def _sharded(rows: DataFrame) -> DataFrame:
    """Rows in the order of their cells, with the number of their shard."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, seen = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            shard = base + np.arange(seen, seen + batch.num_rows) // SHARD
            seen += batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(shard), *batch.columns], ["shard", *batch.schema.names])

    order = ["cell", "id", "label"]
    ranged = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    return ranged.mapInArrow(cut, "shard long, id long, label long, anchor boolean, v array<double>, cell long, first double, second double")


def _searched(index: "Index", asked: DataFrame, k: int, same: bool) -> DataFrame:
    """(anchor, window, id, score) of the k best of every window in every shard that may hold one.

    asked: anchor, id, label, v, least (of the positives), windows (of the negatives).
    """

    def wanted_of(least: str | None, windows: list | None) -> list[Wanted]:
        if same:
            return [Wanted(k, None, number(least) if least else None)]
        return [Wanted(k, number(w["high"]), number(w["low"])) for w in windows]

    sample, directory = index.sample, index.directory

    def cells_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Bounds from the sample, and the cells that may hold better."""
        for batch in batches:
            rows = batch.to_pylist()
            cells, least, windows = [], [], []
            for r in rows:
                a = exact(np.asarray(r["v"], dtype=np.float64))
                wanted = wanted_of(r["least"], r["windows"])
                known = sample.value.get(len(a))
                if known is not None:
                    known.search(wanted, a, r["id"], r["label"], same)
                here = directory.value.get(len(a))
                need, own = needed(wanted), []
                if here is not None:
                    table, codes = here
                    for bound, at in table.visit(a.astype(np.float64)):
                        if need is not None and bound < need:
                            break
                        own.append(codes[at])
                cells.append(own)
                least.append(sortable(wanted[0].need) if same and wanted[0].need is not None else None)
                windows.append(None if same else [{"high": sortable(w.high), "low": sortable(w.need)} for w in wanted])
            kind = pa.list_(pa.struct([("high", pa.string()), ("low", pa.string())]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("anchor", "id", "label", "v")), pa.array(least, pa.string()), pa.array(windows, kind),
                 pa.array(cells, pa.list_(pa.int64()))], ["anchor", "id", "label", "v", "least", "windows", "cells"])

    spark, lanes = asked.sparkSession, max(1, -(-index.anchors // LANE))
    bounded = staged(asked.repartition(shuffle_partitions(spark), "anchor").mapInArrow(
        cells_of, "anchor long, id long, label long, v array<double>, least string, windows array<struct<high string, low string>>, cells array<long>"), "asked")
    visits = salted_join(bounded.select("anchor", F.explode("cells").alias("cell")), index.cells, ["cell"], by="anchor").select("anchor", "shard").distinct()
    lane = F.pmod("anchor", F.lit(lanes)).alias("lane")
    asks = visits.join(bounded.drop("cells"), "anchor").select(
        "shard", lane, F.lit(1).alias("kind"), F.lit(0).cast("long").alias("cell"), "id", "label", "v", "anchor", "least", "windows")
    null = lambda of: F.lit(None).cast(of)
    held = index.rows.join(visits.select("shard").distinct(), "shard", "left_semi").select(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))).alias("lane"), F.lit(0).alias("kind"), "cell", "id", "label", "v",
        null("long").alias("anchor"), null("string").alias("least"), null("array<struct<high string, low string>>").alias("windows"))
    books = index.books

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One shard after the other: first its rows (SHARD at most), then the anchors that visit it, one by one."""
        at, held, ready = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("shard", "lane", "kind")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            out = []
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                some, (shard, lane, kind) = batch.slice(low, high - low), keys[:, low].tolist()
                if (shard, lane) != at:
                    at, held, ready = (shard, lane), [], None
                if kind == 0:
                    held.append(some.select(["id", "label", "v"]))
                    continue
                if ready is None:
                    whole = pa.Table.from_batches(held).combine_chunks()
                    ready, held = tables(books.value, *(whole.column(c).chunk(0) for c in ("id", "label", "v"))), []
                for r in some.select(["anchor", "id", "label", "v", "least", "windows"]).to_pylist():
                    a = exact(np.asarray(r["v"], dtype=np.float64))
                    if len(a) in ready:
                        wanted = wanted_of(r["least"], r["windows"])
                        ready[len(a)].search(wanted, a, r["id"], r["label"], same)
                        out += [(r["anchor"], i, -x, sortable(s)) for i, w in enumerate(wanted) for s, x in w.held]
            if out:
                anchor, window, ids, scores = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(anchor, pa.int64()), pa.array(window, pa.int32()), pa.array(ids, pa.int64()), pa.array(scores, pa.string())],
                                                 ["anchor", "window", "id", "score"])

    work = (held.unionByName(asks).repartition(shuffle_partitions(spark), "shard", "lane")
            .sortWithinPartitions("shard", "lane", "kind", "cell"))
    return work.mapInArrow(search, "anchor long, window int, id long, score string")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "window").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


class Index:
    """Rows by cell in shards, with what every task gets: codebooks, directory and sample."""

    def __init__(self, rows: DataFrame, codes: int | None):
        spark = rows.sparkSession

        given = staged(rows, "whole-vectors")
        size = given.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim"), F.count(F.when(F.col("anchor"), 1)).alias("anchors")).first()
        self.anchors = size["anchors"]
        codes = codes or min(MOST_CODES, max(LEAST_CODES, round(size["n"] ** 0.25)))
        taken = given.orderBy(F.xxhash64("id", "v"), "id", "label").limit(max(1, SAMPLE_NUMBERS // max(1, size["dim"] or 1))).collect()
        ids, labels, vectors = (pa.array([r[c] for r in taken], kind) for c, kind in (("id", pa.int64()), ("label", pa.int64()), ("v", pa.list_(pa.float64()))))
        books = Books({dim: m for dim, _, m in matrices(vectors)}, codes)
        self.books = spark.sparkContext.broadcast(books)  # 2 x codes x half a vector
        self.sample = spark.sparkContext.broadcast(tables(books, ids, labels, vectors))
        self.rows = staged(_sharded(_indexed(given, books)), "shards")
        self.cells = staged(self.rows.groupBy("cell", "shard").agg(F.max("first").alias("first"), F.max("second").alias("second")), "cells")
        listed: dict[int, list] = {}
        for r in self.cells.groupBy("cell").agg(F.max("first").alias("first"), F.max("second").alias("second")).orderBy("cell").collect():
            listed.setdefault(r["cell"] // MOST_CODES ** 2, []).append(r)  # at most codes x codes for each length
        directory = {}
        for dim, of in listed.items():
            own = np.asarray([r["cell"] % MOST_CODES ** 2 for r in of])
            table = Cells(books.of(dim), own, np.asarray([r["first"] for r in of]), np.asarray([r["second"] for r in of]))
            directory[dim] = table, [r["cell"] for r in of]
        self.directory = spark.sparkContext.broadcast(directory)


def hard_negatives(rows: DataFrame, anchor: Column, label: Column, positives: int = 5, negatives: int = 5, lowest: int = 80, highest: int = 100,
                   whole: int = 100, scale: float = 256.0, id_column: str = "vec_id", vector_column: str = "embedding",
                   codes: int | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Anchors are the rows where ``anchor`` holds. An anchor's positives are its best rows of the same ``label``; the negatives of a
    pair are the best rows of other labels with lowest * positive <= whole * negative <= highest * positive.
    """
    usable = rows.select(F.col(id_column).cast("long").alias("id"), label.cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
                         whole_vectors(F.col(vector_column), scale).alias("v"))
    index = Index(usable.filter("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL"), codes)
    anchors = staged(index.rows.filter("anchor").select("id", "label", "v").distinct().withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    none = F.lit(None).cast("array<struct<high string, low string>>")
    near = _searched(index, anchors.withColumn("least", F.lit(None).cast("string")).withColumn("windows", none), positives, same=True)
    pairs = staged(_ranked(near, positives).select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("high")), "positives")

    def edges(scores):
        import pandas as pd

        def of(text: str) -> tuple[str, str] | None:
            p = number(text)
            low, high = -(-lowest * p // whole), highest * p // whole
            return (sortable(high), sortable(low)) if low <= high else None

        return pd.DataFrame([of(x) or (None, None) for x in scores], columns=["high", "low"])

    edge = F.pandas_udf(edges, "high string, low string")  # once for each pair of an anchor and a positive
    edged = staged(pairs.withColumn("edge", edge("high")).select("anchor", "positive_id", F.col("high").alias("score"), "edge.high", "edge.low")
                   .filter("high IS NOT NULL"), "windows")
    windows = edged.groupBy("anchor").agg(F.array_sort(F.collect_set(F.struct("high", "low"))).alias("windows"))
    asked = staged(anchors.join(windows, "anchor").withColumn("least", F.lit(None).cast("string")), "window-anchors")
    found = _ranked(_searched(index, asked, negatives, same=False), negatives)
    place = asked.select("anchor", F.col("id").alias("anchor_id"), F.posexplode("windows").alias("window", "w")).select("anchor", "anchor_id", "window", "w.high", "w.low")
    return (edged.join(place, ["anchor", "high", "low"]).join(found, ["anchor", "window"])
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), number_column(edged["score"]).alias("positive_score"),
                    number_column(found["score"]).alias("negative_score")))
