"""Synthetic minority rows between a row and one of its nearest minority neighbours."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillpoint.functions.lineage import stage
from tillpoint.functions.ordered import Ordered

BLOCK = 2_000  # rows of one block that answers
LANE = 20_000  # rows that ask one block in one task
MOST_CELLS = 1_000
MOST_BLOCKS = 20_000
CELL_SAMPLE = 16  # rows of the sample for each cell
SLICE = 500


def _closest(ids, a, nids, b, k: int) -> pd.DataFrame:
    """The k rows of b nearest to each row of a, never the row itself."""
    found = []
    for start in range(0, len(ids), SLICE):
        mine, x = ids[start:start + SLICE], a[start:start + SLICE]
        square = (x * x).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * x @ b.T
        square[mine[:, None] == nids[None, :]] = np.inf
        # the expanded square proposes a few more than k; the true distance of those decides
        take = min(2 * k + 8, square.shape[1])
        near = np.argpartition(square, take - 1, axis=1)[:, :take]
        dist = np.sqrt(((x[:, None, :] - b[near]) ** 2).sum(2))
        dist[nids[near] == mine[:, None]] = np.inf
        order = np.argsort(dist, axis=1, kind="stable")[:, :k]
        rows = np.arange(len(mine))[:, None]
        part = pd.DataFrame({"id": np.repeat(mine, order.shape[1]), "nid": nids[near][rows, order].ravel(),
                             "dist": dist[rows, order].ravel()})
        found.append(part[np.isfinite(part["dist"])])
    return pd.concat(found) if found else pd.DataFrame({"id": [], "nid": [], "dist": []})


def _matrix(pdf: pd.DataFrame) -> np.ndarray:
    return np.stack(pdf["x"].to_numpy())


def _split(x: np.ndarray, cells: int) -> list[tuple[int, float, int, int]]:
    """A tree of at most ``cells`` cells from a sample: (column, threshold, left, right) nodes, a leaf has column -1 and its cell at the left.

    A node is split where its sample varies most, so that both sides get their share of the cells.
    """
    nodes: list = [None]
    waiting, leaves = [(0, np.arange(len(x)), cells)], 0
    while waiting:
        at, rows, share = waiting.pop()
        mine = x[rows]
        column = int(mine.var(axis=0).argmax()) if share > 1 and len(rows) > 1 else -1
        values = np.sort(mine[:, column]) if column >= 0 else np.empty(0)
        if column < 0 or values[0] == values[-1]:
            nodes[at], leaves = (-1, 0.0, leaves, -1), leaves + 1
            continue
        left = share // 2
        threshold = values[min(max(len(values) * left // share, 1), len(values) - 1) - 1]
        if threshold == values[-1]:
            threshold = values[np.searchsorted(values, threshold) - 1]
        low = mine[:, column] <= threshold
        nodes[at] = (column, float(threshold), len(nodes), len(nodes) + 1)
        waiting += [(len(nodes), rows[low], left), (len(nodes) + 1, rows[~low], share - left)]
        nodes += [None, None]
    return nodes


def _cells(nodes: list[tuple[int, float, int, int]], x: np.ndarray) -> np.ndarray:
    """The cell of every row."""
    column, threshold, left, right = (np.array(v) for v in zip(*nodes))
    at = np.zeros(len(x), dtype="int64")
    while (column[at] >= 0).any():
        inner = column[at] >= 0
        goes_left = x[np.arange(len(x)), np.maximum(column[at], 0)] <= threshold[at]
        at = np.where(inner, np.where(goes_left, left[at], right[at]), at)
    return left[at].astype("int32")


def _place(nodes: list[tuple[int, float, int, int]]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(cell=_cells(nodes, _matrix(pdf)))

    return run


def _halves(x: np.ndarray, block: int) -> list[np.ndarray]:
    """Rows in blocks of at most ``block``, halved at the median of the column that varies most; copies are halved, too."""
    done, waiting = [], [np.arange(len(x))]
    while waiting:
        rows = waiting.pop()
        if len(rows) <= block:
            done.append(rows)
            continue
        order = rows[np.argpartition(x[rows, int(x[rows].var(axis=0).argmax())], len(rows) // 2)]
        waiting += [order[:len(rows) // 2], order[len(rows) // 2:]]
    return done


LOCATED = "id long, x array<double>, cell int, part int, sub int, bound double, nids array<long>, dists array<double>, low array<double>, high array<double>"


def _locate(k: int, block: int):
    """Blocks of one part of a cell, each searched within itself. A block's first row carries the ends of its box."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        x, ids, out = _matrix(part), part["id"].to_numpy(), []
        for sub, rows in enumerate(_halves(x, block)):
            mine = x[rows]
            found = _closest(ids[rows], mine, ids[rows], mine, k).groupby("id")[["nid", "dist"]].agg(list)
            lists = found.reindex(ids[rows])
            nids = [v if isinstance(v, list) else [] for v in lists["nid"]]
            dists = [v if isinstance(v, list) else [] for v in lists["dist"]]
            first = [i == 0 for i in range(len(rows))]
            out.append(pd.DataFrame({
                "id": ids[rows], "x": part["x"].to_numpy()[rows], "cell": part["cell"].to_numpy()[rows], "part": part["part"].to_numpy()[rows],
                "sub": np.int32(sub), "bound": [max(d) if len(d) == k else np.inf for d in dists], "nids": nids, "dists": dists,
                "low": [mine.min(axis=0) if f else None for f in first], "high": [mine.max(axis=0) if f else None for f in first]}))
        return pd.concat(out)

    return run


def _between(k: int):
    def search(asking: pd.DataFrame, answering: pd.DataFrame) -> pd.DataFrame:
        if asking.empty or answering.empty:
            return pd.DataFrame({"id": pd.Series(dtype="int64"), "nid": pd.Series(dtype="int64"), "dist": pd.Series(dtype="float64")})
        found = _closest(asking["id"].to_numpy(), _matrix(asking), answering["id"].to_numpy(), _matrix(answering), k)
        most = asking.set_index("id")["bound"].reindex(found["id"]).to_numpy()
        return found[found["dist"].to_numpy() <= most]

    return search


class _Boxes:
    """The blocks' boxes: which blocks may hold something nearer to a row than its bound."""

    def __init__(self, keys: list[tuple[int, int, int]], low: np.ndarray, high: np.ndarray):
        self.of, self.low, self.high = {k: i for i, k in enumerate(keys)}, low, high

    def asked(self, own: int, x: np.ndarray, bound: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(block, places of the rows that ask it) for rows of one block.

        Nothing in a box is nearer than the box; boxes too far from the rows' own box are ruled out for all of them at once.
        """
        gap = np.maximum(np.maximum(self.low - x.max(axis=0), x.min(axis=0) - self.high), 0.0)
        for other in np.flatnonzero((gap * gap).sum(axis=1) * (1 - 1e-9) < bound.max() ** 2):
            if other != own:
                away = np.maximum(np.maximum(self.low[other] - x, x - self.high[other]), 0.0)
                rows = np.flatnonzero((away * away).sum(axis=1) * (1 - 1e-9) < bound ** 2)
                if len(rows):
                    yield int(other), rows


def _each_block(pdf: pd.DataFrame, boxes: _Boxes) -> Iterator[tuple[int, np.ndarray]]:
    """(block, places of the batch's rows that ask it)."""
    own = np.array([boxes.of[k] for k in zip(pdf["cell"], pdf["part"], pdf["sub"])], dtype="int64")
    bound = pdf["bound"].to_numpy()
    for block in np.unique(own):
        mine = np.flatnonzero(own == block)
        if bound[mine].max() > 0:
            x = np.stack(pdf["x"].to_numpy()[mine])
            for other, rows in boxes.asked(block, x, bound[mine]):
                yield other, mine[rows]


def _counts(boxes: _Boxes):
    """How many rows ask each block."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(boxes.of), dtype="int64")
        for pdf in batches:
            for other, rows in _each_block(pdf, boxes):
                total[other] += len(rows)
        asked = np.flatnonzero(total)
        yield pd.DataFrame({"block": asked.astype("int32"), "n": total[asked]})

    return run


def _route(boxes: _Boxes, lanes: np.ndarray):
    """Send each row to the blocks that may hold something nearer than its bound, some thousand rows at a time."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, x, bound, lane = (pdf[c].to_numpy() for c in ("id", "x", "bound", "lane"))
            held, size = [], 0
            for other, rows in _each_block(pdf, boxes):
                held.append(pd.DataFrame({"id": ids[rows], "x": x[rows], "bound": bound[rows], "block": np.int32(other),
                                          "lane": (lane[rows] % lanes[other]).astype("int32")}))
                size += len(rows)
                if size >= BLOCK:
                    yield pd.concat(held)
                    held, size = [], 0
            if held:
                yield pd.concat(held)

    return run


def _nearest(candidates: DataFrame, k: int) -> DataFrame:
    """The k closest of each row's candidates, which are at most k per searched block."""
    order = Window.partitionBy("id").orderBy("dist", "nid")
    return candidates.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= k)


def nearest_neighbours(rows: DataFrame, size: int, k: int, seed: int, block: int = BLOCK, lane: int = LANE) -> DataFrame:
    """Exact k nearest neighbours among (id, x) rows: (id, nid, dist, _rank).

    A tree over a sample deals the rows to cells along the columns that vary most; a task halves its cell further into blocks, each
    within a box of its own. Each block is searched within itself first, which bounds every row's k-th distance. Then a row
    visits only the blocks whose boxes come nearer than that. A task sees one block and about one lane of askers, also where many
    rows are copies; the driver sees the sample (``CELL_SAMPLE`` rows a cell) and at most some ``MOST_BLOCKS`` boxes.
    """
    block = max(block, math.ceil(size / MOST_BLOCKS))
    wanted = min(MOST_CELLS, math.ceil(size / block))
    nodes: list = [(-1, 0.0, 0, -1)]
    if wanted > 1:
        drawn = rows.filter(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(size)) < wanted * CELL_SAMPLE)
        sample = [r["x"] for r in drawn.select("x").collect()]  # about CELL_SAMPLE rows for each of at most MOST_CELLS cells
        if sample:
            nodes = _split(np.array(sample), wanted)
    placed = rows.mapInPandas(_place(nodes), "id long, x array<double>, cell int")
    sizes = {r["cell"]: r["n"] for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per cell
    # a cell that holds far more than its share, as one of many copies does, is dealt to several tasks
    parts = F.lit(1)
    if sizes and max(sizes.values()) > 8 * block:
        parts = F.array(*[F.lit(math.ceil(sizes.get(cell, 1) / (8 * block))) for cell in range(max(sizes) + 1)])[F.col("cell")]
    dealt = placed.withColumn("part", F.pmod(F.xxhash64("id"), parts).cast("int"))
    located = stage(dealt.groupBy("cell", "part").applyInPandas(_locate(k, block), LOCATED))

    found = located.filter("low IS NOT NULL").select("cell", "part", "sub", "low", "high").collect()  # one row per block
    boxes = _Boxes([(r["cell"], r["part"], r["sub"]) for r in found], np.array([r["low"] for r in found]), np.array([r["high"] for r in found]))
    own = located.select("id", F.explode(F.arrays_zip("nids", "dists")).alias("e")).select("id", F.col("e.nids").alias("nid"), F.col("e.dists").alias("dist"))

    asking = located.select("id", "x", "cell", "part", "sub", "bound", F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 20)).cast("int").alias("lane"))
    asked = asking.mapInPandas(_counts(boxes), "block int, n long").groupBy("block").agg(F.sum("n").alias("n")).collect()  # one row per block
    lanes = np.zeros(len(found), dtype="int64")
    for r in asked:
        lanes[r["block"]] = math.ceil(r["n"] / lane)
    sent = asking.mapInPandas(_route(boxes, lanes), "id long, x array<double>, bound double, block int, lane int")
    many = rows.sparkSession.createDataFrame(
        [(*map(int, key), int(i), int(lanes[i])) for key, i in boxes.of.items() if lanes[i]], "cell int, part int, sub int, to_block int, lanes int")
    answering = located.select("id", "x", "cell", "part", "sub").join(many, ["cell", "part", "sub"]).select(
        "id", "x", "to_block", F.explode(F.sequence(F.lit(0), F.col("lanes") - 1)).alias("to_lane"))
    other = sent.groupBy("block", "lane").cogroup(answering.groupBy("to_block", "to_lane")).applyInPandas(_between(k), "id long, nid long, dist double")
    return _nearest(own.unionByName(other), k)


def _drawn(seed: int, *parts: str) -> Column:
    """A number in [0, 1) that depends on the named columns and the seed only."""
    return F.pmod(F.xxhash64(*[F.col(p) for p in parts], F.lit(seed)), F.lit(1_000_003)) / F.lit(1_000_003.0)


def oversample_minority(train: DataFrame, columns: list[str], label: str, key: str, seed: int, most_neighbours: int = 5,
                        block: int = BLOCK, limit: int | None = None) -> DataFrame:
    """The frame plus synthetic minority rows until both classes are equally frequent.

    Each synthetic row lies at a drawn point between a minority row and one of its nearest minority
    neighbours. Synthetic rows carry a null key. All draws are hashes of row and seed, so a retried
    task repeats them.
    """
    counts = {r[label]: r["n"] for r in train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) != 2:
        return train
    small = min(counts, key=lambda c: (counts[c], -c))
    size, missing = counts[small], abs(counts[0] - counts[1])
    if not missing:
        return train
    if size < 2:
        raise ValueError("oversampling needs at least two minority rows")
    k = min(most_neighbours, size - 1)

    ordered = Ordered.of(train.filter(F.col(label) == small), [], [F.xxhash64(F.col(key), F.lit(seed)), F.col(key)],
                         limit=limit)
    minority = stage(ordered.position("_id").result())
    points = minority.select(F.col("_id").alias("id"), F.array(*[F.col(c).cast("double") for c in columns]).alias("x"))
    near = nearest_neighbours(points, size, k, seed, block)
    available = near.groupBy("id").agg(F.collect_list(F.struct("_rank", "nid")).alias("_near"))  # at most k entries
    copies = F.lit(missing // size) + F.when(F.col("_id") <= missing % size, 1).otherwise(0)
    planned = minority.withColumn("_copy", F.explode(F.when(copies > 0, F.sequence(F.lit(1), copies.cast("int")))))
    planned = planned.join(available, F.col("_id") == F.col("id"))
    place = F.floor(_drawn(seed + 1, "_id", "_copy") * F.size("_near")).cast("int") + 1
    chosen = F.element_at(F.array_sort("_near"), place).getField("nid")
    base = planned.withColumn("_nid", chosen).withColumn("_u", _drawn(seed + 2, "_id", "_copy"))
    partner = minority.select(F.col("_id").alias("_nid"), *[F.col(c).alias(f"_n_{c}") for c in columns])
    between = {c: F.col(c) + F.col("_u") * (F.col(f"_n_{c}") - F.col(c)) for c in columns}
    synthetic = base.join(partner, "_nid").select(*[
        between[c].alias(c) if c in between
        else F.lit(None).cast(train.schema[c].dataType).alias(c) if c == key
        else F.col(c) for c in train.columns])
    return train.unionByName(synthetic)
