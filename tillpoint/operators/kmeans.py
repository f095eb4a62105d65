"""Many K-Means models fitted together: every scan of the matrix serves all starts of all K.

A start is k-means++: a row, or for every second seed a few rows, are drawn with weight D², the squared distance to the centres
so far, and the one that lowers the cost most is the next centre. Every row runs an exponential race, -log(u) / D², with u from a hash of its id, the
seed and the step; the least time wins. Races of all models are one scan, as are the costs with what was drawn, and the sums
and counts of a Lloyd step for all models that still move. A model stops when no
centre moves more than ``tolerance`` or after ``max_iter`` steps. The driver holds centres only (models x K x features).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Distances a task holds at once: rows of a batch x centres of all models.
AT_ONCE = 4_000_000


@dataclass
class CentreModel:
    """Centres of one K-Means model; ``features`` is an array of doubles, ``Segment`` the place of the nearest centre."""

    centres: np.ndarray
    cost: float = float("nan")
    #: Lloyd steps taken
    steps: int = 0

    def clusterCenters(self) -> list[np.ndarray]:
        return list(self.centres)

    def segment(self, features: Column) -> Column:
        """The nearest centre, the first of equally near ones."""
        away = [F.aggregate(F.zip_with(features, F.array(*[F.lit(float(x)) for x in c]), lambda a, b: (a - b) * (a - b)),
                            F.lit(0.0), lambda held, x: held + x) for c in self.centres]
        both = F.array(*away)
        return (F.array_position(both, F.array_min(both)) - 1).cast("int")

    def transform(self, vectors: DataFrame) -> DataFrame:
        return vectors.withColumn("Segment", self.segment(F.col("features")))

    def as_table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, [float(x) for x in c], float(self.cost), int(self.steps)) for i, c in enumerate(self.centres)]
        return spark.createDataFrame(rows, "Segment int, Centre array<double>, Cost double, Steps int")

    @classmethod
    def from_table(cls, table: DataFrame) -> "CentreModel":
        rows = table.orderBy("Segment").collect()  # one row for each centre
        return cls(np.asarray([r["Centre"] for r in rows]), rows[0]["Cost"], rows[0]["Steps"])


Work = tuple[Callable[[np.ndarray, np.ndarray], None], Callable[[], pa.RecordBatch | None]]


def _scan(vectors: DataFrame, make: Callable[[], Work], schema: str) -> DataFrame:
    """What each task has in the end: ``make`` gives it what to do with every batch (hashes, matrix), and then the result."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, done = make()
        for batch in batches:
            if batch.num_rows:
                work(batch.column("h").to_numpy(), batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1))
        out = done()
        if out is not None:
            yield out

    return vectors.select("h", "features").mapInArrow(scan, schema)


def _pieces(m: np.ndarray, centres: int) -> Iterator[slice]:
    step = max(1, AT_ONCE // max(1, centres))
    for at in range(0, len(m), step):
        yield slice(at, at + step)


def distances(m: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of all rows from all centres."""
    return np.maximum((m * m).sum(axis=1)[:, None] - 2 * (m @ centres.T) + (centres * centres).sum(axis=1)[None, :], 0.0)


def uniform(hashes: np.ndarray, seed: int, step: int) -> np.ndarray:
    """A number in (0, 1) for each row, seed and step."""
    x = hashes.view(np.uint64) + np.uint64((seed * 1_000_003 + step * 7_919 + 1) * 0x9E3779B97F4A7C15 % 2 ** 64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):  # the finaliser of splitmix64; fixed values
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53


def tries(k: int, seed: int) -> int:
    """Rows drawn for each centre of a start of ``k``, of which the one that lowers the cost most is taken: one for even seeds, so starts differ."""
    return 2 + int(np.log(k)) if seed % 2 else 1


def first_centres(vectors: DataFrame, sizes: list[int], seeds: list[int]) -> list[np.ndarray]:
    """k-means++ starts for models of ``sizes`` centres, two scans for each step; fewer centres where rows repeat."""
    models: list[list[np.ndarray]] = [[] for _ in sizes]
    for step in range(max(sizes)):
        waiting = [i for i, k in enumerate(sizes) if k > step and len(models[i]) == step]
        if not waiting:
            break
        drawn = _drawn(vectors, {i: np.asarray(models[i]) for i in waiting}, sizes, seeds, step)
        if not drawn:
            break
        if step == 0:
            chosen = {i: c[0] for i, c in drawn.items()}
        else:
            left = _costs_with(vectors, {i: np.asarray(models[i]) for i in drawn}, drawn)
            chosen = {i: c[int(np.argmin(left[i]))] for i, c in drawn.items()}
        for i, x in chosen.items():
            models[i].append(x)
    return [np.asarray(of) for of in models]


def _drawn(vectors: DataFrame, so_far: dict[int, np.ndarray], sizes: list[int], seeds: list[int], step: int) -> dict[int, list[np.ndarray]]:
    """For each model the rows that win its races."""

    def race() -> Work:
        least: dict[tuple[int, int], tuple[float, int, list]] = {}

        def work(hashes: np.ndarray, m: np.ndarray) -> None:
            for at in _pieces(m, step or 1):
                scale = (m[at] * m[at]).sum(axis=1)
                for i, centres in so_far.items():
                    d = distances(m[at], centres).min(axis=1) if step else np.ones(len(m[at]))
                    away = d > 1e-12 * (1 + scale)  # rows on a centre (but for rounding) never win
                    for n in range(tries(sizes[i], seeds[i]) if step else 1):
                        u = uniform(hashes[at], seeds[i], step * 100 + n)
                        time = np.where(away, -np.log(u) / np.where(away, d, 1.0), np.inf)
                        j = int(time.argmin())
                        if np.isfinite(time[j]):
                            mine = float(time[j]), int(hashes[at][j]), m[at][j].tolist()
                            least[i, n] = min(least.get((i, n), mine), mine)

        def done() -> pa.RecordBatch | None:
            if not least:
                return None
            rows = [(*key, *x) for key, x in sorted(least.items())]
            kinds = (pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.list_(pa.float64()))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["model", "try", "time", "h", "x"])

        return work, done

    won = _scan(vectors, race, "model int, try int, time double, h long, x array<double>")
    out: dict[int, list[np.ndarray]] = {}
    for r in won.groupBy("model", "try").agg(F.min_by("x", F.struct("time", "h")).alias("x")).orderBy("model", "try").collect():  # a few a model
        out.setdefault(r["model"], []).append(np.asarray(r["x"]))
    return out


def _costs_with(vectors: DataFrame, so_far: dict[int, np.ndarray], drawn: dict[int, list[np.ndarray]]) -> dict[int, np.ndarray]:
    """Each model's cost with each of the rows drawn for it as one more centre."""
    together = np.asarray([x for of in drawn.values() for x in of])
    ends = np.cumsum([0, *(len(of) for of in drawn.values())])

    def measure() -> Work:
        cost = np.zeros(len(together))

        def work(_, m: np.ndarray) -> None:
            for at in _pieces(m, len(together)):
                new = distances(m[at], together)
                for i, low, high in zip(drawn, ends, ends[1:]):
                    now = distances(m[at], so_far[i]).min(axis=1)
                    cost[low:high] += np.minimum(new[:, low:high], now[:, None]).sum(axis=0)

        return work, lambda: pa.RecordBatch.from_arrays([pa.array(np.arange(len(together))), pa.array(cost)], ["c", "cost"])

    told = _scan(vectors, measure, "c long, cost double").groupBy("c").agg(F.sum("cost").alias("cost")).collect()
    cost = np.zeros(len(together))
    for r in told:
        cost[r["c"]] = r["cost"]
    return {i: cost[low:high] for i, low, high in zip(drawn, ends, ends[1:])}


def lloyd_sums(vectors: DataFrame, models: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, float]]:
    """For each model the counts, sums and sums of squared lengths of its clusters, and its cost: one scan for all."""
    if not models:
        return {}
    order, together = list(models), np.concatenate(list(models.values()))
    ends = np.cumsum([0, *(len(models[i]) for i in order)])

    def step() -> Work:
        n, sums, squares, cost = np.zeros(len(together)), np.zeros(together.shape), np.zeros(len(together)), np.zeros(len(order))

        def work(_, m: np.ndarray) -> None:
            for at in _pieces(m, len(together)):
                away, length = distances(m[at], together), (m[at] * m[at]).sum(axis=1)
                for place, (low, high) in enumerate(zip(ends, ends[1:])):
                    own = away[:, low:high].argmin(axis=1)
                    cost[place] += away[np.arange(len(own)), low + own].sum()
                    member = np.zeros((high - low, len(own)))
                    member[own, np.arange(len(own))] = 1.0
                    n[low:high] += member.sum(axis=1)
                    sums[low:high] += member @ m[at]
                    squares[low:high] += member @ length

        def done() -> pa.RecordBatch:
            at_first = np.zeros(len(together))  # a model's cost stands with its first centre
            at_first[ends[:-1]] = cost
            return pa.RecordBatch.from_arrays([pa.array(np.arange(len(together))), pa.array(n), pa.array(sums.tolist(), pa.list_(pa.float64())),
                                               pa.array(squares), pa.array(at_first)], ["c", "n", "s", "q", "cost"])

        return work, done

    told = _scan(vectors, step, "c long, n double, s array<double>, q double, cost double")
    width = together.shape[1]
    added = told.groupBy("c").agg(F.sum("n").alias("n"), F.sum("q").alias("q"), F.sum("cost").alias("cost"),
                                  F.array(*[F.sum(F.col("s")[d]) for d in range(width)]).alias("s")).collect()  # one row a centre
    n, sums, squares, cost = np.zeros(len(together)), np.zeros(together.shape), np.zeros(len(together)), np.zeros(len(together))
    for r in added:
        n[r["c"]], sums[r["c"]], squares[r["c"]], cost[r["c"]] = r["n"], r["s"], r["q"], r["cost"]
    return {i: (n[a:b], sums[a:b], squares[a:b], float(cost[a:b].sum())) for i, a, b in zip(order, ends, ends[1:])}


def fit_all(vectors: DataFrame, sizes: list[int], seeds: list[int], max_iter: int = 300, tolerance: float = 1e-4) -> list[CentreModel]:
    """A model of each of ``sizes`` centres from each seed. vectors: h (a hash that tells rows apart) and features."""
    found = [CentreModel(c) for c in first_centres(vectors, sizes, seeds)]
    moving = {i: m.centres for i, m in enumerate(found) if len(m.centres)}
    for step in range(max_iter):
        if not moving:
            break
        for i, (n, sums, _, _) in lloyd_sums(vectors, moving).items():
            new = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], moving[i])
            moved = ((new - moving[i]) ** 2).sum(axis=1).max()
            found[i].centres, found[i].steps = new, step + 1
            if moved <= tolerance ** 2:
                del moving[i]
            else:
                moving[i] = new
    for i, (_, _, _, cost) in lloyd_sums(vectors, {i: m.centres for i, m in enumerate(found) if len(m.centres)}).items():
        found[i].cost = cost
    return found


def cheapest(models: list[CentreModel]) -> CentreModel:
    """The least cost; the first of equal ones."""
    return min(models, key=lambda m: m.cost)


def silhouettes(vectors: DataFrame, models: list[CentreModel]) -> list[float]:
    """Mean squared-Euclidean silhouette of each model, all in two scans; -1 for a model with fewer than two clusters.

    The mean squared distance from a row to a cluster follows from the cluster's size, sum and sum of squared lengths.
    """
    if not all(len(m.centres) for m in models):  # a table without rows
        return [-1.0] * len(models)
    stats = lloyd_sums(vectors, {i: m.centres for i, m in enumerate(models)})
    full = {i: n > 0 for i, (n, *_) in stats.items()}

    def judge() -> Work:
        total, rows = np.zeros(len(models)), [0]

        def work(_, m: np.ndarray) -> None:
            rows[0] += len(m)
            for at in _pieces(m, sum(len(x.centres) for x in models)):
                length = (m[at] * m[at]).sum(axis=1)
                for i, model in enumerate(models):
                    n, sums, squares, _ = stats[i]
                    own = distances(m[at], model.centres).argmin(axis=1)
                    size = np.maximum(n, 1)
                    mean = np.maximum(length[:, None] + squares / size - 2 * (m[at] @ sums.T) / size, 0.0)
                    at_own = np.arange(len(own)), own
                    inner = mean[at_own] * n[own] / np.maximum(n[own] - 1, 1)
                    mean[at_own] = np.inf
                    mean[:, ~full[i]] = np.inf
                    outer = mean.min(axis=1)
                    with np.errstate(invalid="ignore", divide="ignore"):
                        s = (outer - inner) / np.maximum(outer, inner)
                    total[i] += np.where((n[own] > 1) & np.isfinite(s), s, 0.0).sum()

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.arange(len(models))), pa.array(total), pa.array([rows[0]] * len(models), pa.int64())], ["m", "t", "n"])

        return work, done

    told = _scan(vectors, judge, "m long, t double, n long").groupBy("m").agg((F.sum("t") / F.sum("n")).alias("s")).collect()
    mean = {r["m"]: r["s"] for r in told}
    return [mean.get(i, -1.0) if full[i].sum() > 1 else -1.0 for i in range(len(models))]
