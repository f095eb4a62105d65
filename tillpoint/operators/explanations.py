"""Shapley values of boosted trees: how much each feature moved each customer's score.

A missing feature is averaged over its node's branches by the training weight that went each way (the path-dependent
expectation). For one leaf, the value a feature gets depends only on which of the path's features the customer satisfies.
A leaf's path holds few different features, so its values for all such patterns are one small table, and explaining a batch
of customers is a lookup in each leaf's table. Leaves with more than ``TABLE_FEATURES`` features work out just the patterns
that occur in the batch.

The driver holds the model's nodes, as Spark does; customers are explained batch by batch on the executors and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillpoint.functions.lineage import scratch_path
from tillpoint.operators.ml_prep import impute_median
from tillpoint.schemas import SEED

#: Features of a path up to which all patterns are tabulated: 2 ** features rows.
TABLE_FEATURES = 10
#: A boosted classifier's margin is half the log-odds of its probability.
LOG_ODDS = 2.0


@dataclass
class Leaf:
    """What leads to a leaf: its value, and for each feature on the way the weight share kept and the interval."""

    value: float
    features: list[int] = field(default_factory=list)
    share: list[float] = field(default_factory=list)
    above: list[float | None] = field(default_factory=list)
    upto: list[float | None] = field(default_factory=list)

    def then(self, feature: int, share: float, above: float | None, upto: float | None) -> "Leaf":
        """This path and one more split: the interval narrows, the shares of one feature multiply."""
        out = Leaf(self.value, *[list(x) for x in (self.features, self.share, self.above, self.upto)])
        if feature not in out.features:
            for x, v in ((out.features, feature), (out.share, 1.0), (out.above, None), (out.upto, None)):
                x.append(v)
        i = out.features.index(feature)
        out.share[i] *= share
        if above is not None:
            out.above[i] = above if out.above[i] is None else max(above, out.above[i])
        if upto is not None:
            out.upto[i] = upto if out.upto[i] is None else min(upto, out.upto[i])
        return out

    def values(self, holds: np.ndarray) -> np.ndarray:
        """Shapley values of the path's features for each row of 0/1: which features' intervals hold."""
        d = len(self.features)
        out = np.empty(holds.shape)
        for j in range(d):
            # coefficient k: over all sets of k other features, held ones inside and shares outside, added
            poly = np.ones((len(holds), 1))
            for i in range(d):
                if i != j:
                    grown = np.zeros((len(holds), poly.shape[1] + 1))
                    grown[:, :-1] += poly * self.share[i]
                    grown[:, 1:] += poly * holds[:, i:i + 1]
                    poly = grown
            weight = np.asarray([1.0 / (d * comb(d - 1, k)) for k in range(d)])
            out[:, j] = self.value * (holds[:, j] - self.share[j]) * (poly @ weight)
        return out

    def pattern(self, columns: np.ndarray) -> np.ndarray:
        """One bit for each feature of the path, of every customer. columns: features x customers."""
        bits = np.zeros(columns.shape[1], dtype=np.int64)
        for i, f in enumerate(self.features):
            holds = np.ones(columns.shape[1], dtype=bool)
            if self.upto[i] is not None:
                holds &= columns[f] <= self.upto[i]
            if self.above[i] is not None:
                holds &= ~(columns[f] <= self.above[i])
            bits |= holds.astype(np.int64) << i
        return bits

    def rows(self, patterns: np.ndarray) -> np.ndarray:
        return self.values(((patterns[:, None] >> np.arange(len(self.features))) & 1).astype(np.float64))


def tree_nodes(model) -> dict[int, dict]:
    """The nodes of each of a boosted model's trees, by number."""
    spark = SparkSession.active()
    path = scratch_path(spark, "trees")
    model.write().save(path)
    nodes: dict[int, dict] = {}
    for r in spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").toLocalIterator():
        nodes.setdefault(r["treeID"], {})[r["id"]] = r
    return nodes


def leaves(model) -> list[Leaf]:
    """All leaves of a boosted model's trees, weighted to add up to the log-odds of its probability."""
    out: list[Leaf] = []
    for tree, of in tree_nodes(model).items():
        stack = [(of[0], Leaf(0.0))]
        while stack:
            node, so_far = stack.pop()
            if node["leftChild"] < 0:
                so_far.value = LOG_ODDS * model.treeWeights[tree] * node["prediction"]
                out.append(so_far)
                continue
            split = node["split"]
            if split["numCategories"] != -1:
                raise ValueError("explanations need continuous features")
            at, f = split["leftCategoriesOrThreshold"][0], split["featureIndex"]
            left, right = of[node["leftChild"]], of[node["rightChild"]]
            total = left["impurityStats"][0] + right["impurityStats"][0]
            share = left["impurityStats"][0] / total if total else 0.5
            stack.append((left, so_far.then(f, share, None, at)))
            stack.append((right, so_far.then(f, 1.0 - share, at, None)))
    return out


def base_value(of: list[Leaf]) -> float:
    """The model's log-odds when no feature is known."""
    return float(sum(leaf.value * float(np.prod(leaf.share)) for leaf in of))


class Explainer:
    """The leaves with their tables."""

    def __init__(self, of: list[Leaf]):
        self.of = [(leaf, leaf.rows(np.arange(2 ** len(leaf.features))) if len(leaf.features) <= TABLE_FEATURES else None)
                   for leaf in of if leaf.features]

    def values(self, matrix: np.ndarray) -> np.ndarray:
        """Shapley values of a matrix of customers x features."""
        columns = np.ascontiguousarray(matrix.T)
        out = np.zeros(columns.shape)
        for leaf, table in self.of:
            at = leaf.pattern(columns)
            if table is None:
                patterns, at = np.unique(at, return_inverse=True)
                table = leaf.rows(patterns)
            for i, f in enumerate(leaf.features):
                out[f] += table[at, i]
        return out.T


def explain_customers(model: PipelineModel, features: DataFrame, max_samples: int | None = None, random_state: int = SEED) -> DataFrame:
    """One row per customer and feature: CustomerID, Feature, FeatureValue, Contribution, BaseValue and LogOdds.

    A customer's contributions and the base value add up to the log-odds of the churn probability. All customers of
    ``features`` are explained, or at most ``max_samples`` of them, chosen by hash, where that is given; a customer
    that stands there twice is explained twice. Missing values are the column's median, as in scoring.
    """
    columns = list(model.stages[0].getInputCols())
    ready = impute_median(features.select("CustomerID", *columns), columns)
    if max_samples is not None:
        ready = ready.orderBy(F.xxhash64("CustomerID", F.lit(random_state)), "CustomerID").limit(max_samples)
    of = leaves(model.stages[-1])
    shared, base, key = ready.sparkSession.sparkContext.broadcast(of), base_value(of), ready.schema["CustomerID"].dataType.simpleString()

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        explainer = None
        for batch in batches:
            if not batch.num_rows:
                continue
            explainer = explainer or Explainer(shared.value)
            found = explainer.values(batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, found.size + 1, found.shape[1]), pa.int32()), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "c"])

    margin = (vector_to_array("rawPrediction")[1] * LOG_ODDS).alias("LogOdds")
    scored = model.transform(ready).select("CustomerID", vector_to_array("features").alias("v"), margin)
    explained = scored.mapInArrow(explain, f"CustomerID {key}, v array<double>, LogOdds double, c array<double>")
    each = F.explode(F.arrays_zip(F.array(*[F.lit(c) for c in columns]).alias("f"), "v", "c")).alias("e")
    return explained.select("CustomerID", "LogOdds", each).select(
        "CustomerID", F.col("e.f").alias("Feature"), F.col("e.v").alias("FeatureValue"), F.col("e.c").alias("Contribution"),
        F.lit(base).alias("BaseValue"), "LogOdds")


def strongest_features(explained: DataFrame, per_customer: int = 3) -> DataFrame:
    """The features that moved a customer's score most, up or down: CustomerID, Rank, Feature, FeatureValue, Contribution.

    A customer's rows are few (one for each feature), so they are ranked within an array.
    """
    size: Column = -F.abs("Contribution")
    ranked = explained.groupBy("CustomerID").agg(F.array_sort(F.collect_list(
        F.struct(size.alias("s"), "Feature", "FeatureValue", "Contribution"))).alias("all"))
    first = ranked.select("CustomerID", F.posexplode(F.slice("all", 1, per_customer)).alias("at", "e"))
    return first.select("CustomerID", (F.col("at") + 1).alias("Rank"), "e.Feature", "e.FeatureValue", "e.Contribution")


def feature_effects(explained: DataFrame) -> DataFrame:
    """Mean size and mean of every feature's contributions, the strongest feature first."""
    return explained.groupBy("Feature").agg(
        F.avg(F.abs("Contribution")).alias("MeanAbsContribution"), F.avg("Contribution").alias("MeanContribution")).orderBy(
        F.desc("MeanAbsContribution"), "Feature")
