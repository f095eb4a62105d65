"""Feature preparation: correlated features, imputation, scaling and summaries.

Statistics of a column set are one aggregation, and only that one row (bounded by the number
of features) reaches the driver, where it becomes literals of the next projection.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, functions as F

from tillpoint.functions.quantiles import quantiles
from tillpoint.functions.stats import number, numeric_columns

PAIRS_PER_JOB = 200


def finite(c: Column) -> Column:
    """Value as double; NaN and infinities become null."""
    d = number(c)
    return F.when(~F.isnan(d) & (F.abs(d) != F.lit(float("inf"))), d)


def _one_row(df: DataFrame, expressions: list[Column]) -> dict:
    return df.agg(*expressions).first().asDict() if expressions else {}


def _pearson(a: Column, b: Column) -> Column:
    """Correlation over rows with both values; null where either does not vary (``corr`` would raise under ANSI)."""
    spread = F.stddev_pop(F.when(b.isNotNull(), a)) * F.stddev_pop(F.when(a.isNotNull(), b))
    return F.try_divide(F.covar_pop(a, b), spread)


def correlations(df: DataFrame, columns: list[str]) -> dict[tuple[str, str], float]:
    """Pearson correlation per column pair over rows where both are present.

    Complete columns go through one distributed covariance; pairs with gaps are pairwise aggregates.
    """
    gaps = _one_row(df, [F.sum(F.when(number(F.col(c)).isNull() | F.isnan(number(F.col(c))), 1).otherwise(0)).alias(c) for c in columns])
    full = [c for c in columns if not gaps[c]]
    out: dict[tuple[str, str], float] = {}
    if len(full) > 1:
        assembled = VectorAssembler(inputCols=full, outputCol="_v").transform(df.select(*[number(F.col(c)).alias(c) for c in full]))
        matrix = Correlation.corr(assembled.select("_v"), "_v").first()[0].toArray()
        for i, j in combinations(range(len(full)), 2):
            out[(full[i], full[j])] = float(matrix[i, j])
    rest = [(a, b) for a, b in combinations(columns, 2) if gaps[a] or gaps[b]]
    for start in range(0, len(rest), PAIRS_PER_JOB):
        part = rest[start:start + PAIRS_PER_JOB]
        clean = df.select(*[finite(F.col(c)).alias(c) for c in columns])
        row = _one_row(clean, [_pearson(F.col(a), F.col(b)).alias(f"p{i}") for i, (a, b) in enumerate(part)])
        for i, pair in enumerate(part):
            out[pair] = float("nan") if row[f"p{i}"] is None else row[f"p{i}"]
    return out


def identify_highly_correlated_features(df: DataFrame, threshold: float = 0.95) -> list[str]:
    """Features with |r| above the threshold to any earlier feature, dropped or not."""
    columns = numeric_columns(df, exclude=["CustomerID"])
    if len(columns) < 2:
        return []
    r = correlations(df, columns)
    place = {c: i for i, c in enumerate(columns)}
    doomed = {max(pair, key=place.get) for pair, value in r.items() if not math.isnan(value) and abs(value) > threshold}
    return [c for c in columns if c in doomed]


def remove_highly_correlated_features(df: DataFrame, threshold: float = 0.95) -> DataFrame:
    return df.drop(*identify_highly_correlated_features(df, threshold))


def impute_median(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing and infinite values become the column's exact median; a column without values becomes 0."""
    if not columns:
        return df
    gaps = _one_row(df, [F.sum(F.when(finite(F.col(c)).isNull(), 1).otherwise(0)).alias(c) for c in columns])
    holed = [c for c in columns if gaps[c]]
    medians = quantiles(df, [], holed).first().asDict() if holed else {}
    fill = {c: F.coalesce(finite(F.col(c)), F.lit(medians.get(c)).cast("double"), F.lit(0.0)) for c in holed}
    return df.select(*[
        fill.get(c, number(F.col(c))).alias(c) if c in columns else F.col(c) for c in df.columns])


@dataclass
class Scaler:
    """Means and population standard deviations; a constant column scales to 0."""

    columns: list[str]
    means: dict[str, float] = field(default_factory=dict)
    deviations: dict[str, float] = field(default_factory=dict)

    @classmethod
    def fit(cls, df: DataFrame, columns: list[str]) -> "Scaler":
        row = _one_row(df, [F.avg(number(F.col(c))).alias(f"m_{c}") for c in columns]
                       + [F.stddev_pop(number(F.col(c))).alias(f"s_{c}") for c in columns])
        return cls(list(columns), {c: row[f"m_{c}"] for c in columns}, {c: row[f"s_{c}"] for c in columns})

    def transform(self, df: DataFrame) -> DataFrame:
        def scaled(c: str) -> Column:
            return (number(F.col(c)) - F.lit(self.means[c])) / F.lit(self.deviations[c] or 1.0)

        return df.select(*[scaled(c).alias(c) if c in self.columns else F.col(c) for c in df.columns])

    def as_table(self, spark) -> DataFrame:
        rows = [(c, self.means[c], self.deviations[c], i) for i, c in enumerate(self.columns)]
        return spark.createDataFrame(rows, "Feature string, Mean double, Deviation double, Place int")

    @classmethod
    def from_table(cls, table: DataFrame) -> "Scaler":
        rows = table.orderBy("Place").collect()  # one row for each feature
        return cls([r["Feature"] for r in rows], {r["Feature"]: r["Mean"] for r in rows}, {r["Feature"]: r["Deviation"] for r in rows})


def scale_features(df: DataFrame, exclude_columns: list[str] | None = None, scaler: Scaler | None = None):
    """(frame with numeric columns as z-scores, scaler). Excluded and non-numeric columns stay as they are."""
    columns = numeric_columns(df, exclude=["CustomerID"] if exclude_columns is None else exclude_columns)
    if not columns:
        return df, None
    filled = impute_median(df, columns)
    scaler = scaler or Scaler.fit(filled, columns)
    return scaler.transform(filled), scaler


def prepare_features_for_ml(df: DataFrame, target_column: str | None = None, remove_correlated: bool = True,
                            scale_features_flag: bool = True, exclude_from_scaling: list[str] | None = None) -> dict:
    """Features (and target, keyed by CustomerID) ready for a model, with the scaler and names used."""
    out: dict = {}
    if target_column and target_column in df.columns:
        keep = [c for c in ("CustomerID",) if c in df.columns]
        out["target"] = df.select(*keep, target_column)
        df = df.drop(target_column)
    if remove_correlated:
        df = remove_highly_correlated_features(df)
    if scale_features_flag:
        df, out["scaler"] = scale_features(df, exclude_from_scaling or ["CustomerID"])
    out["features"] = df
    out["feature_names"] = [c for c in df.columns if c != "CustomerID"]
    return out


def get_feature_summary(df: DataFrame, exclude: tuple[str, ...] = ("CustomerID",)) -> DataFrame:
    """Mean, sample deviation, range and missing share per numeric column, by name."""
    columns = numeric_columns(df, exclude)
    measures = {
        "Mean": F.avg, "Std": F.stddev_samp, "Min": F.min, "Max": F.max,
        "Missing": lambda c: F.sum(F.when(c.isNull() | F.isnan(c), 1.0).otherwise(0.0)),
        "Rows": lambda c: F.count(F.lit(1)).cast("double"),
    }
    wide = df.agg(*[
        F.struct(*[f(number(F.col(c))).alias(n) for n, f in measures.items()]).alias(c) for c in columns])
    long = wide.unpivot([], columns, "Feature", "s")
    return long.select(
        "Feature", "s.Mean", "s.Std", "s.Min", "s.Max", F.col("s.Missing").cast("bigint").alias("Missing"),
        (F.try_divide("s.Missing", "s.Rows") * 100).alias("MissingPct")).orderBy("Feature")
