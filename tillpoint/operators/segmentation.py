"""Customer segments: feature choice, K-Means, profiles and names. Labels travel by CustomerID."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.ml.feature import PCA, PCAModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillpoint.functions.lineage import stage
from tillpoint.functions.quantiles import quantiles
from tillpoint.functions.stats import mean, number, numeric_columns
from tillpoint.operators.kmeans import CentreModel, cheapest, fit_all, silhouettes
from tillpoint.operators.ml_prep import Scaler, impute_median
from tillpoint.schemas import SEED

# Feature groups a segmentation can draw on.
FEATURE_GROUPS = {
    "rfm": ["Recency", "Frequency", "TotalSpend", "TotalSpend_x", "TotalSpend_y", "RecencyScore", "FrequencyScore",
            "MonetaryScore", "RFMScore", "LifetimeValue", "AvgTransactionValue", "CustomerLifetime"],
    "loyalty": ["CurrentPointsBalance", "TotalPointsEarned", "RedemptionRate", "TierNumeric", "DaysSinceEnrollment",
                "PointsPerDollarRatio", "TierChanges"],
    "engagement": ["DaysActive", "ActiveMonths", "UniqueProducts", "UniqueCategories", "AvgBasketSize",
                   "PurchaseVelocity", "ProductDiversity"],
    "behavioral": ["FrequencyTrend", "SpendingTrend", "BasketSizeTrend", "RecentFrequency", "RecentSpend",
                   "HistoricalFrequency", "HistoricalSpend"],
    "seasonal": ["HolidayActivityRatio", "PreferredQuarter"],
    "frequency": ["Frequency_30d", "Frequency_60d", "Frequency_90d", "Frequency_365d",
                  "Spend_30d", "Spend_60d", "Spend_90d", "Spend_365d"],
}
DEFAULT_GROUPS = ("rfm", "loyalty", "engagement", "behavioral")


def select_features_for_clustering(features: DataFrame, feature_types=DEFAULT_GROUPS,
                                   exclude_columns: list[str] | None = None) -> DataFrame:
    """CustomerID and the numeric columns of the named groups that exist."""
    excluded = {"CustomerID"} if exclude_columns is None else set(exclude_columns)
    numeric = set(numeric_columns(features))
    wanted = [c for group in feature_types for c in FEATURE_GROUPS.get(group, [])]
    chosen = [c for c in wanted if c in numeric and c not in excluded]
    if not chosen:
        raise ValueError("none of the requested feature groups has a numeric column")
    return features.select("CustomerID", *chosen)


def prepare_features_for_clustering(features: DataFrame, use_pca: bool = False, pca_variance: float = 0.95):
    """(CustomerID with scaled columns or PC1..PCk, scaler, PCA model or None)."""
    columns = [c for c in features.columns if c != "CustomerID"]
    filled = impute_median(features, columns)
    scaler = Scaler.fit(filled, columns)
    scaled = scaler.transform(filled)
    if not use_pca:
        return scaled, scaler, None
    assembled = VectorAssembler(inputCols=columns, outputCol="_v").transform(scaled)
    model = PCA(k=len(columns), inputCol="_v", outputCol="_pc").fit(assembled)
    kept, explained = 0, 0.0
    for share in model.explainedVariance.toArray():
        kept, explained = kept + 1, explained + float(share)
        if explained > pca_variance:
            break
    return _reduced(scaled, columns, model, kept), scaler, model


def _reduced(scaled: DataFrame, columns: list[str], model: PCAModel, kept: int) -> DataFrame:
    """CustomerID and the first ``kept`` components."""
    assembled = VectorAssembler(inputCols=columns, outputCol="_v").transform(scaled)
    parts = vector_to_array(F.col("_pc"))
    return model.transform(assembled).select("CustomerID", *[parts[i].alias(f"PC{i + 1}") for i in range(kept)])


def _vectors(prepared: DataFrame) -> DataFrame:
    """The matrix every scan reads: CustomerID (where there is one), h and features; staged once, kept in memory where it fits.

    Rows are placed by CustomerID, so a seed gives the same start, and so the same labels, every time.
    """
    columns = [c for c in prepared.columns if c != "CustomerID"]
    keys = [c for c in prepared.columns if c == "CustomerID"]
    narrow = prepared.select(*keys, F.xxhash64(*(keys or columns)).alias("h"), F.array(*[number(F.col(c)) for c in columns]).alias("features"))
    if keys:
        narrow = narrow.repartition(*keys).sortWithinPartitions(*keys)
    return stage(narrow).persist()


def find_optimal_k_clusters(prepared: DataFrame, k_range=range(3, 9), random_state: int = SEED, n_init: int = 10,
                            max_iter: int = 300) -> DataFrame:
    """Inertia and silhouette per K; IsBest marks the best silhouette, the smaller K on a tie.

    All starts of all K are fitted together. The silhouette is the squared-Euclidean one, which is linear in the rows.
    """
    vectors = _vectors(prepared)
    sizes = list(k_range)
    found = fit_all(vectors, [k for k in sizes for _ in range(n_init)], [random_state + i for _ in sizes for i in range(n_init)], max_iter)
    models = [cheapest(found[i * n_init:(i + 1) * n_init]) for i in range(len(sizes))]
    rows = [(k, float(m.cost), float(s)) for k, m, s in zip(sizes, models, silhouettes(vectors, models))]
    vectors.unpersist()
    best = max(rows, key=lambda r: (r[2], -r[0]))[0]
    return prepared.sparkSession.createDataFrame(
        [(k, cost, s, k == best) for k, cost, s in rows], "K int, WCSS double, Silhouette double, IsBest boolean")


def perform_kmeans_clustering(prepared: DataFrame, n_clusters: int = 5, random_state: int = SEED, max_iter: int = 300,
                              n_init: int = 10):
    """(model, labels by CustomerID): the cheapest of ``n_init`` starts, fitted together."""
    vectors = _vectors(prepared)
    model = cheapest(fit_all(vectors, [n_clusters] * n_init, [random_state + i for i in range(n_init)], max_iter))
    labels = stage(model.transform(vectors).drop("features", "h"))
    vectors.unpersist()
    return model, labels


# Statistics of a profile and the averages a segment is named by.
PROFILE_STATISTICS = ["mean", "median", "std", "min", "max", "count"]
KEY_AVERAGES = {"AvgRecency": "Recency", "AvgFrequency": "Frequency", "AvgTotalSpend": "TotalSpend",
                "AvgLifetimeValue": "LifetimeValue", "AvgPointsBalance": "CurrentPointsBalance", "AvgTier": "TierNumeric"}


def key_averages(joined: DataFrame) -> list[Column]:
    return [mean(F.col(c)).alias(n) for n, c in KEY_AVERAGES.items() if c in joined.columns]


def profile_segments(features: DataFrame, labels: DataFrame, limit: int | None = None) -> DataFrame:
    """One row per segment: six statistics per numeric feature, size, share and key averages."""
    joined = stage(features.join(labels.select("CustomerID", "Segment"), "CustomerID"))
    columns = numeric_columns(features, exclude=["CustomerID", "Segment"])
    measures = {"mean": lambda c: mean(c), "std": lambda c: F.stddev_samp(number(c)),
                "min": lambda c: number(F.min(c)), "max": lambda c: number(F.max(c)), "count": F.count}
    stats = joined.groupBy("Segment").agg(
        *[f(F.col(c)).alias(f"{c}_{n}") for c in columns for n, f in measures.items()],
        F.count(F.lit(1)).alias("SegmentSize"), *key_averages(joined))
    medians = quantiles(joined, ["Segment"], columns, 0.5, limit)
    medians = medians.select(F.col("Segment").alias("_of"), *[F.col(c).alias(f"{c}_median") for c in columns])
    whole = labels.agg(F.count(F.lit(1)).alias("n")).scalar()
    rounded = [
        F.col(f"{c}_{n}") if n == "count" else F.bround(f"{c}_{n}", 2).alias(f"{c}_{n}")
        for c in columns for n in PROFILE_STATISTICS]
    share = F.bround(F.col("SegmentSize") / whole * 100, 2).alias("SegmentPercentage")
    averages = [n for n, c in KEY_AVERAGES.items() if c in joined.columns]
    return stats.join(medians, F.col("Segment").eqNullSafe(F.col("_of")), "left").select("Segment", *rounded, "SegmentSize", share, *averages)


def profile_rows(profiles: DataFrame) -> DataFrame:
    """Profiles in long form: (Segment, Feature, mean, median, std, min, max, count)."""
    names = [c[: -len("_median")] for c in profiles.columns if c.endswith("_median")]
    each = F.explode(F.array(*[
        F.struct(F.lit(n).alias("Feature"), *[F.col(f"{n}_{s}").cast("double").alias(s) for s in PROFILE_STATISTICS])
        for n in names])).alias("p")
    return profiles.select("Segment", each).select("Segment", "p.*")


# Segment names by mean recency r, frequency f, spend s, tier t, points p and lifetime value l; first match wins.
def segment_name(r: Column, f: Column, s: Column, t: Column, p: Column, l: Column) -> Column:
    return (
        F.when((r <= 30) & (f >= 20) & (s >= 5000), "Champions")
        .when((r <= 60) & (f >= 10) & (s >= 2000), "Loyal Customers")
        .when((r <= 90) & (f >= 5), "Potential Loyalists")
        .when((r <= 30) & (f <= 5), "New Customers")
        .when((r > 90) & (f >= 10), "At Risk")
        .when(r > 180, "Lost")
        .when((t >= 3) & (p >= 25000), "High-Value Loyal")
        .when(l >= 10000, "High-Value")
        .when((r > 90) & (r <= 180) & (f >= 5) & (f < 10) & (s >= 2000), "Dormant Customers")
        .when((r > 90) & (f < 10) & (s >= 2000), "Moderate Customers")
        .when((r <= 120) & (f >= 5) & (s >= 1000), "Regular Customers")
        .when(f >= 5, "Occasional Customers")
        .otherwise("Low Engagement")
    )


def assign_segment_names(features: DataFrame, labels: DataFrame, spend_unit: int = 1) -> DataFrame:
    """(Segment, SegmentName). Absent measures count as recency 999, tier 1 and 0 otherwise."""
    wanted = [c for c in KEY_AVERAGES.values() if c in features.columns]
    joined = features.select("CustomerID", *wanted).join(labels.select("CustomerID", "Segment"), "CustomerID")
    means = joined.groupBy("Segment").agg(F.count(F.lit(1)).alias("_n"), *key_averages(joined))

    def average(name: str, missing: float) -> Column:
        return F.col(name) if name in means.columns else F.lit(float(missing))

    return means.select("Segment", segment_name(
        average("AvgRecency", 999), average("AvgFrequency", 0), average("AvgTotalSpend", 0) / spend_unit,
        average("AvgTier", 1), average("AvgPointsBalance", 0), average("AvgLifetimeValue", 0) / spend_unit,
    ).alias("SegmentName"))


@dataclass
class Segmentation:
    model: CentreModel
    labels: DataFrame
    profiles: DataFrame
    names: DataFrame
    n_clusters: int
    scaler: Scaler
    pca: Any
    k_scores: DataFrame | None
    selected: list[str]


def perform_customer_segmentation(features: DataFrame, n_clusters: int | None = None, feature_types=DEFAULT_GROUPS,
                                  find_optimal_k: bool = True, k_range=range(3, 9), use_pca: bool = False,
                                  random_state: int = SEED, n_init: int = 10) -> Segmentation:
    """Select, prepare, cluster, profile and name. K is searched only when none is given."""
    selected = select_features_for_clustering(features, feature_types)
    prepared, scaler, pca = prepare_features_for_clustering(selected, use_pca)
    scores = None
    if n_clusters is None and find_optimal_k:
        scores = find_optimal_k_clusters(prepared, k_range, random_state, n_init)
        n_clusters = scores.filter("IsBest").first()["K"]
    n_clusters = n_clusters or 5
    model, labels = perform_kmeans_clustering(prepared, n_clusters, random_state, n_init=n_init)
    return Segmentation(model, labels, profile_segments(features, labels), assign_segment_names(features, labels),
                        n_clusters, scaler, pca, scores, selected.columns)


def save_segmentation_results(results: Segmentation, output_path: str) -> None:
    """Model, scaler, PCA, labels, profiles and names under one folder."""
    base = str(output_path).rstrip("/")
    if results.pca is not None:
        results.pca.write().overwrite().save(f"{base}/pca")
    tables = {"kmeans_model": results.model.as_table(results.labels.sparkSession), "scaler": results.scaler.as_table(results.labels.sparkSession), "segment_labels": results.labels,
              "segment_profiles": results.profiles, "segment_names": results.names}
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{base}/{name}.parquet")


@dataclass
class SavedSegmentation:
    """What ``save_segmentation_results`` wrote, ready to label customers."""

    model: CentreModel
    scaler: Scaler
    pca: PCAModel | None
    names: DataFrame

    def assign(self, features: DataFrame) -> DataFrame:
        """(CustomerID, Segment, SegmentName) of customers with the columns the segmentation was fitted on."""
        columns = self.scaler.columns
        scaled = self.scaler.transform(impute_median(features.select("CustomerID", *columns), columns))
        if self.pca is not None:
            scaled = _reduced(scaled, columns, self.pca, len(self.model.centres[0]))
        measured = [c for c in scaled.columns if c != "CustomerID"]
        labels = scaled.select("CustomerID", self.model.segment(F.array(*[number(F.col(c)) for c in measured])).alias("Segment"))
        return labels.join(self.names.select(F.col("Segment").alias("_of"), "SegmentName"), F.col("Segment") == F.col("_of"), "left").drop("_of")


def load_segmentation(spark: SparkSession, path: str, pca: bool | None = None) -> SavedSegmentation:
    """Read back centres, scaler, components (where there are any) and names."""
    base = str(path).rstrip("/")
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/pca")
    there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder) if pca is None else pca
    return SavedSegmentation(
        CentreModel.from_table(spark.read.parquet(f"{base}/kmeans_model.parquet")), Scaler.from_table(spark.read.parquet(f"{base}/scaler.parquet")),
        PCAModel.load(f"{base}/pca") if there else None, spark.read.parquet(f"{base}/segment_names.parquet"))
