"""Churn risk: labels, temporal split, rebalancing, boosted trees, evaluation and scoring."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillpoint.functions.lineage import stage
from tillpoint.functions.ordered import Ordered
from tillpoint.functions.stats import as_of, count_if, days_between, numeric_columns, ratio
from tillpoint.operators.exchanged import Scorer
from tillpoint.operators.explanations import explain_customers, tree_nodes
from tillpoint.operators.ml_prep import impute_median
from tillpoint.operators.oversampling import oversample_minority
from tillpoint.schemas import CHURN_DAYS, SEED

#: (Customer, feature) pairs that one round of ``explain_by_permutation`` works through, and rows of one chunk of its hash order.
ROUND_ROWS = 20_000_000
HASH_CHUNK = 200_000

NOT_FEATURES = ["CustomerID", "Churn", "LastPurchaseDate", "FirstPurchaseDate"]


def create_churn_target(transactions: DataFrame, reference_date=None, churn_threshold_days: int = CHURN_DAYS) -> DataFrame:
    """Churn = 1 when the last purchase is more than the threshold before the reference date."""
    ref = as_of(transactions, reference_date)
    last = transactions.filter("CustomerID is not null").groupBy("CustomerID").agg(F.max("TransactionDate").alias("LastPurchaseDate"))
    days = last.withColumn("DaysSinceLastPurchase", days_between(F.col("LastPurchaseDate"), ref))
    return days.select("CustomerID", (F.col("DaysSinceLastPurchase") > churn_threshold_days).cast("int").alias("Churn"),
                       "DaysSinceLastPurchase", "LastPurchaseDate")


def feature_columns(features: DataFrame) -> list[str]:
    return numeric_columns(features, exclude=NOT_FEATURES)


def prepare_churn_features(features: DataFrame, target: DataFrame) -> DataFrame:
    """CustomerID, complete numeric features and Churn of the customers in both inputs."""
    columns = feature_columns(features)
    joined = stage(features.select("CustomerID", *columns).join(target.select("CustomerID", "Churn"), "CustomerID"))
    return impute_median(joined, columns)  # reads it for the gaps, for the medians and for the result


def split_date(transactions: DataFrame, share: float = 0.8):
    """The day that ends the first 80 % of the date range."""
    row = transactions.agg(F.min("TransactionDate").alias("a"), F.max("TransactionDate").alias("b")).select(
        F.date_add("a", (F.datediff("b", "a") * share).cast("int")).alias("cut")).first()
    return row["cut"]


def temporal_targets(transactions: DataFrame, train_end_date=None, churn_threshold_days: int = CHURN_DAYS):
    """(train, test) labels of the customers who buy in both periods; all of each if nobody does."""
    cut = split_date(transactions) if train_end_date is None else train_end_date
    day = F.lit(cut).cast("date")
    before = transactions.filter(F.col("TransactionDate") <= day)
    after = transactions.filter(F.col("TransactionDate") > day)
    train = create_churn_target(before, cut, churn_threshold_days)
    test = create_churn_target(after, as_of(transactions), churn_threshold_days)
    shared_train = train.join(test.select("CustomerID"), "CustomerID", "left_semi")
    if shared_train.isEmpty():
        return train, test
    return shared_train, test.join(train.select("CustomerID"), "CustomerID", "left_semi")


def create_temporal_split(features: DataFrame, transactions: DataFrame, train_end_date=None,
                          churn_threshold_days: int = CHURN_DAYS):
    """(train, test) with the labels of each period.

    ``features`` covers the whole history here, so train and test share feature values and only
    labels differ. For an honest estimate build the training features from transactions up to
    ``split_date`` and use ``point_in_time_split``.
    """
    train, test = temporal_targets(transactions, train_end_date, churn_threshold_days)
    return prepare_churn_features(features, train), prepare_churn_features(features, test)


def point_in_time_split(transactions: DataFrame, build_features, train_end_date=None, churn_threshold_days: int = CHURN_DAYS,
                        share: float = 0.8):
    """(train, test) without look-ahead: ``build_features(transactions, as_of_date)`` only sees the past.

    Training features stand one churn threshold before the cut and are labelled by what follows up
    to the cut; test features stand at the cut and are labelled by the threshold after it.
    """
    cut = split_date(transactions, share) if train_end_date is None else train_end_date
    row = transactions.sparkSession.range(1).select(
        F.date_sub(F.lit(cut).cast("date"), churn_threshold_days).alias("a"),
        F.lit(cut).cast("date").alias("cut"),
        F.date_add(F.lit(cut).cast("date"), churn_threshold_days).alias("b")).first()
    parts = []
    for start, end in ((row["a"], row["cut"]), (row["cut"], row["b"])):
        past = transactions.filter(F.col("TransactionDate") <= F.lit(start).cast("date"))
        future = transactions.filter((F.col("TransactionDate") > F.lit(start).cast("date"))
                                     & (F.col("TransactionDate") <= F.lit(end).cast("date")))
        back = future.select("CustomerID").distinct().withColumn("_back", F.lit(1))
        known = past.select("CustomerID").filter("CustomerID is not null").distinct()
        target = known.join(back, "CustomerID", "left").select("CustomerID", F.when(F.col("_back") == 1, 0).otherwise(1).alias("Churn"))
        parts.append(prepare_churn_features(build_features(past, start), target))
    return parts[0], parts[1]


def class_counts(train: DataFrame) -> tuple[int, int]:
    """(negatives, positives)."""
    row = train.agg(count_if(F.col("Churn") == 0).alias("n"), count_if(F.col("Churn") == 1).alias("p")).first()
    return row["n"], row["p"]


def with_class_weights(train: DataFrame) -> DataFrame:
    """Positives weigh negatives / positives."""
    negatives, positives = class_counts(train)
    weight = negatives / positives if positives else 1.0
    return train.withColumn("ClassWeight", F.when(F.col("Churn") == 1, F.lit(float(weight))).otherwise(F.lit(1.0)))


def handle_class_imbalance(train: DataFrame, method: str = "smote", random_state: int = SEED) -> DataFrame:
    """'smote' adds synthetic minority rows up to parity; anything else returns the frame."""
    if method != "smote":
        return train
    return oversample_minority(train, feature_columns(train), "Churn", "CustomerID", random_state)


# Default model parameters.
DEFAULTS = {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.1, "subsample": 0.8, "colsample": 0.8}


def train_churn_model(train: DataFrame, hyperparameters: dict | None = None, use_class_weights: bool = True,
                      random_state: int = SEED) -> PipelineModel:
    """Gradient-boosted trees on all numeric features. Needs both classes."""
    negatives, positives = class_counts(train)
    if not negatives or not positives:
        raise ValueError("training needs both churned and active customers")
    given = DEFAULTS if hyperparameters is None else {**{"subsample": 1.0, "colsample": 1.0, "n_estimators": 100,
                                                         "max_depth": 6, "learning_rate": 0.3}, **hyperparameters}
    columns = feature_columns(train)
    rows = with_class_weights(train) if use_class_weights else train.withColumn("ClassWeight", F.lit(1.0))
    rows = rows.select("Churn", "ClassWeight", *columns)
    trees = GBTClassifier(
        featuresCol="features", labelCol="Churn", weightCol="ClassWeight", maxIter=int(given["n_estimators"]),
        maxDepth=int(given["max_depth"]), stepSize=float(given["learning_rate"]),
        subsamplingRate=float(given["subsample"]), featureSubsetStrategy=str(float(given["colsample"])) if given["colsample"] < 1 else "all",
        seed=random_state)
    assemble = VectorAssembler(inputCols=columns, outputCol="features")
    return Pipeline(stages=[assemble, trees]).fit(stage(rows))


def validation_curve(model: PipelineModel, validation: DataFrame) -> DataFrame:
    """Loss on held-out rows after each tree."""
    assembled = model.stages[0].transform(validation).select(
        "features", F.col("Churn").cast("double").alias("Churn"), F.lit(1.0).alias("ClassWeight"))
    losses = model.stages[-1].evaluateEachIteration(assembled)
    return validation.sparkSession.createDataFrame([(i, float(x)) for i, x in enumerate(losses, 1)], "Trees int, Loss double")


def churn_probability(model: PipelineModel, features: DataFrame) -> DataFrame:
    """The frame with ChurnProbability added."""
    helpers = ["features", "rawPrediction", "probability", "prediction"]
    return model.transform(features).withColumn("ChurnProbability", vector_to_array("probability")[1]).drop(*helpers)


def risk_level(p: Column) -> Column:
    """(0, .3] Low, (.3, .6] Medium, (.6, .8] High, (.8, 1] Critical; exactly 0 has no level."""
    return (
        F.when((p > 0) & (p <= 0.3), "Low").when((p > 0.3) & (p <= 0.6), "Medium")
        .when((p > 0.6) & (p <= 0.8), "High").when((p > 0.8) & (p <= 1.0), "Critical")
    )


def risk_table(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """CustomerID, probability, 0/1 prediction and risk level from a frame with ChurnProbability."""
    p = F.col("ChurnProbability")
    return scored.select("CustomerID", p, (p >= threshold).cast("int").alias("ChurnPrediction"), risk_level(p).alias("RiskLevel"))


def predict_churn_risk(model: PipelineModel, features: DataFrame, threshold: float = 0.5) -> DataFrame:
    columns = model.stages[0].getInputCols()
    ready = impute_median(features.select("CustomerID", *columns), list(columns))
    return risk_table(churn_probability(model, ready), threshold)


def roc_auc(scored: DataFrame, groups: list[str] | None = None, limit: int | None = None, measure: int | None = None) -> DataFrame:
    """Exact area under the ROC curve by average ranks, per group. ``measure``: a number no group has more rows than.

    Scores are first counted per distinct value, so ties merge before anything is ordered, and the
    negatives below each score are a running total over those values.
    """
    groups = groups or []
    counts = scored.groupBy(*groups, "ChurnProbability").agg(
        count_if(F.col("Churn") == 1).alias("_p"), count_if(F.col("Churn") == 0).alias("_n"))
    walked = Ordered.of(counts, groups, ["ChurnProbability"], measure=measure, limit=limit).running_sum(_upto=F.col("_n")).result()
    wins = F.sum(F.col("_p") * (2 * F.col("_upto") - F.col("_n")))
    area = ratio(wins, 2 * F.sum("_p") * F.sum("_n")).alias("RocAuc")
    return walked.groupBy(*groups).agg(area) if groups else walked.agg(area)


def confusion(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    said = F.col("ChurnProbability") >= threshold
    true = F.col("Churn") == 1
    return scored.agg(
        count_if(~said & ~true).alias("TrueNegatives"), count_if(said & ~true).alias("FalsePositives"),
        count_if(~said & true).alias("FalseNegatives"), count_if(said & true).alias("TruePositives"))


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def _harmonic(p: Column, r: Column) -> Column:
    return _zero(F.try_divide(p * r * 2, p + r))


def evaluate_scores(scored: DataFrame, threshold: float = 0.5, limit: int | None = None) -> DataFrame:
    """Precision, recall, F1, AUC, accuracy and the confusion counts of (ChurnProbability, Churn) rows, as one row."""
    tn, fp, fn, tp = (F.col(c) for c in ("TrueNegatives", "FalsePositives", "FalseNegatives", "TruePositives"))
    rates = confusion(scored, threshold).withColumn("Precision", _zero(ratio(tp, tp + fp))).withColumn(
        "Recall", _zero(ratio(tp, tp + fn))).withColumn("Accuracy", _zero(ratio(tp + tn, tp + tn + fp + fn)))
    area = roc_auc(scored, limit=limit).scalar()
    return rates.withColumn("F1", _harmonic(F.col("Precision"), F.col("Recall"))).withColumn("RocAuc", area).select(
        "Precision", "Recall", "F1", "RocAuc", "Accuracy", "TrueNegatives", "FalsePositives", "FalseNegatives", "TruePositives")


def classification_report(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Precision, recall, F1 and support per class, and their plain and support-weighted averages."""
    tn, fp, fn, tp = (F.col(c) for c in ("TrueNegatives", "FalsePositives", "FalseNegatives", "TruePositives"))
    each = F.explode(F.array(
        F.struct(F.lit("0").alias("Label"), _zero(ratio(tn, tn + fn)).alias("Precision"), _zero(ratio(tn, tn + fp)).alias("Recall"), (tn + fp).alias("Support")),
        F.struct(F.lit("1").alias("Label"), _zero(ratio(tp, tp + fp)).alias("Precision"), _zero(ratio(tp, tp + fn)).alias("Recall"), (tp + fn).alias("Support")),
    )).alias("c")
    classes = confusion(scored, threshold).select(each).select("c.*").withColumn("F1", _harmonic(F.col("Precision"), F.col("Recall")))
    classes = classes.select("Label", "Precision", "Recall", "F1", "Support")
    rates = ("Precision", "Recall", "F1")
    plain = classes.agg(F.lit("macro avg").alias("Label"), *[F.avg(r).alias(r) for r in rates], F.sum("Support").alias("Support"))
    weighted = classes.agg(F.lit("weighted avg").alias("Label"),
                           *[_zero(F.try_divide(F.sum(F.col(r) * F.col("Support")), F.sum("Support").cast("double"))).alias(r) for r in rates],
                           F.sum("Support").alias("Support"))
    return classes.unionByName(plain).unionByName(weighted)


def evaluate_model(model: PipelineModel, test: DataFrame, threshold: float = 0.5) -> DataFrame:
    return evaluate_scores(stage(churn_probability(model, test).select("CustomerID", "ChurnProbability", "Churn")), threshold)


def calculate_feature_importance(model: PipelineModel, spark, top: int | None = None) -> DataFrame:
    """Importances by feature name, largest first; the ``top`` largest where that is given."""
    names, values = model.stages[0].getInputCols(), model.stages[-1].featureImportances.toArray()
    rows = [(n, float(v)) for n, v in zip(names, values)]
    ranked = spark.createDataFrame(rows, "Feature string, Importance double").orderBy(F.desc("Importance"), "Feature")
    return ranked if top is None else ranked.limit(top)


def _hash_chunks(size: int) -> int:
    """Bits of a hash that cut ``size`` rows into chunks of about ``HASH_CHUNK``."""
    return max(0, (size - 1) // HASH_CHUNK).bit_length()


def _exchanged_bins(binned: DataFrame, features: dict[int, str], size: int, seed: int, kind: str) -> DataFrame:
    """(_place, f, _bin): for every feature the bins in an order by hash, which differs from feature to feature.

    Hashes are even, so the chunks of a feature are ranges of its hash: no chunk needs to be stored, and one count for each puts them in a row.
    """
    bits, width = _hash_chunks(size), int(kind[-1])

    def bin_of(i: int) -> Column:
        text = F.hex(F.substring("_bins", i * width + 1, width)) if width == 1 else F.hex(F.reverse(F.substring("_bins", i * width + 1, width)))
        return F.conv(text, 16, 10).cast("int")

    hashed = F.xxhash64(F.col("CustomerID"), F.lit(seed), F.lit("x"))
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.xxhash64(hashed, F.lit(n)).alias("_h"), bin_of(i).alias("_bin")) for i, n in features.items()]))
    long = binned.select("CustomerID", each.alias("e")).select("CustomerID", "e.*")
    long = long.withColumn("_chunk", F.shiftright("_h", 64 - bits) if bits else F.lit(0).cast("bigint"))
    sizes = long.groupBy("f", "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("f").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("f", "_chunk", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("f", "_chunk").orderBy("_h", "CustomerID"))
    return long.withColumn("_row", within).join(starts, ["f", "_chunk"]).select((F.col("_start") + F.col("_row")).alias("_place"), "f", "_bin")


def explain_by_permutation(model: PipelineModel, test: DataFrame, max_samples: int | None = None, random_state: int = SEED,
                           rows_per_round: int | None = None) -> DataFrame:
    """How much the AUC drops when one feature's values are exchanged between customers.

    Works on all customers of ``test``, or on at most ``max_samples`` of them, chosen by hash, where that is
    given. For every feature each customer gets the value of the customer at the same place of another hash order. Of a customer only
    the bins of its features among the model's thresholds are kept; features are worked through in rounds of at most about
    ``rows_per_round`` (customer, feature) pairs, whose files are released before the next.
    """
    columns, spark = list(model.stages[0].getInputCols()), test.sparkSession
    trees = model.stages[-1]
    scorer = Scorer(tree_nodes(trees), list(trees.treeWeights), len(columns))
    shared, kind = spark.sparkContext.broadcast(scorer), scorer.kind
    chosen = test if max_samples is None else test.orderBy(F.xxhash64(F.col("CustomerID"), F.lit(random_state)), "CustomerID").limit(max_samples)
    key = test.schema["CustomerID"].dataType.simpleString()

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            found = shared.value.bins(matrix) if batch.num_rows else matrix
            yield pa.RecordBatch.from_arrays([batch.column("CustomerID"), batch.column("Churn"), pa.array([r.tobytes() for r in found], pa.binary())],
                                             ["CustomerID", "Churn", "_bins"])

    vectors = model.stages[0].transform(chosen).select("CustomerID", F.col("Churn").cast("int").alias("Churn"), vector_to_array("features").alias("v"))
    binned = stage(vectors.mapInArrow(bins, f"CustomerID {key}, Churn int, _bins binary"))
    size = binned.count()
    placed = stage(Ordered.of(binned, [], ["CustomerID"]).position("_place").result())

    def score(wanted: list[int]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                own = np.frombuffer(b"".join(batch.column("_bins").to_pylist()), dtype=kind).reshape(batch.num_rows, -1)
                other = batch.column("_given").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                churn = batch.column("Churn").to_numpy(zero_copy_only=False)
                for rows, plain, exchanged in shared.value.scores(own, wanted, other):
                    scores = np.concatenate([plain[:, None], exchanged], axis=1)
                    of = np.broadcast_to(np.array([-1, *wanted], dtype="int32"), scores.shape)
                    yield pa.RecordBatch.from_arrays([pa.array(of.ravel()), pa.array(scores.ravel()), pa.array(np.repeat(churn[rows], scores.shape[1]))],
                                                     ["f", "ChurnProbability", "Churn"])
        return run

    each = max(1, (ROUND_ROWS if rows_per_round is None else rows_per_round) // max(size, 1))
    areas: dict[int, float | None] = {}
    for start in range(0, len(columns), each):
        wanted = list(range(start, min(start + each, len(columns))))
        given = _exchanged_bins(placed, {i: columns[i] for i in wanted}, size, random_state + 1, kind).groupBy("_place").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("f", "_bin"))), lambda e: e["_bin"]).alias("_given"))  # one entry for each feature of the round
        pairs = placed.select("_place", "Churn", "_bins").join(given, "_place").select("Churn", "_bins", "_given")
        scored = stage(pairs.mapInArrow(score(wanted), "f int, ChurnProbability double, Churn int"))
        found = roc_auc(scored, ["f"], measure=size).collect()  # one row for each feature of the round
        areas |= {r["f"]: r["RocAuc"] for r in found}
    base = areas.get(-1)
    drops = [(c, None if base is None or areas.get(i) is None else base - areas[i]) for i, c in enumerate(columns) if size]
    return spark.createDataFrame(drops, "Feature string, AucDrop double").orderBy(F.desc("AucDrop"), "Feature")


@dataclass
class ChurnResults:
    model: PipelineModel
    metrics: DataFrame
    report: DataFrame
    feature_importance: DataFrame
    explanations: DataFrame | None
    predictions: DataFrame
    #: CustomerID, ChurnProbability and Churn of the held-out customers
    test_scores: DataFrame
    #: what every feature added to the score of each held-out customer
    contributions: DataFrame | None = None


def perform_churn_prediction(features: DataFrame, transactions: DataFrame, churn_threshold_days: int = CHURN_DAYS,
                             train_end_date=None, use_smote: bool = True, hyperparameters: dict | None = None,
                             random_state: int = SEED, explain: bool = True, max_samples: int | None = None) -> ChurnResults:
    """Split, rebalance, train, evaluate, explain and score. Class weights apply when SMOTE does not."""
    train, test = create_temporal_split(features, transactions, train_end_date, churn_threshold_days)
    train, test = stage(train), stage(test)
    rows = handle_class_imbalance(train, "smote", random_state) if use_smote else train
    model = train_churn_model(rows, hyperparameters, not use_smote, random_state)
    scored = stage(churn_probability(model, test).select("CustomerID", "ChurnProbability", "Churn"))
    return ChurnResults(
        model, evaluate_scores(scored), classification_report(scored),
        calculate_feature_importance(model, features.sparkSession),
        explain_by_permutation(model, test, max_samples, random_state) if explain else None,
        predict_churn_risk(model, features), scored,
        explain_customers(model, test, max_samples, random_state) if explain else None)


def save_churn_model(results: ChurnResults, output_path: str) -> None:
    """Model, predictions, importances and metrics under one folder."""
    base = str(output_path).rstrip("/")
    results.model.write().overwrite().save(f"{base}/churn_model")
    tables = {"churn_predictions": results.predictions, "feature_importance": results.feature_importance,
              "model_metrics": results.metrics}
    if results.contributions is not None:
        tables["customer_explanations"] = results.contributions
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{base}/{name}.parquet")


def load_churn_model(path: str) -> PipelineModel:
    """The model that ``save_churn_model`` wrote; ``predict_churn_risk`` and ``explain_customers`` take it."""
    return PipelineModel.load(f"{str(path).rstrip('/')}/churn_model")
