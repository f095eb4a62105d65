"""All dashboard results from the six tables."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession

from tillpoint.functions.lineage import release_after, stage, staged_table
from tillpoint.functions.stats import newest_date
from tillpoint.operators import churn, customer_features, kpis, segmentation
from tillpoint.schemas import CHURN_DAYS, SEED

# Parameters of the stored churn model.
STORED_MODEL = {"n_estimators": 50, "max_depth": 6, "learning_rate": 0.1}


def precompute_all_analysis(spark: SparkSession, tables: dict[str, DataFrame], output_dir, n_clusters: int = 5,
                            hyperparameters: dict | None = None, n_init: int = 10, measure: DataFrame | int | None = None) -> list[str]:
    """Write every result table as Parquet and return their names.

    The feature matrix is computed once and staged; segmentation, churn and KPIs read the copy. So are the transactions, which
    features and KPIs read many times: where they come from a join, it runs once.
    """
    customers, products = tables["customers"], tables["products"]
    tx = staged_table(tables["transactions"], "transactions", compression="zstd")
    ref = newest_date(tx)
    features = stage(customer_features.create_feature_matrix(
        tx, tables["loyalty"], customers, products, tables.get("surveys"), ref, measure=measure))
    segments = segmentation.perform_customer_segmentation(features, n_clusters, find_optimal_k=False, random_state=SEED, n_init=n_init)
    # labels come from the given table: how a join lays out its rows decides which ones a tree's sample takes
    risk = churn.perform_churn_prediction(features, tables["transactions"], CHURN_DAYS, use_smote=False,
                                          hyperparameters=dict(hyperparameters or STORED_MODEL), explain=False)
    predictions = stage(risk.predictions)
    results = {
        "feature_matrix": features,
        "segment_labels": segments.labels,
        "segment_profiles": segments.profiles,
        "segment_names": segments.names,
        "churn_predictions": predictions,
        "churn_feature_importance": risk.feature_importance,
        "churn_metrics": risk.metrics,
        "kpi_metrics": kpis.kpi_metrics(tx, customers, predictions, features),
        "monthly_revenue": kpis.monthly_revenue(tx),
        "product_performance": kpis.top_product_revenue(tx, products),
        "category_performance": kpis.category_revenue(tx, products),
        "segment_distribution": kpis.segment_distribution(segments.labels, segments.names),
        "churn_risk_distribution": kpis.risk_distribution(predictions),
    }
    for name, df in results.items():
        began = time.monotonic()
        df.write.mode("overwrite").parquet(f"{str(output_dir).rstrip('/')}/{name}.parquet")
        release_after(spark, began)
    return sorted(results)
