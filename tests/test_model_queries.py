"""The registered model queries call the operators over their whole job."""

import inspect
import os

import pytest

from checks.mapping import Tables
from checks.queries import QUERIES
from tillpoint.operators import churn, segmentation as seg
from tillpoint.plans import analysis

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


class Called(Exception):
    pass


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, FOLDER)


CALLS = [
    ("seg_03", seg, "find_optimal_k_clusters"), ("seg_04", seg, "perform_kmeans_clustering"),
    ("seg_04_nearest", seg, "perform_kmeans_clustering"), ("seg_07", seg, "perform_customer_segmentation"),
    ("chn_05", churn, "train_churn_model"), ("chn_08", churn, "train_churn_model"), ("chn_10", churn, "perform_churn_prediction"),
    ("chn_10_rules", churn, "perform_churn_prediction"), ("analysis_pipeline", analysis, "precompute_all_analysis")]


@pytest.mark.parametrize(("query", "module", "operator"), CALLS)
def test_operator_has_its_defaults_and_all_features_of_table(monkeypatch, tables, query, module, operator):
    signature = inspect.signature(getattr(module, operator))

    def called(*given, **named):
        raise Called(signature.bind(*given, **named).arguments)

    monkeypatch.setattr(module, operator, called)
    with pytest.raises(Called) as stop:
        QUERIES[query](tables)
    given = stop.value.args[0]
    assert [n for n in given if signature.parameters[n].default is not inspect.Parameter.empty] == []
    wanted = tables.features
    if module is seg and operator != "perform_customer_segmentation":
        wanted = seg.select_features_for_clustering(wanted)
    if operator == "train_churn_model":  # takes what the preparation keeps
        wanted = wanted.select("CustomerID", *churn.feature_columns(wanted))
    if module is not analysis:
        assert set(wanted.columns) <= set(next(iter(given.values())).columns)
