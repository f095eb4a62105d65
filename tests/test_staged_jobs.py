"""The whole jobs compute a costly input once and write compact files."""

import glob

import pytest

from tillpoint.operators import customer_features
from tillpoint.plans import analysis
from tillpoint.sources import readers, sinks


class Seen(Exception):
    pass


def test_transactions_of_the_analysis_are_a_written_copy(spark, daily, monkeypatch, tmp_path):
    """What every later step reads is a file, not the plan that makes the transactions."""
    def seen(transactions, *rest, **named):
        raise Seen(transactions)

    monkeypatch.setattr(customer_features, "create_feature_matrix", seen)
    joined = daily.join(daily.select("TransactionID").distinct(), "TransactionID").select(*daily.columns)
    with pytest.raises(Seen) as stop:
        analysis.precompute_all_analysis(spark, {"transactions": joined, "customers": None, "products": None, "loyalty": None}, str(tmp_path))
    copy = stop.value.args[0]
    assert copy.inputFiles() and copy.schema == joined.schema
    assert sorted(map(str, copy.collect())) == sorted(map(str, daily.collect()))


def test_raw_files_are_compressed_text_of_the_same_rows(spark, daily, tmp_path):
    sinks.save_processed_data(daily, f"{tmp_path}/transactions", "csv", compression="gzip")
    assert glob.glob(f"{tmp_path}/transactions.csv/*.csv.gz") and not glob.glob(f"{tmp_path}/transactions.csv/*.csv")
    back = readers.load_transactions(spark, f"{tmp_path}/transactions.csv")
    assert sorted(map(str, back.collect())) == sorted(map(str, daily.collect()))
    sinks.save_all_processed_data({"transactions": daily}, f"{tmp_path}/all", compression="zstd")
    assert glob.glob(f"{tmp_path}/all/transactions.parquet/*.zstd.parquet")
    written = sinks.prepare_fact_tables(daily, daily.selectExpr("1L AS LoyaltyRecordID", "CustomerID", "TransactionID", "TransactionDate", "1 AS PointsEarned", "0 AS PointsRedeemed",
                                                               "1L AS PointsBalance", "'Bronze' AS Tier", "1 AS PointsPerDollar"),
                                        daily.selectExpr("1L AS SurveyID", "CustomerID", "TransactionDate AS SurveyDate", "5 AS SatisfactionScore", "9 AS NPSScore", "'' AS Feedback",
                                                         "'Yes' AS WouldRecommend"), f"{tmp_path}/w", compression="zstd")
    assert all(glob.glob(f"{path}/*/*.zstd.parquet") for path in written.values())
