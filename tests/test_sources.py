import pytest
from conftest import by, day, money

from tillpoint import schemas
from tillpoint.plans.etl import run_etl_pipeline
from tillpoint.sources import readers, sinks

FILES = {
    "transactions.csv": "TransactionID,CustomerID,TransactionDate,StoreID,ProductID,Quantity,UnitPrice,LineTotal,Note\n"
                        "T1,C1,2023-01-01,S1,P1,2,10.99,21.98,a\nT2,C2,2023-01-02,S1,P2,1,5.50,5.50,b\n",
    "loyalty.csv": "LoyaltyRecordID,CustomerID,TransactionID,TransactionDate,PointsEarned,PointsRedeemed,PointsBalance,Tier,PointsPerDollar\n"
                        "1,C1,T1,2023-01-01,22,0,22,Bronze,1.0\n2,C2,T2,2023-01-02,6,0,6,Bronze,1.0\n",
    "surveys.csv": "SurveyID,CustomerID,SurveyDate,SatisfactionScore,NPSScore,Feedback,WouldRecommend\n1,C1,2023-02-01,5,9,fine,Yes\n2,C2,2023-02-02,3,5,ok,No\n",
    "products.csv": "ProductID,ProductName,Category,Price,Cost\nP1,One,A,10.99,5\nP2,Two,B,5.50,2\n",
    "stores.csv": "StoreID,StoreName,City,Province,Address\nS1,Main,Town,ON,1 St\nS2,Side,Town,ON,2 St\n",
    "customers.csv": "CustomerID,FirstName,LastName,Email,Phone,Address,City,Province,PostalCode,EnrollmentDate,DateOfBirth\n"
                     "C1,A,B,e,p,a,Town,ON,X,2022-01-01,1990-01-01\nC2,A,B,e,p,a,Town,ON,X,2022-01-01,\n",
}


@pytest.fixture()
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for name, text in FILES.items():
        (folder / name).write_text(text)
    return folder


def test_load_all(spark, raw):
    assert all(readers.validate_data_sources(spark, raw).values())
    tables = readers.load_all_data(spark, raw)
    assert {n: df.count() for n, df in tables.items()} == {n: 2 for n in schemas.SCHEMAS}
    types = dict(tables["transactions"].dtypes)
    assert (types["TransactionID"], types["TransactionDate"], types["Quantity"], types["LineTotal"], types["Note"]) == (
        "string", "date", "int", "decimal(10,2)", "string")
    assert sorted(readers.load_reference_data(spark, raw)) == ["customers", "products", "stores"]


def test_column_order_in_the_file_does_not_matter(spark, tmp_path):
    path = tmp_path / "products.csv"
    path.write_text("Price,ProductName,ProductID,Category\n3.5,One,P1,A\n")
    assert tuple(readers.load_products(spark, path).select("ProductID", "Price").first()) == ("P1", money("3.50"))


def test_errors(spark, raw, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.load_transactions(spark, tmp_path / "none.csv")
    (tmp_path / "bad.csv").write_text("col1\n1\n")
    for load in readers.LOADERS.values():
        with pytest.raises(ValueError):
            load(spark, tmp_path / "bad.csv")
    (tmp_path / "empty.csv").write_text(FILES["transactions.csv"].splitlines()[0] + "\n")
    with pytest.raises(ValueError):
        readers.load_transactions(spark, tmp_path / "empty.csv")
    (tmp_path / "nosurveys.csv").write_text(FILES["surveys.csv"].splitlines()[0] + "\n")
    assert readers.load_survey_data(spark, tmp_path / "nosurveys.csv").count() == 0
    with pytest.raises(FileNotFoundError):
        readers.validate_data_sources(spark, tmp_path)
    assert not any(readers.validate_data_sources(spark, tmp_path, raise_missing=False).values())
    with pytest.raises(ValueError):
        readers.validate_dataframe(spark.range(1), ["x"])


def test_formats(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    sinks.save_processed_data(df, tmp_path / "t", "both")
    assert spark.read.parquet(str(tmp_path / "t.parquet")).count() == 2
    assert spark.read.csv(str(tmp_path / "t.csv"), header=True).count() == 2
    sinks.save_all_processed_data({"x": df, "y": df}, tmp_path / "out")
    assert (tmp_path / "out" / "y.parquet").exists()
    with pytest.raises(ValueError):
        sinks.save_processed_data(df, tmp_path / "t", "xml")


def test_calendar(spark):
    assert sinks.create_date_dimension(spark).count() == 2192
    year = by(sinks.create_date_dimension(spark, "2023-01-01", "2023-12-31"), "DateKey")
    assert len(year) == 365
    row = year[20230101]
    assert (row["Week"], row["DayOfWeek"], row["DayName"], row["MonthName"], row["IsWeekend"], row["IsHolidaySeason"]) == (
        52, 6, "Sunday", "January", True, True)
    assert year[20230703]["IsHolidaySeason"] is False and year[20230703]["Quarter"] == 3


def test_warehouse_tables_in_the_catalog(spark, tmp_path):
    made = sinks.create_warehouse_tables(spark, "shop", str(tmp_path / "shop"))
    assert len(made) == 7 and spark.table("shop.fact_surveys").columns == [f.name for f in schemas.SURVEYS.fields]
    spark.sql("DROP DATABASE shop CASCADE")


def test_results_without_product_table(spark, tmp_path):
    for name in readers.RESULT_TABLES:
        if name != "product_performance":
            spark.range(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    got = readers.load_precomputed_data(spark, tmp_path)
    assert got["product_performance"].count() == 0 and "TotalRevenue" in got["product_performance"].columns


def test_whole_etl(spark, raw, tmp_path):
    done = run_etl_pipeline(spark, raw, tmp_path / "processed", tmp_path / "warehouse")
    assert {n: df.count() for n, df in done.tables.items()} == {
        "transactions": 2, "loyalty": 2, "surveys": 2, "customers": 2, "products": 2, "stores": 2, "merged": 2}
    assert all(r["Passed"] for r in done.integrity.collect())
    assert {r["dataset"]: r["missing_values"] for r in done.quality.collect()}["customers"] == 1
    assert sorted(done.warehouse) == ["dim_customers", "dim_dates", "dim_products", "dim_stores", "fact_loyalty_points",
                                      "fact_surveys", "fact_transactions"]
    fact = spark.read.parquet(done.warehouse["fact_transactions"])
    assert fact.filter("SalesMonth = '2023-01'").count() == 2
    assert fact.agg({"TransactionDate": "max"}).first()[0] == day("2023-01-02")
    assert readers.load_warehouse_tables(spark, tmp_path / "processed")["surveys"].count() == 2


def test_bad_numbers_are_not_lost_in_silence(spark, tmp_path):
    (tmp_path / "surveys.csv").write_text("SurveyID,CustomerID,SurveyDate,SatisfactionScore,NPSScore\n1,C1,2023-01-01,4,9\n2,C2,2023-01-01,abc,9\n")
    path = tmp_path / "surveys.csv"
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        readers.load_survey_data(spark, path).collect()
    loose = readers.load_survey_data(spark, path, mode="PERMISSIVE")
    assert tuple(readers.bad_records(loose).first()) == (2, 1)
    assert loose.filter("_bad_record IS NOT NULL").first()["SatisfactionScore"] is None


def test_one_file_for_each_table(spark, tmp_path):
    for name in ("surveys_a.csv", "surveys_b.csv"):
        (tmp_path / name).write_text("SurveyID,CustomerID,SurveyDate,SatisfactionScore,NPSScore\n1,C1,2023-01-01,4,9\n")
    with pytest.raises(ValueError, match="matches 2 files"):
        readers.load_survey_data(spark, tmp_path / "surveys_*.csv")
    assert readers.validate_data_sources(spark, tmp_path, False, {"surveys": "surveys_a.csv"})["surveys"]
