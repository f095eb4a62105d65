"""A spread of registered queries against DuckDB on the smallest tables; ``checks.compare`` runs all of them."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from checks.compare import VIEWS, _rows

FOLDER = "/root/testdata/sf0.001"
SAMPLE = ["agg_01", "agg_04", "agg_06", "agg_07", "agg_09", "agg_13", "agg_15", "win_01", "cln_07", "cln_13", "dq_01", "dq_02",
          "fea_06", "fea_08", "fea_13", "fea_14", "re_01", "kpi_06", "seg_05", "chn_03", "chn_06", "snk_06"]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for v in VIEWS:
        con.execute(f"CREATE VIEW {v} AS SELECT * FROM '{FOLDER}/{v}.parquet'")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, db, name):
    df = contract.queries()[name](spark, FOLDER)
    answer = db.execute(contract.oracle_sql()[name])
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows([d[0] for d in answer.description], answer.fetchall())


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 6
