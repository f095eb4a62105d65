from __future__ import annotations

import duckdb
import pytest

from tillpoint.llm.oracles import ORACLES
from tillpoint.llm.queries import QUERIES

from .conftest import SF


@pytest.mark.parametrize("name", ORACLES)
def test_table_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(str, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(str, want.fetchall()))
