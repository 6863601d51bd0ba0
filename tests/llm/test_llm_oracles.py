"""Every query that SQL can express equals its SQL on the small tables."""

import duckdb
import pytest
from compare import differences

from saleslake.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in ("documents", "benchmark", "pages", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, tables, name):
    assert differences(spark, SF_DIR, tables, QUERIES[name], ORACLES[name]) == []
