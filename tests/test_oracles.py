import pytest
from compare import connect, differences

from saleslake.checks.oracles import ORACLES
from saleslake.checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, tables, name):
    assert differences(spark, SF_DIR, tables, QUERIES[name], ORACLES[name]) == []
