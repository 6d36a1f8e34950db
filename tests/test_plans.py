import pytest

from tests.oracle import connect, difference
from turnwright.plans import registry

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    if name in SQL:
        assert difference(spark, con, QUERIES[name], SQL[name], SF) is None
    else:
        df = QUERIES[name](spark, SF)
        assert len(set(df.columns)) == len(df.columns) and df.count() >= 0
