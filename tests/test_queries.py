import pytest

from clipfold import queries, sql
from tests import oracle

D = "/root/testdata/sf0.001"
Q, SQL = queries.queries(), sql.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(D)


def test_every_query_has_sql():
    assert set(Q) == set(SQL)


@pytest.mark.parametrize("name", sorted(Q))
def test_same_as_sql(spark, con, name):
    oracle.same(spark, con, D, Q[name], SQL[name])
