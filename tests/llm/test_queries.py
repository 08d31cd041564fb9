import pytest

from clipfold.llm import queries
from tests import oracle

D = "/root/testdata/sf0.001"
Q, SQL = queries.queries(), queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, name):
    oracle.same(spark, oracle.connect(D), D, Q[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(Q) - set(SQL)))
def test_runs(spark, name):
    df = Q[name](spark, D)
    assert df.count() >= 0 and len(df.columns) == len(set(df.columns))
