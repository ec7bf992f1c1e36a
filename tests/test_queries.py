"""Every query with SQL gives the SQL's rows; those without it run."""

import pytest

from scriptorium.plans.queries import ORACLE_SQL, QUERIES
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_as_sql(spark, con, name):
    compare(name, spark, con, SF)


def test_the_rest_run(spark):
    assert set(ORACLE_SQL) <= set(QUERIES)
    for name in set(QUERIES) - set(ORACLE_SQL):
        assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
