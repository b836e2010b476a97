import pytest

from fettle.plans.catalog import QUERIES
from fettle.plans.oracle import SQL
from tests.helpers import plan_of
from tests.oracle import difference, duck

SMALL = "/root/testdata/sf0.001"
ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def connection():
    return duck(SMALL)


def test_every_query_has_its_sql():
    assert set(QUERIES) - set(SQL) == ROWS_ONLY
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    df = QUERIES[name](spark, SMALL)
    if name in ROWS_ONLY:
        assert df.count() > 0
    else:
        assert difference(df, connection, SQL[name]) is None
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() > 0
