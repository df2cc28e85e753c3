"""Every registered query with check SQL, on the smallest data set."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, duck
from tests.conftest import SMALL

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_check_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SMALL), con, ORACLE[name]) == []


def test_entry_has_the_published_columns(spark):
    from buyerscope.features.store import kept_features

    df = entry.entry(spark)
    assert df.columns == ["cust_id", *kept_features()]
    assert len(df.columns) == 158
    assert df.count() > 0
