"""Every registered query against its SQL in DuckDB on the small tables."""

import os

import pytest
from compare import check, views

import __spark_entry__ as entry_module

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")

QUERIES, ORACLE = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return views(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    assert check(spark, con, SF, QUERIES[name], ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry_is_lazy_and_has_rows(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["user_id", "event_type", "value", "props"]
    assert df.count() > 0
