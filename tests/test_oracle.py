"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.check import compare, connect

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    from tests.conftest import SMALL

    return connect(SMALL)


def test_sql_names_are_queries():
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    assert compare(df, con, SQL[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 8


def test_train_score(spark, sf_dir):
    rows = entry.queries()["train_score"](spark, sf_dir).collect()
    assert rows
    for row in rows:
        assert row.total == 1.0 and row.n_classes == 4
        assert row.is_likeliest and row.in_range
