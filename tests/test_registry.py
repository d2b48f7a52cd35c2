"""Every registered query runs, and agrees with its SQL where it has one."""

import pytest

import __spark_entry__ as contract
from tests.oracle import compare, connect

SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, folder, con, name):
    df = contract.queries()[name](spark, folder)
    if name in SQL:
        _, problems = compare(df, con, SQL[name])
        assert problems == []
    else:
        assert df.columns


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_names():
    assert set(SQL) <= set(contract.queries())
