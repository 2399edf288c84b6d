"""Every registered query against its SQL, and rows for those without one."""

import pytest

import __spark_entry__ as entry
from tests.compare import difference, oracle_rows, spark_rows

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, folder, oracle, name):
    got = spark_rows(QUERIES[name](spark, folder))
    assert difference(got, oracle_rows(oracle, ORACLES[name])) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, folder, name):
    assert QUERIES[name](spark, folder).count() > 0


def test_flagship(spark):
    assert {"account", "txn_id", "running_balance"} <= set(entry.entry(spark).columns)
