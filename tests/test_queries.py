"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as contract
from respondry.plans import catalogue, oracle
from tests.compare import difference, duck_result, spark_result

QUERIES, SQL = contract.queries(), contract.oracle_sql()


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(oracle.oracle_sql()) == set(catalogue.QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, connection, sf_dir, name):
    actual = spark_result(QUERIES[name](spark, sf_dir))
    assert difference(duck_result(connection, SQL[name]), actual) == ""


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() == 3
    assert df.columns[0] == "overall_risk_level"
