"""Every registered query against its SQL twin; those without one must give rows."""

import pytest
from __spark_entry__ import entry, oracle_sql, queries
from oracle import connect, differences

QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sf_dir, duck, name):
    assert differences(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_types_have_a_spark_form(duck, name):
    """Sums of integers and fixed decimals would differ from Spark by type alone."""
    types = {r[1] for r in duck.execute("DESCRIBE " + ORACLES[name]).fetchall()}
    assert types <= {"BIGINT", "INTEGER", "DOUBLE", "VARCHAR", "BOOLEAN", "TIMESTAMP"}


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
