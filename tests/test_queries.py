"""Every registered query against its SQL on DuckDB; queries without SQL must return rows."""

import pytest
from check_oracles import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, duck, name):
    problem = compare(queries()[name](spark, SF_DIR), duck, oracle_sql()[name])
    assert problem in (None, "equal only within 1e-8"), problem


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_returns_rows(spark, name):
    assert not queries()[name](spark, SF_DIR).isEmpty()


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
