"""Every registered query against its SQL in an independent engine."""

import pytest

import __spark_entry__ as contract
from groundline.plans.queries import QUERIES
from tools.check import check, connect


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, sf_dir, name):
    assert check(spark, connection, sf_dir, name) is None


def test_every_query_but_the_approximate_one_has_sql():
    assert set(QUERIES) - set(contract.oracle_sql()) == {"search_approx"}


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert rows and all("Question: " in r.prompt for r in rows)
