"""Every registered query against its SQL, on the smallest tables."""

import pytest
from compare import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from changeflow.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, name, queries()[name], oracle_sql()[name]) == ""


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    frame = entry(spark)
    assert frame.columns == ["id", "first_name", "last_name", "email"]
    assert frame.count() > 0
