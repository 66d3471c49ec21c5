"""Every query next to its SQL counterpart."""

import pytest

from checks.compare import compare, connect
from checks.oracle import all_sql
from colloquy.plans.catalog import all_queries

QUERIES = all_queries()


@pytest.fixture(scope="module")
def tables(small):
    return connect(small)


def test_every_query_has_sql():
    assert set(QUERIES) == set(all_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, small, name):
    same, note = compare(spark, tables, name, QUERIES[name], all_sql()[name], small)
    assert same, note
