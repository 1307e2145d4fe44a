"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, oracle_connection

QUERIES = {name: query for m in entry.CORE for name, query in m.QUERIES.items()}
ORACLES = {name: sql for m in entry.CORE for name, sql in m.ORACLES.items()}


@pytest.fixture(scope="module")
def oracle():
    with oracle_connection(entry.SMALLEST) as connection:
        yield connection


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    ours, theirs, same, note = compare(spark, oracle, QUERIES[name], ORACLES[name], entry.SMALLEST)
    assert same, (ours, theirs, note)


def test_entry(spark):
    assert entry.entry(spark).count() == 3
