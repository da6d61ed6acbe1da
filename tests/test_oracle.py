"""Every registered query next to its SQL twin, on whole tables."""

import pytest

import __spark_entry__ as entry
from workloads import registry
from compare import compare, duck

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


def test_entry_runs(spark):
    assert entry.entry(spark).columns[0] == "segment"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, sf, name):
    result = compare(spark, con, name, sf, QUERIES, ORACLES)
    assert result.startswith("ok") and "TYPES" not in result, result
