"""Every registered query with oracle SQL, compared value by value at the smallest scale."""

import os

import pytest

import __spark_entry__ as entry
from workload.check import compare, oracle_connection

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


@needs_data
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, con, name):
    result = compare(spark, con, SF_DIR, name, QUERIES[name], ORACLES[name])
    assert result.startswith("ok"), result


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@needs_data
def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
