"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

from adlift.oracle import ORACLE
from adlift.queries import QUERIES
from conftest import SF_SMALL
from oracle_compare import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_keys_match():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, SF_SMALL)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r
