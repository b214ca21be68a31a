"""Every registered query against its DuckDB oracle on the smallest scale factor."""

import pytest

from fleetwarden.plans.oracle import oracle_sql
from fleetwarden.plans.registry import QUERIES
from tools.oracle_check import compare, duck

from .conftest import SF_SMALL

SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    problems, n, _, _ = compare(spark, con, name, QUERIES[name], SQL[name], SF_SMALL)
    assert not problems, problems
