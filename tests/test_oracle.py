"""Every registered query against its SQL."""

import pytest
from oracle_compare import connect, difference

from matchboard.registry.oracle import ORACLE
from matchboard.registry.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, FOLDER), con, ORACLE[name]) is None
