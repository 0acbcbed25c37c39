"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql
from affinia.catalog.queries import QUERIES
from check import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    outcome = compare(spark, connection, name, SF_DIR)
    assert outcome.startswith("ok") and outcome != "ok, 0 rows"


def test_entry(spark):
    assert entry(spark).count() > 0
