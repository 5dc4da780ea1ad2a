"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
import registry
from tests import oracle

registry.load()
QUERIES, SQL = registry.QUERIES, registry.ORACLES


@pytest.fixture(scope="module")
def con():
    return oracle.connect("/root/testdata/sf0.001")


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(SQL) <= set(entry_module.oracle_sql())


def test_flagship(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf, name):
    columns, rows = oracle.spark_bag(QUERIES[name](spark, sf))
    expected_columns, expected = oracle.sql_bag(con, SQL[name])
    assert columns == expected_columns
    assert rows == expected
    assert sum(rows.values()) > 0
