"""Every registered query against its DuckDB twin; the others must give rows."""

from __future__ import annotations

import pytest
from oracle import compare, connect

import __spark_entry__ as entry_module

QUERIES = entry_module.queries()
ORACLES = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_duckdb(spark, sf_dir, duck, name):
    assert compare(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    result = entry_module.entry(spark)
    assert {"split", "f1", "accuracy"} <= set(result.columns)
    assert result.count() == 3
