"""Every registered query against its oracle in DuckDB."""

import duckdb
import pytest
from conftest import SF

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, compare
from coverloom import catalog

SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_every_query_of_the_catalog_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracles())


@pytest.mark.parametrize("name", sorted(SQL))
def test_oracle(spark, con, name):
    result = compare(spark, con, name, queries()[name], SQL[name], SF)
    assert ": ok " in result and "TYPES" not in result, result


def test_entry(spark):
    assert entry(spark).count() > 0
