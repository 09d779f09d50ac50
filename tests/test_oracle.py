"""Every registered query against the SQL that states the same result, on the small tables."""
import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, compare

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf, name):
    message, _ = compare(spark, con, name, QUERIES[name], ORACLES.get(name), sf)
    assert "BAD" not in message, message


def test_entry(spark):
    assert entry.entry(spark).count() > 0
