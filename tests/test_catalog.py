"""Every query with a SQL twin, in both engines, on the smallest tables."""

import duckdb
import pytest

import catalog
from catalog.check import TABLES, compare


@pytest.fixture(scope="module")
def other_engine(folder):
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_same_rows_in_both_engines(spark, folder, other_engine, name):
    frame = catalog.queries()[name](spark, folder)
    problem, _ = compare(frame, catalog.oracle_sql()[name], other_engine)
    assert problem == ""
