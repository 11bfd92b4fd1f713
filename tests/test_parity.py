"""Every registered query against its SQL, on the small supplied tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from parity.queries import oracle_sql, queries

SF_DIR = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def by_column_name(columns, rows):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_sql(spark, oracle, name):
    df = queries()[name](spark, SF_DIR)
    result = oracle.execute(oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert by_column_name(df.columns, [tuple(r) for r in df.collect()]) == by_column_name(columns, result.fetchall())


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


def test_entry(spark):
    assert entry_points.entry(spark).columns[0] == "id_order_line_source"
