"""Registered queries against their SQL on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from tillmart.llm.oracles import oracle_sql
from tillmart.llm.queries import queries

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result = connection.execute(oracle_sql()[name])
    columns = [c[0] for c in result.description]
    rounded = lambda row: repr([round(v, 6) if isinstance(v, float) else v for v in row])
    want = sorted(rounded(r) for r in result.fetchall())
    got = queries()[name](spark, SF_DIR)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(rounded(r) for r in got.select(*columns).collect()) == want


def test_every_operator_is_registered():
    names = entry_points.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
