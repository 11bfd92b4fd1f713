"""Queries over stored tables learn their branches without making any JSON."""

import pytest

from parity import stored_queries

FULL_RUNS = sorted(set(stored_queries.QUERIES) - {"view_ordered"})


class Found(Exception):
    pass


@pytest.mark.parametrize("name", FULL_RUNS)
def test_branches_are_read_off_the_keys(spark, tmp_path, monkeypatch, name):
    spark.sql("SELECT 7L o_orderkey, 1L o_custkey, 'F' o_orderstatus, 1.5D o_totalprice, TIMESTAMP '1998-01-01 00:00:00' o_orderdate, '1-URGENT' o_orderpriority").write.parquet(
        str(tmp_path / "orders.parquet")
    )

    def caught(spark, named, root=None):
        rows = named.select("branch_id").distinct()
        plan = rows._jdf.queryExecution().optimizedPlan().toString().lower()
        raise Found("json" in plan, [r.branch_id for r in rows.collect()])

    monkeypatch.setattr(stored_queries, "warehouse_for", caught)
    with pytest.raises(Found) as found:
        stored_queries.QUERIES[name](spark, str(tmp_path))
    assert found.value.args == (False, ["branch_2"])
