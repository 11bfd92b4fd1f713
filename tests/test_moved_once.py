"""Payloads and JSON are large beside what they are made of: they are moved as seldom as can be."""

import pytest
from conftest import at, page, rows_of, sale
from pyspark.sql import functions as F
from test_run import go, warehouse  # noqa: F401

from parity import fixtures as fx
from parity.operator_queries import QUERIES, second_sales_load
from parity.stored_queries import pages_of
from tillmart.entities import ENTITIES
from tillmart.plans import load, parts, raw_store

SALES = ENTITIES["sales"]


def optimized(df) -> list[str]:
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def at_line(lines: list[str], text: str) -> int:
    return next(n for n, line in enumerate(lines) if text in line)


@pytest.fixture
def written(monkeypatch):
    """Plans of what is written to tables in parts, and how often staged rows were joined to their changes."""
    plans, joins = [], []
    write, join = parts.PartTable._write, load.with_payload
    monkeypatch.setattr(parts.PartTable, "_write", lambda self, rows, *more: plans.append(optimized(rows)) or write(self, rows, *more))
    monkeypatch.setattr(load, "with_payload", lambda *sides: joins.append(1) or join(*sides))
    return plans, joins


def test_leaves_are_taken_out_where_rows_are_written(warehouse, written):  # noqa: F811
    assert go(warehouse, at(2), [("001", "sales", 1, page(sale("1"), sale("2")))], marts=[]).ok
    (plan,), _ = written
    assert at_line(plan, "from_json") < at_line(plan, "RebalancePartitions")


def test_first_loads_and_landings_of_their_own_are_not_joined(warehouse, written):  # noqa: F811
    _, joins = written
    both = [("001", "sales", 1, page(sale("1", comment="a"), sale("2", comment="a")), at(1)), ("001", "sales", 1, page(sale("1", comment="b"), sale("2", comment="b")), at(2))]
    assert go(warehouse, at(3), both, marts=[]).ok
    assert rows_of(raw_store.read_raw(warehouse, SALES), "source_id", "doc.attributes.comment", "extracted_at") == [("1", "b", at(2).replace(tzinfo=None)), ("2", "b", at(2).replace(tzinfo=None))]
    assert joins == []
    assert go(warehouse, at(4), [("001", "sales", 1, page(sale("1", comment="c"), sale("2", comment="b")), at(4))], marts=[]).ok
    assert rows_of(raw_store.read_raw(warehouse, SALES), "source_id", "doc.attributes.comment") == [("1", "c"), ("2", "b")]
    assert joins == [1]


def test_held_rows_stay_where_they_lie(spark, warehouse, written):  # noqa: F811
    """Of the rows of touched parts only keys are shuffled, even if the keys of a load are too many to be broadcast; the rows are marked right."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    ids = [str(i) for i in range(300)]
    assert go(warehouse, at(2), [("001", "sales", 1, page(*[sale(i, comment="old") for i in ids]))], marts=[]).ok
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "30k")
        assert go(warehouse, at(3), [("001", "sales", 1, page(*[sale(i, comment="new" if int(i) % 3 == 0 else "old") for i in ids]))], marts=[]).ok
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    plan = written[0][-1]
    assert not any("source_id" in line for line in plan if "Join" in line)
    assert rows_of(raw_store.read_raw(warehouse, SALES), "source_id", "doc.attributes.comment") == sorted((i, "new" if int(i) % 3 == 0 else "old") for i in ids)
    warehouse.refresh()
    assert sorted(r.source_id for r in raw_store.read_history(warehouse, SALES).collect()) == sorted(i for i in ids if int(i) % 3 == 0)


def test_tables_are_packed(spark, warehouse):  # noqa: F811
    assert go(warehouse, at(2), [("001", "sales", 1, page(sale("1")))], marts=[]).ok
    files = [r.f for r in raw_store.read_raw(warehouse, SALES).select(F.col("_metadata.file_name").alias("f")).collect()]
    assert all(f.endswith(".zstd.parquet") for f in files)


@pytest.fixture
def orders(spark, tmp_path):
    made = spark.range(1_200).select(
        F.when(F.col("id") != 7, F.col("id") - 100).alias("o_orderkey"), (F.col("id") % 9).alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        F.lit(1.5).alias("o_totalprice"), F.lit("1998-01-01").cast("timestamp").alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"),
    )
    made.write.parquet(str(tmp_path / "orders.parquet"))
    return spark.read.parquet(str(tmp_path / "orders.parquet"))


def test_pages_are_dealt_out_before_they_are_json(spark, tmp_path, orders):
    dealt = fx.by_page(spark, str(tmp_path), "orders", "o_orderkey")
    for near, far in ((fx.sales_of(dealt(orders)), fx.sales_of(orders)), (second_sales_load(orders, dealt), second_sales_load(orders))):
        pages = pages_of(near, "sales")
        assert rows_of(pages, "branch_id", "page_no", "body") == rows_of(pages_of(far, "sales"), "branch_id", "page_no", "body")
        plan = pages._jdf.queryExecution().executedPlan().toString().splitlines()
        exchanges, lists = ([n for n, line in enumerate(plan) if word in line] for word in ("Exchange", "collect_list"))
        # Lists of records are begun and ended above the only exchange.
        assert len(exchanges) == 1 and lists and max(lists) < exchanges[0]


def test_turned_records_are_made_without_variants(spark, tmp_path):
    spark.sql(
        "SELECT 7L l_orderkey, 3L l_partkey, 2L l_suppkey, 1 l_linenumber, 4D l_quantity, 9.5D l_extendedprice, 0.1D l_discount, 0D l_tax, 'R' l_returnflag, 'F' l_linestatus, TIMESTAMP '1998-01-01 00:00:00' l_shipdate"
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    lines = spark.read.parquet(str(tmp_path / "lineitem.parquet"))
    row = fx.items_of(lines, turned=True).first()
    assert row.record.startswith('{"id":') and row.turned.startswith('{"relationships":{"subitems":') and len(row.record) == len(row.turned)
    assert fx.items_of(lines).columns == ["branch_id", "extracted_at", "ingest_seq", "record"]
    found = QUERIES["raw_payload_checksum"](spark, str(tmp_path))
    # Printing a variant costs most of a record's time: it is done once for each of the two checksums.
    assert "from_json" not in "".join(optimized(found))
    assert rows_of(found, "branch_id", "records", "same_in_other_order", "contents") == [("branch_2", 1, 1, 1)]
