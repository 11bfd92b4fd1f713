"""Joins whose right side is a whole table: it must not be sent to the driver, however small Spark takes it to be."""

import pytest
from conftest import at, payment, sale

from tillmart.entities import ENTITIES
from tillmart.operators.merge import changed_records, new_versions
from tillmart.plans.load import staged_changes
from tillmart.plans.marts import payments_with_sale, payments_without_sale
from tillmart.schemas import RECORDS


@pytest.fixture
def written(raw, spark, tmp_path):
    """Raw rows that lie in a file, whose size Spark knows."""

    def build(name, *rows):
        path = str(tmp_path / f"{name}-{len(list(tmp_path.iterdir()))}")
        raw(name, *rows).write.parquet(path)
        return spark.read.parquet(path)

    return build


@pytest.fixture
def sales(written):
    return written("sales", ("b", at(1), 0, sale("1")), ("b", at(1), 1, sale("2")))


@pytest.fixture
def paid(written):
    return written("payments", ("b", at(1), 0, payment("1", sale_id="1")), ("b", at(1), 1, payment("2", sale_id="9")), ("b", at(1), 2, payment("3")))


def broadcasts(df) -> int:
    # Tables of a few rows, which Spark broadcasts wherever it may.
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin")


def test_sales_are_not_broadcast_to_payments(sales, paid):
    joined = payments_with_sale(paid, sales)
    assert broadcasts(joined) == 0
    assert {(r.id, r.has_sale) for r in joined.collect()} == {(1, True), (2, False), (3, False)}


def test_orphans_need_no_broadcast(sales, paid):
    orphans = payments_without_sale(paid, sales)
    assert broadcasts(orphans) == 0
    assert [r.id for r in orphans.collect()] == [2]


def test_held_records_are_not_broadcast_to_a_load(spark, sales, raw):
    batch = raw("sales", ("b", at(2), 0, sale("1", total=9.0)), ("b", at(2), 1, sale("2")), ("b", at(2), 2, sale("3")))
    changed = changed_records(sales, batch)
    assert broadcasts(changed) == 0
    assert {(r.source_id, r.action) for r in changed.collect()} == {("1", "update"), ("3", "insert")}
    records = spark.createDataFrame([("b", 0, '{"id":"1"}')], RECORDS)
    assert broadcasts(staged_changes(records, sales, ENTITIES["sales"], at(3))) == 0


def test_held_versions_are_not_broadcast_to_a_load(sales, raw):
    batch = raw("sales", ("b", at(2), 0, sale("1")), ("b", at(2), 1, sale("1", total=9.0)))
    new = new_versions(sales, batch)
    assert broadcasts(new) == 0
    assert [r.ingest_seq for r in new.collect()] == [1]
