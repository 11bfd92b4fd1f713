"""A mixed landing is read and parsed once; what is staged is what each entity's own way gives."""

import json

import pytest
from conftest import at, item, page, payment, rows_of, sale
from pyspark.sql import functions as F
from test_plans import plan_of

from tillmart.entities import ENTITIES
from tillmart.functions.records import to_raw
from tillmart.plans.staging import UNKNOWN, landed_names, staged_rows
from tillmart.schemas import BRANCHES, PAGES
from tillmart.sources.pages import unnest_pages
from tillmart.sources.selection import project_fields

CONFIG = [("001", "s1", "Uno", True, None, None), ("b2", "s2", "Dos", True, None, None), ("b3", "s3", "Tres", False, None, None)]
COLUMNS = ["branch_id", "ingest_seq", "source_id", "extracted_at", "payload", "source_updated_at", "payload_checksum", "reject_reason", "bad_date"]


def expense(id, **attributes):
    links = {"user": {"data": {"id": "4"}}, "other": {"data": {"id": "5"}}}
    return {"id": id, "type": "Expense", "extra": 1, "attributes": {"amount": 1.0, "secret": "x", **attributes}, "relationships": links}


def landing():
    pages = [("001", "roles", 1, page({"id": "r", "attributes": {"name": "Zoë"}}, {"attributes": {}}))]
    pages += [("001", "items", 1, page(item("1", createdAt="never"), item(None), "no object", item(5, price=1.0))), ("b2", "items", 2, "<html>")]
    pages += [("b2", "sales", 1, page(sale("1", closedAt="2024-01-03T00:00:00Z"), {"id": "2", "attributes": [1]})), ("b2", "sales", None, page(sale("3")))]
    pages += [("001", "payments", 1, page(payment("1"))), ("001", "payment-methods", 1, page({"id": "1", "attributes": {"createdAt": "2024-01-01"}}))]
    pages += [("001", "expenses", 1, page(expense("1"), expense("2", date="2024-01-01"), {"attributes": {}}, {"id": None}, {"id": "3", "type": "Expense"}, [1]))]
    pages += [("b2", "expense-categories", 1, page({"id": "7", "attributes": {"name": "n", "secret": 1}}))]
    pages += [("b2", "kitchens", 1, page()), ("b2", "rooms", 1, None), ("b3", "roles", 1, page({"id": "1"}))]
    strange = [("zz", "roles", 1, page({"id": "1"})), ("001", "coupons", 1, page({"id": "1"})), ("001", None, 1, page({"id": "1"}))]
    return [(*p, at(1)) for p in pages], [(*p, at(1)) for p in strange]


@pytest.fixture
def frames(spark):
    known, strange = landing()
    return spark.createDataFrame(known + strange, PAGES), spark.createDataFrame(CONFIG, BRANCHES)


def test_staged_rows_are_those_of_each_entity(spark, frames):
    pages, config = frames
    staged = staged_rows(pages, config, at(2))
    active = pages.where("branch_id IN ('001', 'b2')")
    for entity in ENTITIES.values():
        rows = to_raw(project_fields(unnest_pages(active.where(F.col("entity") == entity.name)), entity), entity, at(2))
        mine = staged.where((F.col("entity") == entity.name) & ((F.col("pos") >= 0) | F.col("reject_reason").isNotNull()))
        told, want = (rows_of(df.where("reject_reason IS NULL"), *COLUMNS) for df in (mine, rows))
        if entity.requested:
            # Which fields stay is the same; the order in which they are printed need not be.
            told, want = ([(*r[:4], json.loads(r[4]), r[5], r[7]) for r in found] for found in (told, want))
        assert told == want, (entity.name, [r for r in told if r not in want], [r for r in want if r not in told])
        assert rows_of(mine.where("reject_reason IS NOT NULL"), "branch_id", "ingest_seq", "reject_reason", "page_md5") == rows_of(
            rows.where("reject_reason IS NOT NULL"), "branch_id", "ingest_seq", "reject_reason", "page_md5"
        )


def test_pages_are_counted_and_strangers_kept(frames):
    pages, config = frames
    staged = staged_rows(pages, config, at(2))
    counted = rows_of(staged.where(F.col("pos") < 0).where(F.col("entity") != UNKNOWN), "branch_id", "entity", "page_no", "page_records")
    assert ("001", "items", 1, 4) in counted and ("b2", "kitchens", 1, 0) in counted and ("b2", "items", 2, 0) in counted
    assert len(counted) == 11
    assert landed_names(staged) == (
        {"roles", "items", "sales", "payments", "payment-methods", "expenses", "expense-categories", "kitchens", "rooms"}, {"coupons", ""}, {"zz"}
    )


def test_one_scan_and_one_parse_for_all_entities(spark, tmp_path, frames):
    pages, config = frames
    pages.write.parquet(f"{tmp_path}/pages")
    plan = plan_of(staged_rows(spark.read.schema(PAGES).parquet(f"{tmp_path}/pages"), config, at(2)))
    assert plan.count("FileScan parquet") == 1
    assert plan.count("from_json(") == 1 and plan.count("parseJson(") == 1


def test_attributes_that_are_no_object_are_rejected_and_not_cut_away(spark):
    pages = spark.createDataFrame([("001", "expenses", 1, page({"id": "3", "attributes": [1]}), at(1))], PAGES)
    rows = staged_rows(pages, spark.createDataFrame(CONFIG, BRANCHES), at(2)).where("pos >= 0")
    assert rows_of(rows, "source_id", "reject_reason") == [("3", "bad_attributes")]
