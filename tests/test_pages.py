"""Pages: unnesting, completeness, selection."""

import json

from conftest import at, item, page, rows_of, sale
from pyspark.sql import functions as F

from tillmart.entities import ENTITIES
from tillmart.schemas import BRANCHES, PAGES, STATUS
from tillmart.sources.pages import (
    page_completeness,
    read_page_files,
    read_page_lines,
    read_page_parquet,
    split_by_entity,
    unnest_pages,
)
from tillmart.sources.selection import active_branches, incremental_filter, incremental_filter_by_status, project_fields


def pages_of(spark, *rows):
    return spark.createDataFrame([r if len(r) == 5 else (*r, None) for r in rows], PAGES)


def test_unnest(spark):
    pages = pages_of(
        spark,
        ("b", "sales", 1, page(sale("1"), sale("2"))),
        ("b", "sales", 2, page(sale("3"))),
        ("b", "sales", 3, '{"meta": 1}'),
        ("b", "sales", 4, '{"data": []}'),
        ("b", "sales", 5, "<html>"),
        ("b", "sales", 6, '{"data": {"id": "9"}}'),
        ("b", "sales", 7, ""),
        ("b", "sales", 8, None),
    )
    got = unnest_pages(pages).select("page_no", "pos", F.get_json_object("record", "$.id"), "page_error")
    assert rows_of(got, "*") == [
        (1, 0, "1", None), (1, 1, "2", None), (2, 0, "3", None),
        (5, 0, None, "bad_page"), (6, 0, None, "bad_page"), (7, 0, None, "bad_page"), (8, 0, None, "bad_page"),
    ]
    order = [r.record for r in unnest_pages(pages).where("page_error IS NULL").orderBy("ingest_seq").collect()]
    assert [json.loads(r)["id"] for r in order] == ["1", "2", "3"]


def test_unnest_keeps_values_as_they_are(spark):
    record = {"id": "1", "attributes": {"a": 3.0, "b": 3, "c": "é\"x", "d": None, "e": [1, {"f": 2.5}]}}
    assert json.loads(unnest_pages(pages_of(spark, ("b", "sales", 1, page(record)))).first().record) == record


def summary(spark, *pages, size=2):
    columns = ["pages", "records", "last_page_size", "short_pages_before_last", "missing_pages", "bad_pages", "is_complete"]
    return rows_of(page_completeness(pages_of(spark, *pages), size), *columns)


def test_completeness(spark):
    full, short, empty = page(sale("1"), sale("2")), page(sale("3")), page()
    assert summary(spark, ("b", "s", 1, full), ("b", "s", 2, short)) == [(2, 3, 1, 0, 0, 0, True)]
    assert summary(spark, ("b", "s", 1, full), ("b", "s", 2, empty)) == [(2, 2, 0, 0, 0, 0, True)]
    assert summary(spark, ("b", "s", 1, short), ("b", "s", 2, short)) == [(2, 2, 1, 1, 0, 0, False)]
    assert summary(spark, ("b", "s", 1, full), ("b", "s", 3, short)) == [(2, 3, 1, 0, 1, 0, False)]
    assert summary(spark, ("b", "s", 1, full)) == [(1, 2, 2, 0, 0, 0, False)]
    assert summary(spark, ("b", "s", 1, "x")) == [(1, 0, 0, 0, 0, 1, False)]


def test_readers_agree(spark, tmp_path):
    bodies = {1: page(item("1", price=3.0)), 2: page(item("2"))}
    lines = [json.dumps({"branch_id": "001", "entity": "items", "page_no": n, "body": json.loads(b)}) for n, b in bodies.items()]
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.json").write_text("\n".join(lines))
    folder = tmp_path / "files" / "branch_id=001" / "entity=items"
    folder.mkdir(parents=True)
    for n, body in bodies.items():
        (folder / f"page-{n:05d}.json").write_text(body)
    from_lines = read_page_lines(spark, str(tmp_path / "lines"))
    from_files = read_page_files(spark, str(tmp_path / "files"))
    from_lines.write.parquet(str(tmp_path / "packed"))
    packed = read_page_parquet(spark, str(tmp_path / "packed"))
    columns = ["branch_id", "entity", "page_no", "pos", "ingest_seq", "record", "page_error"]
    expected = rows_of(unnest_pages(from_files), *columns)
    assert len(expected) == 2 and expected[0][0] == "001" and '"price":3.0' in expected[0][5]
    assert rows_of(unnest_pages(from_lines), *columns) == expected == rows_of(unnest_pages(packed), *columns)
    assert all(unnest_pages(x).where("extracted_at IS NULL").isEmpty() for x in (from_lines, from_files, packed))


def test_pages_by_entity_are_pruned(spark, tmp_path):
    folder = tmp_path / "lines" / "entity=items"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text(json.dumps({"branch_id": "b", "page_no": 1, "body": {"data": [item("1")]}}))
    landed = read_page_lines(spark, str(tmp_path / "lines"))
    assert rows_of(landed, "branch_id", "entity", "page_no") == [("b", "items", 1)]
    mixed = pages_of(spark, ("b", "items", 1, page(item("1"))), ("b", "sales", 1, page(sale("1"))), ("c", "sales", 1, "x"))
    split = split_by_entity(mixed, str(tmp_path / "split"))
    assert rows_of(split, *PAGES.fieldNames()) == rows_of(mixed, *PAGES.fieldNames())
    for pages in (landed, split):
        plan = pages.where("entity = 'items'")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(entity" in plan


def test_active_branches(spark):
    config = spark.createDataFrame([("a", "s1", "A", True, None, None), ("b", "s2", "B", False, None, None)], BRANCHES)
    assert rows_of(active_branches(config), "*") == [("a", "s1", "A")]


def records_of(spark, *records):
    rows = [("b", i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(records)]
    return spark.createDataFrame(rows, "branch_id string, ingest_seq bigint, record string")


def test_projection_of_fields(spark):
    record = {
        "id": "1", "type": "Expense", "links": {"self": "x"},
        "attributes": {"amount": 1.5, "note": "n", "status": None},
        "relationships": {"user": {"data": {"id": "2"}}, "audit": {"data": []}},
    }
    cut = project_fields(records_of(spark, record, "oops", '{"id":null}'), ENTITIES["expenses"])
    got = [r.record for r in cut.orderBy("ingest_seq").collect()]
    assert json.loads(got[0]) == {
        "id": "1", "type": "Expense", "attributes": {"amount": 1.5, "status": None}, "relationships": {"user": {"data": {"id": "2"}}}
    }
    assert got[1] == "oops"
    assert json.loads(got[2]) == {"id": None}
    whole = records_of(spark, record)
    assert project_fields(whole, ENTITIES["items"]) is whole


def test_incremental_filters(spark):
    records = records_of(spark, sale("1", createdAt="2024-01-02T00:00:00Z"), sale("2", createdAt="2024-01-04T00:00:00Z"), sale("3", createdAt=None))
    sales = ENTITIES["sales"]
    # The record without a date may be new, so it stays.
    assert rows_of(incremental_filter(records, sales, at(4)), "ingest_seq") == [(1,), (2,)]
    assert incremental_filter(records, sales, None).count() == 3
    assert incremental_filter(records, ENTITIES["items"], at(4)).count() == 3
    known = spark.createDataFrame([("b", "sales", at(3)), ("b", "items", at(9))], STATUS)
    assert rows_of(incremental_filter_by_status(records, sales, known), "ingest_seq") == [(1,), (2,)]
    other = spark.createDataFrame([("c", "sales", at(3))], STATUS)
    assert incremental_filter_by_status(records, sales, other).count() == 3
