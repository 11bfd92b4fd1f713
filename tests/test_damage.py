"""Damaged landings: nothing is lost without a word, and nothing counts as loaded that is not there."""

import json

import pytest
from conftest import at, item, page, rows_of, sale
from test_landing import land
from test_run import audit_of, go, mart, warehouse  # noqa: F401

from tillmart.entities import ENTITIES
from tillmart.plans import raw_store
from tillmart.plans.load import UNFINISHED_TABLE, LoadOptions, read_rejects
from tillmart.plans.run import STATUS_TABLE
from tillmart.schemas import STATUS, UNFINISHED
from tillmart.sources.pages import PAGE_SIZE, read_page_files, read_page_lines, unnest_pages
from tillmart.plans.quarantine import held_pages
from tillmart.streaming.landing import follow_pages


def held(warehouse, entity, *columns):  # noqa: F811
    return rows_of(raw_store.read_raw(warehouse, ENTITIES[entity]), *columns)


def advanced(warehouse):  # noqa: F811
    return rows_of(warehouse.read(STATUS_TABLE, STATUS), "branch_id", "entity")


@pytest.mark.parametrize("incremental", [False, True])
def test_bad_pages_fail_their_branch(warehouse, incremental):  # noqa: F811
    assert go(warehouse, at(2), [("001", "sales", 1, page(sale("0")))], marts=[]).ok
    pages = [
        ("001", "sales", None, page(sale("1"), sale("2"))),
        ("b2", "sales", 1, "<html>oops"),
        ("b2", "sales", 2, page(sale("3"))),
        ("b2", "items", 1, page(item("1"), item(None))),
        ("001", "items", 1, page(item("1"))),
    ]
    report = go(warehouse, at(3), pages, options=LoadOptions(incremental=incremental), marts=[])
    assert report.not_loaded == {("001", "sales"): "FAILED", ("b2", "sales"): "FAILED", ("b2", "items"): "FAILED"} and not report.ok
    assert held(warehouse, "sales", "source_id", "branch_id") == [("0", "001")]
    assert held(warehouse, "items", "source_id", "branch_id") == [("1", "001")]
    assert advanced(warehouse) == [("001", "items"), ("001", "sales")]
    reasons = rows_of(read_rejects(warehouse, ENTITIES["sales"]), "branch_id", "page_no", "reject_reason")
    assert reasons == [("001", -1, "bad_page"), ("b2", 1, "bad_page")]


def test_missing_and_short_pages_are_incomplete(warehouse):  # noqa: F811
    full = page(*[sale(str(i)) for i in range(PAGE_SIZE)])
    pages = [("001", "sales", 1, full), ("001", "sales", 3, page(sale("x"))), ("b2", "sales", 1, page(sale("1"))), ("b2", "sales", 2, page(sale("2")))]
    report = go(warehouse, at(2), pages, marts=[])
    assert report.not_loaded == {("001", "sales"): "INCOMPLETE", ("b2", "sales"): "INCOMPLETE"}
    assert len(held(warehouse, "sales", "source_id")) == PAGE_SIZE + 3 and advanced(warehouse) == []


def test_incremental_load_keeps_what_has_no_date(warehouse):  # noqa: F811
    assert go(warehouse, at(2), [("001", "sales", 1, page(sale("0")))], marts=[]).ok
    pages = [("001", "sales", 1, page(sale("1", createdAt="soon"), sale("2", createdAt=None), sale("3", createdAt="2020-01-01T00:00:00Z")))]
    assert go(warehouse, at(3), pages, options=LoadOptions(incremental=True), marts=[]).ok
    assert held(warehouse, "sales", "source_id") == [("0",), ("1",), ("2",)]


@pytest.mark.parametrize("turned", [False, True])
def test_of_two_landings_the_later_counts(warehouse, turned):  # noqa: F811
    pages = [
        ("001", "sales", 1, page(sale("1", saleState="OPEN")), at(1, 5)),
        ("001", "sales", 1, page(sale("1", saleState="CLOSED")), at(1, 6)),
        ("001", "items", 1, page(item("1", price=10.0)), at(1, 5)),
        ("001", "items", 1, page(item("1", price=11.0)), at(1, 6)),
    ]
    assert go(warehouse, at(2), pages[::-1] if turned else pages).ok
    assert held(warehouse, "sales", "doc.attributes.saleState") == [("CLOSED",)]
    assert mart(warehouse, "sales_order_line", "price_from_api") == [(11.0,)]
    assert audit_of(warehouse, at(2))[0][:4] == ("001", "items", 2, 2)


def test_pages_of_unknown_branches_are_reported(warehouse):  # noqa: F811
    report = go(warehouse, at(2), [("zz", "sales", 1, page(sale("1"))), ("b3", "sales", 1, page(sale("1")))], marts=[])
    assert list(report.load_errors) == ["unknown branch"] and report.load_errors["unknown branch"].endswith(": zz")


def test_pages_without_a_number_can_be_read(spark, tmp_path):
    folder = tmp_path / "files" / "branch_id=b" / "entity=sales"
    folder.mkdir(parents=True)
    (folder / "latest.json").write_text(page(sale("1")))
    (folder / "page-1.json").write_text(page(sale("2")))
    found = unnest_pages(read_page_files(spark, str(tmp_path / "files")))
    assert rows_of(found, "page_no", "page_error") == [(1, None), (None, "bad_page")]
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.json").write_text(json.dumps({"branch_id": "b", "entity": "sales", "body": {"data": []}}))
    assert rows_of(unnest_pages(read_page_lines(spark, str(tmp_path / "lines"))), "page_error") == [("bad_page",)]


def test_stream_loses_no_branch(warehouse, spark, tmp_path):  # noqa: F811
    pages = tmp_path / "pages"
    land(pages, "1.json", "roles", {"attributes": {}}, sale("1"), sale(None))
    text = (pages / "1.json").read_text().replace('"b"', '"b2"')
    (pages / "1.json").write_text(text)

    def follow(**options):
        follow_pages(spark, str(pages), warehouse.root, marts=[], **options).awaitTermination()
        warehouse.refresh()

    follow(options=LoadOptions(on_reject="batch"))
    assert held(warehouse, "roles", "source_id") == []
    assert rows_of(held_pages(warehouse), "branch_id", "entity", "page_no") == [("b2", "roles", 1)]
    # Taken up again with the next files, whatever these are.
    land(pages, "2.json", "items", item("1"))
    (pages / "2.json").write_text((pages / "2.json").read_text().replace('"b"', '"b2"'))
    follow()
    assert held_pages(warehouse).isEmpty() and held(warehouse, "items", "source_id") == [("1",)]
    first = held(warehouse, "roles", "source_id")
    assert len(first) == 2
    # Tried again from the start, the record without an id gets the same one.
    follow(checkpoint=str(tmp_path / "again"))
    assert held(warehouse, "roles", "source_id") == first


def test_bad_branch_holds_up_nobody(warehouse, spark, tmp_path):  # noqa: F811
    """Its page stays aside over several batches, gives way when it lands again, and is loaded then, once."""
    pages, reports = tmp_path / "pages", []

    def land_pages(name, *lines):
        pages.mkdir(exist_ok=True)
        (pages / name).write_text("\n".join(json.dumps(dict(zip(("branch_id", "entity", "page_no", "body"), line))) for line in lines))
        follow_pages(spark, str(pages), warehouse.root, marts=[], options=LoadOptions(on_reject="batch"), reports=reports).awaitTermination()
        warehouse.refresh()

    full = {"data": [sale(str(i)) for i in range(PAGE_SIZE)]}
    land_pages("1.json", ("001", "sales", 1, full), ("001", "sales", 2, {"data": [sale(None)]}), ("b2", "sales", 1, {"data": [sale("1")]}), ("zz", "sales", 1, {"data": [sale("9")]}))
    assert reports[-1].not_loaded == {("001", "sales"): "FAILED"} and list(reports[-1].load_errors) == ["unknown branch"]
    assert held(warehouse, "sales", "branch_id", "source_id") == [("b2", "1")]
    land_pages("2.json", ("b2", "sales", 1, {"data": [sale("2")]}))
    assert held(warehouse, "sales", "branch_id", "source_id") == [("b2", "1"), ("b2", "2")]
    assert rows_of(held_pages(warehouse), "branch_id", "entity", "page_no") == [("001", "sales", 1), ("001", "sales", 2), ("zz", "sales", 1)]
    land_pages("3.json", ("001", "sales", 2, {"data": [sale("x")]}))
    assert reports[-1].not_loaded == {} and rows_of(held_pages(warehouse), "branch_id") == [("zz",)]
    assert raw_store.read_raw(warehouse, ENTITIES["sales"]).where("branch_id = '001'").count() == PAGE_SIZE + 1
    assert advanced(warehouse) == [("001", "sales"), ("b2", "sales")]


def test_page_set_is_complete_when_its_last_page_comes(warehouse):  # noqa: F811
    full = lambda n: page(*[sale(f"{n}-{i}") for i in range(PAGE_SIZE)])
    assert go(warehouse, at(2), [("001", "sales", 1, full(1)), ("b2", "sales", 1, page(sale("1")))], marts=[]).not_loaded == {("001", "sales"): "INCOMPLETE"}
    assert advanced(warehouse) == [("b2", "sales")]
    assert go(warehouse, at(3), [("001", "sales", 3, page(sale("x")))], marts=[]).not_loaded == {("001", "sales"): "INCOMPLETE"}
    # A page that can't be read fails the load, and what had come before is not forgotten.
    assert go(warehouse, at(4), [("001", "sales", 2, "<html>oops")], marts=[]).not_loaded == {("001", "sales"): "FAILED"}
    assert go(warehouse, at(5), [("001", "sales", 2, full(2))], marts=[]).ok
    assert advanced(warehouse) == [("001", "sales"), ("b2", "sales")]
    assert warehouse.read(UNFINISHED_TABLE, UNFINISHED).isEmpty()
    # The next set starts afresh.
    assert go(warehouse, at(6), [("001", "sales", 2, page(sale("y")))], marts=[]).not_loaded == {("001", "sales"): "INCOMPLETE"}
    assert go(warehouse, at(7), [("001", "sales", 1, page(sale("z")))], marts=[]).ok
