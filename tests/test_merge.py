"""Merges into raw, status and configuration tables."""

import pytest
from conftest import at, item, rows_of, sale
from pyspark.sql import functions as F

from tillmart.functions.payload import leaf, with_doc
from tillmart.operators.checks import (
    CheckFailed,
    assert_not_null,
    assert_unique,
    contract_report,
    evolve_schema,
    split_by_required,
    unique_violations,
)
from tillmart.operators.dedupe import latest_per_key, latest_per_key_by_max
from tillmart.operators.merge import (
    append_new_versions,
    changed_records,
    delete_by_key,
    last_extraction,
    merge_branches,
    set_last_extraction,
    upsert_latest,
)
from tillmart.schemas import BRANCHES, STATUS, Contract, struct


def test_same_content_again_is_not_added(raw):
    a = raw("items", ("b", at(1), 0, item("1")))
    b = raw("items", ("b", at(2), 0, item("1", price=11)))
    a_again = raw("items", ("b", at(3), 0, item("1")))
    table = append_new_versions(append_new_versions(a, b), a_again)
    assert table.count() == 2
    assert with_doc(latest_per_key(table), ["attributes.price"]).select(leaf("attributes.price")).first()[0] == "11"


def test_append_keeps_first_of_a_batch_and_old_rows(raw):
    held = raw("items", ("b", at(1), 5, item("1")))
    batch = raw("items", ("b", at(2), 7, item("1")), ("b", at(2), 9, item("2")), ("b", at(2), 8, item("2")), ("c", at(2), 1, item("1")))
    got = append_new_versions(held, batch).select("source_id", "branch_id", F.day("extracted_at"), "ingest_seq")
    assert rows_of(got, "*") == [("1", "b", 1, 5), ("1", "c", 2, 1), ("2", "b", 2, 8)]


def test_append_twice_adds_nothing(raw):
    batch = raw("items", *[("b", at(2), i, item(str(i % 3), price=i % 2)) for i in range(12)])
    once = append_new_versions(batch.limit(0), batch)
    twice = append_new_versions(once, batch)
    assert rows_of(once, *once.columns) == rows_of(twice, *once.columns)
    assert once.count() == 6


def upserted(df):
    parsed = with_doc(df, ["attributes.saleState"])
    return rows_of(parsed.select("source_id", F.day("extracted_at"), leaf("attributes.saleState")), "*")


def test_upsert_changes_only_what_differs(raw):
    held = raw("sales", ("b", at(1), 0, sale("1")), ("b", at(1), 1, sale("2")), ("b", at(1), 2, sale("3")))
    batch = raw("sales", ("b", at(2), 0, sale("1")), ("b", at(2), 1, sale("2", saleState="CANCELED")), ("b", at(2), 2, sale("4")))
    assert upserted(upsert_latest(held, batch)) == [("1", 1, "OPEN"), ("2", 2, "CANCELED"), ("3", 1, "OPEN"), ("4", 2, "OPEN")]
    changes = changed_records(held, batch)
    assert rows_of(changes, "source_id", "action") == [("2", "update"), ("4", "insert")]


def test_upsert_duplicates(raw):
    held = raw("sales", ("b", at(1), 0, sale("1")))
    batch = raw("sales", ("b", at(2), 0, sale("1", total=1)), ("b", at(2), 1, sale("1", saleState="CLOSED")))
    assert upserted(upsert_latest(held, batch)) == [("1", 2, "CLOSED")]
    with pytest.raises(Exception, match="more than once"):
        upsert_latest(held, batch, on_duplicate="error").collect()
    with pytest.raises(ValueError):
        upsert_latest(held, batch, on_duplicate="first")


def test_upsert_goes_back_to_old_content(raw):
    a, b = raw("sales", ("b", at(1), 0, sale("1"))), raw("sales", ("b", at(2), 0, sale("1", saleState="CLOSED")))
    back = raw("sales", ("b", at(3), 0, sale("1")))
    assert upserted(upsert_latest(upsert_latest(a, b), back)) == [("1", 3, "OPEN")]


def test_status(spark):
    status = spark.createDataFrame([("b", "sales", at(5)), ("b", "items", at(5))], STATUS)
    loaded = spark.createDataFrame([("b", "sales", at(3)), ("c", "sales", at(6))], STATUS)
    merged = set_last_extraction(status, loaded)
    assert rows_of(merged.select("branch_id", "entity", F.day("last_successful_extraction")), "*") == [
        ("b", "items", 5), ("b", "sales", 3), ("c", "sales", 6)
    ]
    assert last_extraction(merged, "c", "sales").count() == 1
    assert last_extraction(merged, "c", "items").count() == 0


def test_branch_config(spark):
    known = spark.createDataFrame([("a", "s1", "Old", False, at(1), at(1)), ("b", "s2", "Stay", True, at(1), at(1))], BRANCHES)
    seed = spark.createDataFrame([("a", "s9", "New"), ("c", "s3", "Fresh")], "branch_id string, source_branch string, branch_name string")
    merged = merge_branches(known, seed, F.lit(at(2)).cast("timestamp"))
    got = merged.select("branch_id", "source_branch", "branch_name", "is_active", F.day("created_at"), F.day("updated_at"))
    assert rows_of(got, "*") == [("a", "s9", "New", False, 1, 2), ("b", "s2", "Stay", True, 1, 1), ("c", "s3", "Fresh", True, 2, 2)]
    assert rows_of(delete_by_key(merged, "branch_id", "b"), "branch_id") == [("a",), ("c",)]


def test_delete_keeps_null_keys(spark):
    df = spark.createDataFrame([("a",), (None,)], "k string")
    assert rows_of(delete_by_key(df, "k", "a"), "k") == [(None,)]


def test_latest_forms_agree(raw):
    rows = raw("items", *[("b" if i % 2 else "c", at(1 + i % 5), i, item(str(i % 7), price=i)) for i in range(60)])
    assert rows_of(latest_per_key(rows), *rows.columns) == rows_of(latest_per_key_by_max(rows), *rows.columns)


def test_unique_and_required(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", None), (None, 1), (None, 2)], "k string, v int")
    assert rows_of(unique_violations(df, ["k"]), "k", "copies") == [("a", 2)]
    with pytest.raises(CheckFailed, match="not unique"):
        assert_unique(df, ["k"])
    assert_unique(df, ["k", "v"])
    with pytest.raises(CheckFailed, match="'v': 1"):
        assert_not_null(df, ["v"])
    complete, rejects = split_by_required(df, ["k", "v"])
    assert complete.count() == 2
    assert rows_of(rejects, "k", "v", "missing") == [("b", None, ["v"]), (None, 1, ["k"]), (None, 2, ["k"])]


def test_schema_evolution(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    wider = evolve_schema(df, struct("b:string c:double d:boolean"))
    assert wider.columns == ["a", "b", "c", "d"] and wider.first()[2] is None
    assert evolve_schema(wider, struct("c:double")).columns == wider.columns


def test_contract_report(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    contract = Contract(struct("a:bigint b:string c:double"), ("b",), ("a",))
    assert rows_of(contract_report(df, contract), "*") == [
        ("a", "bigint", "int", False, 0), ("b", "string", "string", True, 1), ("c", "double", None, False, None)
    ]
