"""Records to raw rows."""

import datetime as dt

import pytest
from conftest import at, rows_of, sale
from pyspark.sql import functions as F

from tillmart.entities import ENTITIES, raw_table_name
from tillmart.functions.records import accepted, parse_iso_timestamp, to_raw


def test_checksum_does_not_see_key_order(raw):
    rows = raw(
        "kitchens",
        ("b", at(1), 0, '{"id":"1","attributes":{"name":"n","x":{"p":1,"q":[2,{"s":3,"r":4}]}}}'),
        ("b", at(1), 1, '{"attributes": {"x":{"q":[2,{"r":4,"s":3}],"p":1},"name":"n"}, "id":"1"}'),
        ("b", at(1), 2, '{"id":"1","attributes":{"name":"n","x":{"p":1,"q":[{"s":3,"r":4},2]}}}'),
    )
    sums = [r.payload_checksum for r in rows.orderBy("ingest_seq").collect()]
    assert sums[0] == sums[1] != sums[2]
    assert all(len(s) == 32 for s in sums)


def test_last_of_duplicate_keys_wins(raw):
    rows = raw("kitchens", ("b", at(1), 0, '{"id":"1","id":"2","attributes":{}}'))
    assert rows.first().source_id == "2"


def test_record_ids(raw):
    rows = raw(
        "sales",
        ("b", at(1), 0, {"attributes": {}}),
        ("b", at(1), 1, {"id": None, "attributes": {}}),
        ("b", at(1), 2, {"id": 5, "attributes": {}}),
        ("b", at(1), 3, '["no object"]'),
        ("b", at(1), 4, "garbage"),
        ("b", at(1), 5, {"id": "6", "attributes": [1]}),
        ("b", at(1), 6, {"id": "7"}),
        keep_rejects=True,
    )
    got = {r.ingest_seq: (r.source_id, r.reject_reason) for r in rows.collect()}
    assert len(got[0][0]) == 36 and got[0][1] is None
    assert got[1][1] == "null_id"
    assert got[2] == ("5", None)
    assert got[3][1] == got[4][1] == "bad_record"
    assert got[5][1] == "bad_attributes"
    assert got[6] == ("7", None)


def test_made_up_ids_are_the_same_again_and_differ_by_run(raw):
    one = raw("kitchens", ("b", at(1), 0, {"attributes": {}}), ("b", at(1), 1, {"attributes": {}}))
    again = raw("kitchens", ("b", at(1), 0, {"attributes": {}}), ("b", at(1), 1, {"attributes": {}}))
    later = raw("kitchens", ("b", at(2), 0, {"attributes": {}}))
    assert rows_of(one, "source_id") == rows_of(again, "source_id")
    ids = [r[0] for r in rows_of(one, "source_id")]
    assert len(set(ids)) == 2 and later.first().source_id not in ids


@pytest.mark.parametrize(
    "entity, attributes, expected",
    [
        ("sales", {"closedAt": "2024-01-03T00:00:00Z", "createdAt": "2024-01-02T00:00:00Z"}, dt.datetime(2024, 1, 3)),
        ("sales", {"closedAt": None, "createdAt": "2024-01-02T00:00:00Z"}, dt.datetime(2024, 1, 2)),
        ("sales", {"closedAt": "bad", "createdAt": "2024-01-02T00:00:00Z"}, dt.datetime(2024, 1, 2)),
        ("items", {"closedAt": "2024-01-03T00:00:00Z", "createdAt": "2024-01-02T00:00:00Z"}, dt.datetime(2024, 1, 2)),
        ("items", {"createdAt": ""}, None),
        ("items", {}, None),
        ("payment-methods", {"createdAt": "2024-01-02T00:00:00Z"}, None),
    ],
)
def test_source_updated_at(raw, entity, attributes, expected):
    row = raw(entity, ("b", at(5), 0, {"id": "1", "attributes": attributes})).select(
        F.col("source_updated_at").cast("timestamp_ntz").alias("t")
    ).first()
    assert row.t == expected


def test_iso_timestamps(spark):
    texts = [("2024-01-01T02:00:00Z",), ("2024-01-01T02:00:00+00:00",), ("2024-01-01T02:00:00.5-03:00",), ("",), ("x",), (None,)]
    df = spark.createDataFrame(texts, "t string").select(parse_iso_timestamp(F.col("t")).cast("timestamp_ntz").alias("t"))
    assert [r.t for r in df.collect()] == [
        dt.datetime(2024, 1, 1, 2), dt.datetime(2024, 1, 1, 2), dt.datetime(2024, 1, 1, 5, 0, 0, 500000), None, None, None
    ]


def test_run_time_stamps_records_without_their_own(spark):
    records = spark.createDataFrame([("b", 0, '{"id":"1"}')], "branch_id string, ingest_seq bigint, record string")
    assert accepted(to_raw(records, ENTITIES["roles"], at(9))).select(
        F.col("extracted_at").cast("timestamp_ntz").alias("t")
    ).first().t == dt.datetime(2024, 1, 9)
    with pytest.raises(ValueError):
        to_raw(records, ENTITIES["roles"])


def test_table_names():
    assert raw_table_name("expense-categories") == "raw_expense_categories"
    assert len({e.table for e in ENTITIES.values()}) == 17
    assert [n for n, e in ENTITIES.items() if e.merge == "upsert"] == ["sales"]
    assert sum(e.has_view for e in ENTITIES.values()) == 15


def test_payload_keeps_numbers_as_they_came(raw):
    assert '"total": 5.0' in raw("sales", ("b", at(1), 0, sale("1", total=5.0))).first().payload
