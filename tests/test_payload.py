"""Typed columns from JSON text."""

import datetime as dt

import pytest
from conftest import at, item, rows_of, sale
from pyspark.sql import functions as F

from tillmart.entities import ENTITIES, snake_case
from tillmart.functions.payload import half_even_int, leaf, leaf_type, typed, varchar, with_doc
from tillmart.operators.checks import cast_failures
from tillmart.operators.flatten import flatten
from tillmart.plans.marts import categories, product_categories_details, products, sales_order_line


def test_leaf_type_nests_by_path():
    schema = leaf_type(["id", "attributes.name", "attributes.a.b", "relationships.x.data.id"])
    assert schema.simpleString() == (
        "struct<id:string,attributes:struct<name:string,a:struct<b:string>>,"
        "relationships:struct<x:struct<data:struct<id:string>>>>"
    )


def test_half_even(spark):
    values = [("2.5", 2), ("3.5", 4), ("-2.5", -2), ("0.5", 0), ("7", 7), ("3.0", 3), (None, None), ("5000000000", 5000000000)]
    df = spark.createDataFrame(values, "t string, expected bigint").select(half_even_int(F.col("t")).alias("got"), "expected")
    assert all(r.got == r.expected for r in df.collect())


def test_quantities(raw):
    lines = raw(
        "items",
        *[("b", at(2), i, item(str(i), quantity=q)) for i, q in enumerate([2.5, 3.5, 0, -1, None, 0.25])],
    )
    got = rows_of(sales_order_line(lines), "id_order_line_source", "qty", "price_unit", "amount_total")
    assert got == [(0, 2, 4.0, 10.0), (1, 4, 10.0 / 3.5, (10.0 / 3.5) * 3.5), (5, 0, 40.0, 10.0)]


def test_bad_number_fails_the_mart_or_drops_the_row(raw):
    lines = raw("items", ("b", at(2), 0, item("1", quantity="x")), ("b", at(2), 1, item("2")))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        sales_order_line(lines).collect()
    assert rows_of(sales_order_line(lines, strict=False), "id_order_line_source") == [(2,)]
    assert rows_of(cast_failures(lines, ENTITIES["items"]), "source_id", "bad") == [("1", ["quantity"])]


@pytest.mark.parametrize("data", [{"data": None}, {}, {"data": [{"id": "1"}]}, None])
def test_related_id_missing(raw, data):
    record = {"id": "1", "attributes": {"name": "n"}, "relationships": {"productCategory": data}}
    got = rows_of(products(raw("products", ("b", at(2), 0, record))), "product_key", "id_rubro_source", "rubro_key_fk")
    assert got == [("1-b", None, None)]


def test_subtree_keeps_null_apart_from_missing(raw):
    links = [{"subitems": {"data": None}}, {"subitems": {}}, {"subitems": {"data": [{"id": "5"}]}}, {}]
    lines = raw("items", *[("b", at(2), i, item(str(i), relationships=r)) for i, r in enumerate(links)])
    view = flatten(lines, ENTITIES["items"])
    assert rows_of(view, "item_id", "subitems_data") == [
        ("0", "null"), ("1", None), ("2", '[{"id":"5"}]'), ("3", None)
    ]


def test_names_are_cut_in_marts_only(raw):
    record = {"id": "1", "attributes": {"name": "x" * 300}}
    rows = raw("product-categories", ("b", at(2), 0, record))
    assert len(categories(rows).first().rubro_name) == 255
    kitchens = raw("kitchens", ("b", at(2), 0, record))
    assert len(flatten(kitchens, ENTITIES["kitchens"]).first().kitchen_name) == 300


def test_date_is_the_written_one_in_any_zone(spark, raw):
    lines = raw("items", ("b", at(2), 0, item("1", createdAt="2024-01-01T02:00:00Z")))
    spark.conf.set("spark.sql.session.timeZone", "America/Argentina/Buenos_Aires")
    try:
        assert sales_order_line(lines).first().date_order == dt.date(2024, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_whole_number_columns_do_not_take_decimals(raw):
    rows = raw("product-categories", ("b", at(2), 0, {"id": "1", "attributes": {"name": "n", "position": 3.0}}))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        product_categories_details(rows).collect()
    assert product_categories_details(rows, strict=False).isEmpty()


def test_nested_attribute_and_reserved_names(raw):
    record = sale("1", anonymousCustomer={"name": "Ana", "phone": 12})
    view = flatten(raw("sales", ("b", at(2), 0, record)), ENTITIES["sales"]).first()
    assert (view.anonymous_customer_name, view.anonymous_customer_phone, view.anonymous_customer_address) == ("Ana", "12", None)
    table = {"id": "1", "attributes": {"row": 1, "column": 2, "number": 3}}
    got = flatten(raw("tables", ("b", at(2), 0, table)), ENTITIES["tables"]).first()
    assert (got["row"], got["column"], got["table_number"]) == (1, 2, 3)


def test_ordered_view(raw):
    rows = raw("kitchens", *[(b, at(d), 0, {"id": i, "attributes": {"name": str(d)}}) for i, b, d in [("2", "b", 1), ("1", "b", 1), ("1", "b", 2), ("1", "a", 1)]])
    view = flatten(rows, ENTITIES["kitchens"], ordered=True)
    assert [(r.source_id, r.branch_id, r.kitchen_name) for r in view.collect()] == [
        ("1", "a", "1"), ("1", "b", "2"), ("1", "b", "1"), ("2", "b", "1")
    ]


def test_view_has_envelope_columns_and_payload(raw):
    for entity in ENTITIES.values():
        rows = raw(entity.name, ("b", at(2), 0, {"id": "1", "attributes": {}}))
        view = flatten(rows, entity)
        assert view.columns[:5] == ["source_id", "branch_id", "extracted_at", "payload_checksum", entity.id_column]
        assert view.columns[5:-1] == [f.column for f in entity.fields]
        assert view.columns[-1] == "original_payload"
        assert view.first()[entity.id_column] == "1"


def test_snake_case():
    assert [snake_case(n) for n in ("createdAt", "useInCashCount", "name", "vatNumber")] == [
        "created_at", "use_in_cash_count", "name", "vat_number"
    ]


def test_typed_text_and_varchar(spark):
    df = spark.createDataFrame([("true", "abc")], "b string, s string")
    got = df.select(typed(F.col("b"), "boolean").alias("b"), varchar(F.col("s"), 2).alias("s")).first()
    assert got.b is True and got.s == "ab"


def test_stored_doc_is_used_as_it_is(spark):
    df = spark.createDataFrame([("{}",)], "payload string").select(
        "payload", F.struct(F.lit("kept").alias("id")).alias("doc")
    )
    assert with_doc(df, ["id"]).select(leaf("id").alias("id")).first().id == "kept"
