"""Rules of the marts."""

import datetime as dt

from conftest import at, item, payment, rows_of, sale
from pyspark.sql import functions as F

from tillmart.plans.marts import (
    MARTS,
    branches,
    expense_categories,
    expenses,
    payments,
    payments_with_sale,
    payments_without_sale,
    product_prices_by_branch,
    sales_order,
    sales_order_line,
)
from tillmart.schemas import BRANCHES, CONTRACTS


def test_older_live_version_shows_when_the_newest_is_canceled(raw):
    lines = raw("items", ("b", at(1), 0, item("1", price=8)), ("b", at(2), 0, item("1", canceled=True)))
    assert rows_of(sales_order_line(lines), "order_line_key", "price_from_api") == [("1-b", 8.0)]
    assert sales_order_line(lines, latest_first=True).count() == 0


def test_canceled_null_and_false_stay(raw):
    lines = raw("items", *[("b", at(1), i, item(str(i), canceled=c)) for i, c in enumerate([None, False, True])])
    assert rows_of(sales_order_line(lines), "id_order_line_source") == [(0,), (1,)]


def test_arrival_order_settles_equal_times(raw):
    lines = raw("items", *[("b", at(1), seq, item("1", price=seq)) for seq in (3, 9, 5)])
    assert sales_order_line(lines).first().price_from_api == 9.0


def test_same_id_in_other_branch_is_another_record(raw):
    lines = raw("items", ("b", at(1), 0, item("1")), ("c", at(1), 0, item("1")))
    assert rows_of(sales_order_line(lines), "order_line_key", "order_key_fk", "product_key_fk") == [
        ("1-b", "7-b", "9-b"), ("1-c", "7-c", "9-c")
    ]


def test_required_leaves(raw):
    incomplete = [
        item("1", price=None),
        item("2", quantity=None),
        item("3", createdAt=None),
        item("4", relationships={"sale": {"data": None}}),
        item("5", relationships={"product": {}}),
    ]
    lines = raw("items", *[("b", at(1), i, r) for i, r in enumerate(incomplete)])
    assert sales_order_line(lines).count() == 0


def test_record_without_id_is_in_no_mart(raw):
    record = item("1")
    del record["id"]
    assert sales_order_line(raw("items", ("b", at(1), 0, record))).count() == 0


def test_sales_states(raw):
    states = ["OPEN", "CLOSED", "CANCELED", None]
    rows = raw("sales", *[("b", at(1), i, sale(str(i), saleState=s, saleType="TABLE")) for i, s in enumerate(states)])
    got = sales_order(rows)
    assert rows_of(got, "id_order", "order_key", "amount_tax", "amount_total", "sale_type") == [
        (0, "0-b", 0.0, 5.5, "TABLE"), (1, "1-b", 0.0, 5.5, "TABLE")
    ]
    first = got.select(F.col("date_order").cast("timestamp_ntz"), F.col("created_at").cast("timestamp_ntz"), "closed_at").first()
    assert first[0] == first[1] == dt.datetime(2024, 1, 1, 2) and first[2] is None


def test_payment_direction(raw):
    rows = raw(
        "payments",
        ("b", at(1), 0, payment("1", sale_id="7", expense_id="8")),
        ("b", at(1), 1, payment("2", sale_id="7")),
        ("b", at(1), 2, payment("3")),
        ("b", at(1), 3, payment("4", sale_id="7", canceled=True)),
    )
    assert rows_of(payments(rows), "id", "transaction_type", "signed_amount", "pos_order_id", "expense_id", "order_key_fk") == [
        (1, "EXPENSE", -12.5, 7, "8", "7-b"), (2, "SALE", 12.5, 7, None, "7-b"), (3, "OTHER", 12.5, None, None, None)
    ]


def test_payments_and_their_sales(raw):
    paid = raw("payments", ("b", at(1), 0, payment("1", sale_id="7.0")), ("b", at(1), 1, payment("2", sale_id="8")),
               ("c", at(1), 0, payment("3", sale_id="7")), ("b", at(1), 2, payment("4")))
    # Ids are compared as numbers, and two versions of a sale match once.
    sold = raw("sales", ("b", at(1), 0, sale("7")), ("b", at(2), 0, sale("7", total=9)))
    assert rows_of(payments_with_sale(paid, sold), "id", "has_sale") == [(1, True), (2, False), (3, False), (4, False)]
    assert rows_of(payments_without_sale(paid, sold), "id", "branch_id", "pos_order_id") == [(2, "b", 8), (3, "c", 7)]


def test_expenses_keep_canceled_ones(raw):
    record = {"id": "1", "attributes": {"amount": 3, "canceled": True}, "relationships": {"expenseCategory": {"data": {"id": "4"}}}}
    bare = {"id": "2", "attributes": {}}
    got = expenses(raw("expenses", ("b", at(1), 0, record), ("b", at(1), 1, bare)))
    assert rows_of(got, "id_expense", "amount", "canceled", "expense_category_key") == [(1, 3.0, True, "4-b"), (2, None, None, None)]


def test_prices_keep_text_ids_and_nameless_products(raw):
    got = product_prices_by_branch(raw("products", ("b", at(1), 0, {"id": "007", "attributes": {"price": 2}})))
    assert rows_of(got, "id_product_source", "product_name", "price", "product_branch_key") == [("007", None, 2.0, "007-b")]


def test_expense_categories_need_a_name(raw):
    rows = raw("expense-categories", ("b", at(1), 0, {"id": "1", "attributes": {}}), ("b", at(1), 1, {"id": "2", "attributes": {"name": "n", "active": False}}))
    assert rows_of(expense_categories(rows), "id_expense_category", "active", "expense_category_key") == [(2, False, "2-b")]


def test_branches(spark):
    config = spark.createDataFrame([("a", "s", "A", True, None, None), ("b", "s", "B", False, None, None), ("c", "s", "C", None, None, None)], BRANCHES)
    assert rows_of(branches(config), "*") == [("a", "A")]


def test_marts_fill_their_contracts(spark, raw):
    for name, contract in CONTRACTS.items():
        mart = MARTS[name]
        if mart.entity is None:
            continue
        have = {f.name: f.dataType for f in mart.build(raw(mart.entity, ("b", at(1), 0, {"id": "1"}))).schema.fields}
        for field in contract.columns.fields:
            assert have[field.name] == field.dataType, (name, field.name)
    assert len(MARTS) == 11 and len(CONTRACTS) == 10


def test_mart_keys_are_unique_for_versioned_records(raw):
    lines = raw("items", *[("b", at(1 + i), i, item(str(i % 2), price=i)) for i in range(6)])
    assert sales_order_line(lines).count() == 2
