"""The 11 marts.

Each one reads its raw table once: filter on present leaves, cast, keep the latest
row of each record. The filter comes before the choice of the latest row, so when the
newest version of a record is filtered out an older one that passes shows up again.
``latest_first=True`` turns that order round.
"""

from __future__ import annotations

import hashlib
import inspect
import sys
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.functions import payload
from tillmart.functions.payload import all_present, branch_key, half_even_int, leaf, typed, varchar, with_doc
from tillmart.operators.dedupe import latest_per_key
from tillmart.schemas import ARRIVAL_ORDER, RECORD_KEY

ID = "id"
NAME = "attributes.name"


def _rel(name: str) -> str:
    return f"relationships.{name}.data.id"


def _attr(name: str) -> str:
    return f"attributes.{name}"


# What each mart casts, by leaf: a type, or "whole" for a number that becomes a whole one.
CASTS: dict[str, dict[str, str]] = {
    "categories": {ID: "whole"},
    "payment_methods": {ID: "whole"},
    "products": {ID: "whole", _rel("productCategory"): "whole"},
    "sales_order": {ID: "whole", _attr("createdAt"): "timestamp", _attr("closedAt"): "timestamp", _attr("total"): "double"},
    "payments": {
        ID: "whole",
        _attr("amount"): "double",
        _attr("createdAt"): "timestamp",
        _attr("canceled"): "boolean",
        _rel("sale"): "whole",
        _rel("paymentMethod"): "whole",
    },
    "sales_order_line": {
        ID: "whole",
        _attr("quantity"): "whole",
        _attr("price"): "double",
        _attr("createdAt"): "timestamp",
        _attr("canceled"): "boolean",
        _rel("sale"): "whole",
        _rel("product"): "whole",
    },
    "expense_categories": {ID: "whole", _attr("active"): "boolean"},
    "expenses": {
        ID: "whole",
        _attr("amount"): "double",
        _attr("date"): "timestamp",
        _attr("dueDate"): "timestamp",
        _attr("canceled"): "boolean",
        _attr("createdAt"): "timestamp",
        _attr("paymentDate"): "timestamp",
        _attr("useInCashCount"): "boolean",
    },
    "product_categories_details": {
        ID: "whole",
        _attr("position"): "int",
        _attr("preparationTime"): "int",
        _attr("enableOnlineMenu"): "boolean",
    },
    "product_prices_by_branch": {_attr("price"): "double", _attr("stock"): "double", _attr("active"): "boolean"},
}


def _unreadable(path: str, type: str) -> Column:
    """Whether a leaf is there but does not fit its type."""
    text = leaf(path)
    value = half_even_int(text, strict=False) if type == "whole" else typed(text, type, strict=False)
    return text.isNotNull() & value.isNull()


def _readable(mart: str, strict: bool) -> Column:
    """What a lenient mart asks of a row: nothing unreadable, for a null in its place would be a wrong figure."""
    condition = F.lit(True)
    for path, type in {} if strict else CASTS[mart].items():
        condition = condition & ~_unreadable(path, type)
    return condition


def mart_rejects(raw: DataFrame, mart: str) -> DataFrame:
    """Rows that a lenient mart leaves out, and the leaves that can't be read."""
    flags = [F.when(_unreadable(path, type), F.lit(path)) for path, type in CASTS[mart].items()]
    found = with_doc(raw, list(CASTS[mart])).select(*RECORD_KEY, *ARRIVAL_ORDER, F.array_compact(F.array(*flags)).alias("bad"))
    return found.where(F.size("bad") > 0)


def latest_matching(
    raw: DataFrame,
    paths: list[str],
    condition: Column,
    columns: list[Column],
    latest_first: bool = False,
    readable: Column | None = None,
    keyed: bool = False,
) -> DataFrame:
    """Rows that match and are ``readable``, projected, one per record: the latest. ``keyed`` adds the record's id.

    Only the key, the order and the projected columns are shuffled, never the payload.
    """
    key = ["source_id"] if keyed else []
    parsed = with_doc(raw, paths)
    if readable is not None:
        condition = condition & readable
    if latest_first:
        return latest_per_key(parsed.drop("payload")).where(condition).select(*columns, *key)
    names = parsed.select(*columns).columns
    own = [column for column, name in zip(columns, names) if name not in RECORD_KEY]
    rows = parsed.where(condition).select(*RECORD_KEY, *ARRIVAL_ORDER, *own)
    return latest_per_key(rows).select(*names, *key)


def branches(config: DataFrame) -> DataFrame:
    return config.where("is_active").select("branch_id", "branch_name")


def categories(raw: DataFrame, strict: bool = True, latest_first: bool = False, keyed: bool = False) -> DataFrame:
    return latest_matching(
        raw,
        [ID, NAME],
        all_present(ID, NAME),
        [
            half_even_int(leaf(ID), strict).alias("id_rubro_source"),
            F.col("branch_id"),
            branch_key(leaf(ID)).alias("rubro_key"),
            varchar(leaf(NAME)).alias("rubro_name"),
        ],
        latest_first,
        _readable("categories", strict),
        keyed,
    )


def payment_methods(raw: DataFrame, strict: bool = True, latest_first: bool = False, keyed: bool = False) -> DataFrame:
    return latest_matching(
        raw,
        [ID, NAME],
        all_present(ID, NAME),
        [
            half_even_int(leaf(ID), strict).alias("id_payment_source"),
            F.col("branch_id"),
            branch_key(leaf(ID)).alias("payment_method_key"),
            varchar(leaf(NAME)).alias("payment_method"),
        ],
        latest_first,
        _readable("payment_methods", strict),
        keyed,
    )


def products(raw: DataFrame, strict: bool = True, latest_first: bool = False, keyed: bool = False) -> DataFrame:
    category = _rel("productCategory")
    return latest_matching(
        raw,
        [ID, NAME, category],
        all_present(ID, NAME),
        [
            half_even_int(leaf(ID), strict).alias("id_product_source"),
            F.col("branch_id"),
            branch_key(leaf(ID)).alias("product_key"),
            varchar(leaf(NAME)).alias("product_name"),
            half_even_int(leaf(category), strict).alias("id_rubro_source"),
            branch_key(leaf(category)).alias("rubro_key_fk"),
        ],
        latest_first,
        _readable("products", strict),
        keyed,
    )


def sales_order(raw: DataFrame, strict: bool = True, latest_first: bool = False, keyed: bool = False) -> DataFrame:
    total, created, closed = _attr("total"), _attr("createdAt"), _attr("closedAt")
    state, sale_type, table, waiter = _attr("saleState"), _attr("saleType"), _rel("table"), _rel("waiter")
    created_at = typed(leaf(created), "timestamp", strict)
    return latest_matching(
        raw,
        [ID, total, created, closed, state, sale_type, table, waiter],
        all_present(ID, created, total, state) & F.col("branch_id").isNotNull() & (leaf(state) != "CANCELED"),
        [
            half_even_int(leaf(ID), strict).alias("id_order"),
            F.col("branch_id"),
            branch_key(leaf(ID)).alias("order_key"),
            F.lit(0.0).alias("amount_tax"),
            typed(leaf(total), "double", strict).alias("amount_total"),
            created_at.alias("date_order"),
            leaf(sale_type).alias("sale_type"),
            leaf(table).alias("table_id"),
            leaf(waiter).alias("waiter_id"),
            created_at.alias("created_at"),
            typed(leaf(closed), "timestamp", strict).alias("closed_at"),
        ],
        latest_first,
        _readable("sales_order", strict),
        keyed,
    )


def _not_true(path: str, strict: bool) -> Column:
    """Null and false pass."""
    return ~F.coalesce(typed(leaf(path), "boolean", strict), F.lit(False))


def payments(raw: DataFrame, strict: bool = True, latest_first: bool = False, keyed: bool = False) -> DataFrame:
    """Payments and their direction. An expense wins over a sale when both are given.

    There is no join to the sales: nothing is taken from them, and one row per payment
    is kept, so it could not change the result (``payments_without_sale`` checks it).
    """
    amount_text, created, canceled = _attr("amount"), _attr("createdAt"), _attr("canceled")
    sale, expense, method = _rel("sale"), _rel("expense"), _rel("paymentMethod")
    amount = typed(leaf(amount_text), "double", strict)
    is_expense = leaf(expense).isNotNull()
    return latest_matching(
        raw,
        [ID, amount_text, created, canceled, sale, expense, method],
        all_present(ID, amount_text, created, method) & _not_true(canceled, strict),
        [
            half_even_int(leaf(ID), strict).alias("id"),
            F.col("branch_id"),
            branch_key(leaf(ID)).alias("payment_key"),
            half_even_int(leaf(sale), strict).alias("pos_order_id"),
            half_even_int(leaf(method), strict).alias("id_payment"),
            amount.alias("amount"),
            F.when(is_expense, "EXPENSE").when(leaf(sale).isNotNull(), "SALE").otherwise("OTHER").alias("transaction_type"),
            F.when(is_expense, -amount).otherwise(amount).alias("signed_amount"),
            typed(leaf(created), "timestamp", strict).alias("payment_date"),
            leaf(expense).alias("expense_id"),
            branch_key(leaf(sale)).alias("order_key_fk"),
        ],
        latest_first,
        _readable("payments", strict),
        keyed,
    )


def sales_order_line(raw: DataFrame, strict: bool = True, latest_first: bool = False, keyed: bool = False) -> DataFrame:
    created, price_text, quantity_text = _attr("createdAt"), _attr("price"), _attr("quantity")
    canceled, sale, product = _attr("canceled"), _rel("sale"), _rel("product")
    quantity = F.coalesce(typed(leaf(quantity_text), "double", strict), F.lit(0.0))
    price = F.coalesce(typed(leaf(price_text), "double", strict), F.lit(0.0))
    unit_price = F.when(quantity > 0, price / quantity).otherwise(F.lit(0.0))
    return latest_matching(
        raw,
        [ID, created, price_text, quantity_text, canceled, sale, product],
        all_present(ID, sale, product, created, price_text, quantity_text) & _not_true(canceled, strict) & (quantity > 0),
        [
            half_even_int(leaf(ID), strict).alias("id_order_line_source"),
            F.col("branch_id"),
            branch_key(leaf(ID)).alias("order_line_key"),
            half_even_int(leaf(sale), strict).alias("id_order_source"),
            branch_key(leaf(sale)).alias("order_key_fk"),
            typed(leaf(created), "timestamp", strict).alias("date_order_time"),
            # From the text, so that the date is the written one in any time zone.
            typed(leaf(created), "date", strict).alias("date_order"),
            half_even_int(leaf(product), strict).alias("id_product_source"),
            branch_key(leaf(product)).alias("product_key_fk"),
            quantity.alias("qty_from_api"),
            price.alias("price_from_api"),
            unit_price.alias("price_unit"),
            F.coalesce(half_even_int(leaf(quantity_text), strict), F.lit(0)).cast("bigint").alias("qty"),
            # Not simplified to the price: the rounding of the division shows.
            (unit_price * quantity).alias("amount_total"),
        ],
        latest_first,
        _readable("sales_order_line", strict),
        keyed,
    )


def expense_categories(raw: DataFrame, strict: bool = True, latest_first: bool = False, keyed: bool = False) -> DataFrame:
    financial, active, parent = _attr("financialCategory"), _attr("active"), _rel("parentCategory")
    return latest_matching(
        raw,
        [ID, NAME, financial, active, parent],
        all_present(ID, NAME) & F.col("branch_id").isNotNull(),
        [
            half_even_int(leaf(ID), strict).alias("id_expense_category"),
            leaf(NAME).alias("expense_category_name"),
            leaf(financial).alias("financial_category"),
            typed(leaf(active), "boolean", strict).alias("active"),
            leaf(parent).alias("parent_category_id"),
            F.col("branch_id"),
            branch_key(leaf(ID)).alias("expense_category_key"),
        ],
        latest_first,
        _readable("expense_categories", strict),
        keyed,
    )


def expenses(raw: DataFrame, strict: bool = True, latest_first: bool = False, keyed: bool = False) -> DataFrame:
    """Canceled expenses stay in, with their flag."""
    typed_attributes = [
        ("amount", "double", "amount"),
        ("description", "string", "description"),
        ("date", "timestamp", "expense_date"),
        ("status", "string", "status"),
        ("dueDate", "timestamp", "due_date"),
        ("canceled", "boolean", "canceled"),
        ("createdAt", "timestamp", "created_at"),
        ("paymentDate", "timestamp", "payment_date"),
        ("receiptNumber", "string", "receipt_number"),
        ("useInCashCount", "boolean", "use_in_cash_count"),
    ]
    related = [
        ("user", "user_id"),
        ("provider", "provider_id"),
        ("receiptType", "receipt_type_id"),
        ("cashRegister", "cash_register_id"),
        ("paymentMethod", "payment_method_id"),
        ("expenseCategory", "expense_category_id"),
    ]
    return latest_matching(
        raw,
        [ID] + [_attr(name) for name, _, _ in typed_attributes] + [_rel(name) for name, _ in related],
        all_present(ID) & F.col("branch_id").isNotNull(),
        [
            half_even_int(leaf(ID), strict).alias("id_expense"),
            F.col("branch_id"),
            *[typed(leaf(_attr(name)), type, strict).alias(column) for name, type, column in typed_attributes],
            *[leaf(_rel(name)).alias(column) for name, column in related],
            branch_key(leaf(_rel("expenseCategory"))).alias("expense_category_key"),
        ],
        latest_first,
        _readable("expenses", strict),
        keyed,
    )


def product_categories_details(raw: DataFrame, strict: bool = True, latest_first: bool = False, keyed: bool = False) -> DataFrame:
    position, preparation, online = _attr("position"), _attr("preparationTime"), _attr("enableOnlineMenu")
    kitchen, parent = _rel("kitchen"), _rel("parentCategory")
    return latest_matching(
        raw,
        [ID, NAME, position, preparation, online, kitchen, parent],
        all_present(ID, NAME) & F.col("branch_id").isNotNull(),
        [
            half_even_int(leaf(ID), strict).alias("id_product_category"),
            varchar(leaf(NAME)).alias("product_category_name"),
            typed(leaf(position), "int", strict).alias("position"),
            typed(leaf(preparation), "int", strict).alias("preparation_time"),
            typed(leaf(online), "boolean", strict).alias("enable_online_menu"),
            leaf(kitchen).alias("kitchen_id"),
            leaf(parent).alias("parent_category_id"),
            F.col("branch_id"),
            branch_key(leaf(ID)).alias("product_category_key"),
        ],
        latest_first,
        _readable("product_categories_details", strict),
        keyed,
    )


def product_prices_by_branch(raw: DataFrame, strict: bool = True, latest_first: bool = False, keyed: bool = False) -> DataFrame:
    price, stock, active = _attr("price"), _attr("stock"), _attr("active")
    return latest_matching(
        raw,
        [ID, NAME, price, stock, active],
        all_present(ID) & F.col("branch_id").isNotNull(),
        [
            leaf(ID).alias("id_product_source"),
            F.col("branch_id"),
            varchar(leaf(NAME)).alias("product_name"),
            typed(leaf(price), "double", strict).alias("price"),
            typed(leaf(stock), "double", strict).alias("stock"),
            typed(leaf(active), "boolean", strict).alias("is_active_in_branch"),
            branch_key(leaf(ID)).alias("product_branch_key"),
        ],
        latest_first,
        _readable("product_prices_by_branch", strict),
        keyed,
    )


@dataclass(frozen=True)
class Mart:
    """A mart, the entity it reads, its unique key, and the name reports know it by."""

    build: Callable[..., DataFrame]
    entity: str | None
    key: tuple[str, ...]
    report_name: str

    @property
    def key_is_the_record(self) -> bool:
        """Whether rows of two records never share a key: keys of text are the written id and the branch, others are rounded."""
        return all(column.endswith("_key") for column in self.key)


MARTS: dict[str, Mart] = {
    "branches": Mart(branches, None, ("branch_id",), "mv_sucursales"),
    "categories": Mart(categories, "product-categories", ("rubro_key",), "mv_rubros"),
    "payment_methods": Mart(payment_methods, "payment-methods", ("payment_method_key",), "mv_medio_pago"),
    "products": Mart(products, "products", ("product_key",), "mv_productos"),
    "sales_order": Mart(sales_order, "sales", ("order_key",), "mv_sales_order"),
    "payments": Mart(payments, "payments", ("payment_key",), "mv_pagos"),
    "sales_order_line": Mart(sales_order_line, "items", ("order_line_key",), "mv_sales_order_line"),
    "expense_categories": Mart(
        expense_categories, "expense-categories", ("expense_category_key",), "mv_expense_categories"
    ),
    "expenses": Mart(expenses, "expenses", ("id_expense", "branch_id"), "mv_expenses"),
    "product_categories_details": Mart(
        product_categories_details, "product-categories", ("product_category_key",), "mv_product_categories_details"
    ),
    "product_prices_by_branch": Mart(
        product_prices_by_branch, "products", ("product_branch_key",), "mv_product_prices_by_branch"
    ),
}


def rules() -> str:
    """A short name for how marts are made; another one whenever this code changes."""
    return hashlib.md5("".join(inspect.getsource(m) for m in (sys.modules[__name__], payload)).encode()).hexdigest()[:12]


def mart_table(name: str) -> str:
    """Where the warehouse keeps a mart."""
    return f"marts/{name}"


def _parsed_payments(raw: DataFrame, strict: bool) -> DataFrame:
    amount, created, canceled = _attr("amount"), _attr("createdAt"), _attr("canceled")
    sale, method = _rel("sale"), _rel("paymentMethod")
    return (
        with_doc(raw, [ID, amount, created, canceled, sale, method])
        .where(all_present(ID, amount, created, method) & _not_true(canceled, strict) & _readable("payments", strict))
        .select(
            *RECORD_KEY,
            *ARRIVAL_ORDER,
            half_even_int(leaf(ID), strict).alias("id"),
            half_even_int(leaf(sale), strict).alias("pos_order_id"),
        )
    )


def payments_with_sale(payment_rows: DataFrame, sale_rows: DataFrame, strict: bool = True) -> DataFrame:
    """Live payments, left joined to the sales of the same branch; ``has_sale`` tells a match.

    The sales side is reduced to distinct keys first, so the join cannot multiply rows.
    Payments without a sale id match nothing; a salt spreads them over the reducers. The sales are never
    broadcast: behind a parse they look far smaller to Spark than they are.
    """
    known = (
        with_doc(sale_rows, [ID])
        .where(leaf(ID).isNotNull())
        .select(half_even_int(leaf(ID), strict).alias("pos_order_id"), "branch_id")
        .distinct()
        .withColumn("_salt", F.lit(0))
        .withColumn("_found", F.lit(True))
        .hint("merge")
    )
    salt = F.when(F.col("pos_order_id").isNull(), F.pmod(F.hash("id"), F.lit(4096))).otherwise(0)
    live = latest_per_key(_parsed_payments(payment_rows, strict)).select(
        "id", "branch_id", "pos_order_id", salt.alias("_salt")
    )
    return live.join(known, ["pos_order_id", "branch_id", "_salt"], "left").select(
        "id", "branch_id", "pos_order_id", F.col("_found").isNotNull().alias("has_sale")
    )


def payments_without_sale(payment_rows: DataFrame, sale_rows: DataFrame, strict: bool = True) -> DataFrame:
    """Payments that name a sale which the branch does not have."""
    joined = payments_with_sale(payment_rows, sale_rows, strict)
    return joined.where(F.col("pos_order_id").isNotNull() & ~F.col("has_sale")).drop("has_sale")
