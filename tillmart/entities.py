"""The 17 source entities: what each record holds and how it is kept.

The columns are fixed values: names, paths and types that the views must expose.
"""

from __future__ import annotations

import re
from dataclasses import dataclass


def snake_case(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower()


@dataclass(frozen=True)
class Field:
    """One view column: the JSON path it comes from, its name and its type.

    Type ``json`` keeps a whole subtree as JSON text; the others are leaves.
    """

    path: str
    column: str
    type: str = "string"


def attr(name: str, type: str = "string", column: str | None = None) -> Field:
    return Field(f"attributes.{name}", column or snake_case(name), type)


def to_one(name: str) -> Field:
    """Id at the far end of a to-one relationship."""
    return Field(f"relationships.{name}.data.id", f"{snake_case(name)}_id")


def to_many(name: str, column: str | None = None) -> Field:
    """Array of references of a to-many relationship, never unnested."""
    return Field(f"relationships.{name}.data", column or snake_case(name), "json")


@dataclass(frozen=True)
class Entity:
    name: str
    id_column: str
    fields: tuple[Field, ...]
    # Attributes tried in turn for source_updated_at; none for an undated entity.
    dated_by: tuple[str, ...] = ("createdAt",)
    # "append" keeps every version of a record, "upsert" only the last one.
    merge: str = "append"
    has_view: bool = True
    # Attributes and relationships asked of the source; None asks for all.
    requested: tuple[str, ...] | None = None
    # Attribute an opt-in incremental load filters on.
    incremental_by: str | None = None

    @property
    def table(self) -> str:
        return raw_table_name(self.name)

    @property
    def leaves(self) -> list[Field]:
        return [f for f in self.fields if f.type != "json"]

    @property
    def subtrees(self) -> list[Field]:
        return [f for f in self.fields if f.type == "json"]


def raw_table_name(entity: str) -> str:
    return "raw_" + entity.replace("-", "_")


_ALL = [
    Entity(
        "customers",
        "customer_id",
        (
            attr("active", "boolean"),
            attr("address"),
            attr("comment"),
            attr("createdAt", "timestamp"),
            attr("discountPercentage", "double"),
            attr("email"),
            attr("firstSaleDate", "timestamp"),
            attr("historicalSalesCount", "int"),
            attr("historicalTotalSpent", "double"),
            attr("houseAccountBalance", "double"),
            attr("houseAccountEnabled", "boolean"),
            attr("lastSaleDate", "timestamp"),
            attr("name", column="customer_name"),
            attr("origin"),
            attr("phone"),
            attr("salesCount", "int"),
            attr("vatNumber"),
            to_one("paymentMethod"),
        ),
    ),
    Entity(
        "discounts",
        "discount_id",
        (attr("amount", "double"), attr("percentage", "double"), attr("canceled", "boolean"), to_one("sale")),
    ),
    Entity(
        "expenses",
        "expense_id",
        (
            attr("amount", "double"),
            attr("description"),
            attr("date", "timestamp", "expense_date"),
            attr("status"),
            attr("dueDate", "timestamp"),
            attr("canceled", "boolean"),
            attr("createdAt", "timestamp"),
            attr("paymentDate", "timestamp"),
            attr("receiptNumber"),
            attr("useInCashCount", "boolean"),
            to_one("user"),
            to_one("provider"),
            to_one("receiptType"),
            to_one("cashRegister"),
            to_many("expenseItems"),
            to_one("paymentMethod"),
            to_one("expenseCategory"),
        ),
        # The fields asked of the source.
        requested=(
            "amount",
            "canceled",
            "cashRegister",
            "createdAt",
            "date",
            "description",
            "dueDate",
            "expenseCategory",
            "expenseItems",
            "paymentDate",
            "paymentMethod",
            "provider",
            "receiptNumber",
            "receiptType",
            "status",
            "useInCashCount",
            "user",
        ),
    ),
    Entity(
        "expense-categories",
        "category_id",
        (
            attr("name", column="category_name"),
            attr("active", "boolean"),
            attr("financialCategory"),
            to_one("parentCategory"),
        ),
        requested=("active", "financialCategory", "name", "parentCategory"),
    ),
    Entity(
        "ingredients",
        "ingredient_id",
        (
            attr("name", column="ingredient_name"),
            attr("cost", "double"),
            attr("stock", "double"),
            attr("stockControl", "boolean"),
            to_one("ingredientCategory"),
        ),
    ),
    Entity(
        "items",
        "item_id",
        (
            attr("canceled", "boolean"),
            attr("cancellationComment"),
            attr("comment"),
            attr("cost", "double"),
            attr("createdAt", "timestamp"),
            attr("price", "double"),
            attr("quantity", "double"),
            attr("status"),
            attr("paid", "boolean"),
            attr("lastStockCountAt", "timestamp"),
            to_one("product"),
            to_one("sale"),
            to_one("priceList"),
            to_many("subitems", "subitems_data"),
        ),
    ),
    Entity("kitchens", "kitchen_id", (attr("name", column="kitchen_name"),)),
    Entity(
        "payments",
        "payment_id",
        (
            attr("amount", "double"),
            attr("canceled", "boolean"),
            attr("createdAt", "timestamp"),
            attr("externalReference"),
            to_one("sale"),
            to_one("expense"),
            to_one("paymentMethod"),
        ),
    ),
    Entity(
        "payment-methods",
        "payment_method_id",
        (attr("name", column="payment_method_name"),),
        dated_by=(),
        has_view=False,
    ),
    Entity(
        "product-categories",
        "product_category_id",
        (
            attr("name", column="product_category_name"),
            attr("position", "int"),
            attr("preparationTime", "int"),
            attr("enableOnlineMenu", "boolean"),
            to_one("kitchen"),
            to_one("parentCategory"),
        ),
        has_view=False,
    ),
    Entity(
        "product-modifiers",
        "modifier_id",
        (
            attr("maxQuantity", "int"),
            attr("price", "double"),
            to_one("product"),
            to_one("productModifiersGroup"),
        ),
    ),
    Entity(
        "products",
        "product_id",
        (
            attr("active", "boolean"),
            attr("code"),
            attr("cost", "double"),
            attr("description"),
            attr("enableOnlineMenu", "boolean"),
            attr("enableQrMenu", "boolean"),
            attr("favourite", "boolean"),
            attr("imageUrl"),
            attr("name", column="product_name"),
            attr("position", "int"),
            attr("preparationTime", "int"),
            attr("price", "double"),
            attr("sellAlone", "boolean"),
            attr("stock", "double"),
            attr("stockControl", "boolean"),
            to_one("kitchen"),
            to_one("productCategory"),
            to_many("productModifiersGroups"),
            to_many("productProportions"),
        ),
    ),
    Entity(
        "roles",
        "role_id",
        (
            attr("isWaiter", "boolean"),
            attr("isDeliveryman", "boolean"),
            attr("name", column="role_name"),
            attr("permissions", "json"),
        ),
    ),
    Entity("rooms", "room_id", (attr("name", column="room_name"), to_many("tables", "table_ids"))),
    Entity(
        "sales",
        "sale_id",
        (
            attr("closedAt", "timestamp"),
            attr("comment"),
            attr("createdAt", "timestamp"),
            attr("people", "int"),
            attr("customerName"),
            attr("total", "double", "total_amount"),
            attr("saleType"),
            attr("saleState"),
            attr("anonymousCustomer.name", column="anonymous_customer_name"),
            attr("anonymousCustomer.phone", column="anonymous_customer_phone"),
            attr("anonymousCustomer.address", column="anonymous_customer_address"),
            attr("expectedPayments", "json"),
            to_one("customer"),
            to_many("discounts", "discounts_data"),
            to_many("items", "items_data"),
            to_many("payments", "payments_data"),
            to_many("tips", "tips_data"),
            to_many("shippingCosts", "shipping_costs_data"),
            to_one("table"),
            to_one("waiter"),
            to_one("saleIdentifier"),
        ),
        dated_by=("closedAt", "createdAt"),
        merge="upsert",
        incremental_by="createdAt",
    ),
    Entity(
        "tables",
        "table_id",
        (
            attr("column", "int"),
            attr("number", "int", "table_number"),
            attr("row", "int"),
            attr("shape"),
            attr("size"),
            to_one("room"),
        ),
    ),
    Entity(
        "users",
        "user_id",
        (
            attr("active", "boolean"),
            attr("admin", "boolean"),
            attr("email"),
            attr("name", column="user_name"),
            attr("promotionalCode"),
            to_one("role"),
        ),
    ),
]

ENTITIES: dict[str, Entity] = {e.name: e for e in _ALL}
