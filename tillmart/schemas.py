"""Schemas of landed pages, raw rows, configuration and bookkeeping tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def struct(columns: str, required: str = "") -> T.StructType:
    """Struct type from ``name:type`` words; no session is needed for it."""
    out = T.StructType()
    for word in columns.split():
        name, _, type_name = word.partition(":")
        out.add(name, _TYPES[type_name], name not in required.split())
    return out


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}

# landed_at tells two landings of a page apart: the later one holds the newer state. It may be null.
PAGES = struct("branch_id:string entity:string page_no:int body:string landed_at:timestamp")

# One record of one page. ingest_seq keeps the order of arrival inside a load.
RECORDS = struct("branch_id:string ingest_seq:bigint record:string")

RAW = struct(
    "source_id:string branch_id:string extracted_at:timestamp payload:string"
    " source_updated_at:timestamp payload_checksum:string ingest_seq:bigint",
    required="source_id branch_id extracted_at payload payload_checksum ingest_seq",
)
RAW_COLUMNS = RAW.fieldNames()

RECORD_KEY = ["source_id", "branch_id"]
VERSION_KEY = ["source_id", "branch_id", "payload_checksum"]
# The checksum settles what time and address leave open.
ARRIVAL_ORDER = ["extracted_at", "ingest_seq", "payload_checksum"]

BRANCHES = struct(
    "branch_id:string source_branch:string branch_name:string is_active:boolean"
    " created_at:timestamp updated_at:timestamp",
    required="branch_id",
)

STATUS = struct(
    "branch_id:string entity:string last_successful_extraction:timestamp",
    required="branch_id entity",
)
STATUS_KEY = ["branch_id", "entity"]

# extracted counts the records of the pages; those that an incremental load left out are in no other count.
AUDIT = struct(
    "run_ts:timestamp branch_id:string entity:string extracted:bigint inserted:bigint"
    " updated:bigint unchanged:bigint rejected:bigint bad_dates:bigint status:string detail:string",
)

# Pages that came of page sets whose other pages did not yet.
UNFINISHED = struct("branch_id:string entity:string page_no:int n:bigint all:bigint bad:boolean times:bigint")

REJECTS = struct("extracted_at:timestamp branch_id:string ingest_seq:bigint reject_reason:string")


@dataclass(frozen=True)
class Contract:
    """Target shape of an analytical table: columns, required columns and key."""

    columns: T.StructType
    required: tuple[str, ...]
    key: tuple[str, ...]


def _contract(columns: str, required: str, key: str) -> Contract:
    return Contract(struct(columns), tuple(required.split()), tuple(key.split()))


# The documented target tables, by the mart that fills each one.
# They describe the target; where a mart differs, the mart is what is published.
CONTRACTS = {
    "branches": _contract("branch_id:string branch_name:string", "branch_id branch_name", "branch_id"),
    "categories": _contract("id_rubro_source:bigint rubro_name:string", "id_rubro_source rubro_name", "id_rubro_source"),
    "payment_methods": _contract(
        "id_payment_source:bigint payment_method:string", "id_payment_source payment_method", "id_payment_source"
    ),
    "products": _contract(
        "id_product_source:bigint branch_id:string product_key:string product_name:string"
        " id_rubro_source:bigint rubro_key_fk:string",
        "product_key product_name",
        "product_key",
    ),
    "sales_order": _contract(
        "id_order:bigint amount_tax:double amount_total:double date_order:timestamp"
        " sale_type:string table_id:string waiter_id:string",
        "id_order amount_total date_order",
        "id_order",
    ),
    "payments": _contract(
        "id:bigint pos_order_id:bigint id_payment:bigint amount:double payment_date:timestamp branch_id:string",
        "id pos_order_id id_payment amount payment_date branch_id",
        "id",
    ),
    "sales_order_line": _contract(
        "id_order_line_source:bigint id_order_source:bigint date_order_time:timestamp date_order:date"
        " id_product_source:bigint qty_from_api:double price_from_api:double price_unit:double"
        " qty:bigint amount_total:double branch_id:string order_line_key:string",
        "id_order_line_source id_order_source date_order_time date_order id_product_source qty_from_api"
        " price_from_api price_unit qty amount_total branch_id order_line_key",
        "id_order_line_source",
    ),
    "expenses": _contract(
        "id_expense:bigint branch_id:string amount:double description:string expense_date:timestamp"
        " status:string due_date:timestamp canceled:boolean created_at:timestamp payment_date:timestamp"
        " receipt_number:string use_in_cash_count:boolean user_id:string provider_id:string"
        " receipt_type_id:string cash_register_id:string payment_method_id:string"
        " expense_category_id:string expense_category_key:string",
        "id_expense branch_id amount expense_date expense_category_key",
        "id_expense",
    ),
    "product_categories_details": _contract(
        "id_product_category:bigint product_category_name:string position:int preparation_time:int"
        " enable_online_menu:boolean kitchen_id:string parent_category_id:string branch_id:string"
        " product_category_key:string",
        "id_product_category product_category_name branch_id product_category_key",
        "product_category_key",
    ),
    "product_prices_by_branch": _contract(
        "id_product_source:string branch_id:string product_name:string price:double stock:double"
        " is_active_in_branch:boolean product_branch_key:string",
        "id_product_source branch_id product_name product_branch_key",
        "product_branch_key",
    ),
}
