"""Source records made from the supplied star-schema tables.

Each function gives branch_id, extracted_at, ingest_seq and record (JSON text) for one
entity. Everything is a per-row expression over the table, so there is no shuffle that
a frequent key could overload; the only groupings are over tiny dimension tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

N_BRANCHES = 5
# When records without a time of their own are taken to be extracted.
FIXED = "2024-02-01 00:00:00"


# A row group is never split, and its rows may be a million: some 4 bytes a row of part, which become kilobytes of JSON.
LEAST_BYTES, MOST_BYTES = 32 << 10, 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str, dealt: bool = True) -> DataFrame:
    """A table's rows, dealt out over the cores unless told otherwise: what is made of a row costs far more than to read and move it."""
    path = f"{sf_dir}/{name}.parquet"
    n = pieces(file_bytes(spark, path), spark.sparkContext.defaultParallelism)
    rows = spark.read.parquet(path)
    return rows.repartition(n) if dealt and n > 1 else rows


# The place of a record among the pages it will be landed in.
PAGE = ["page_branch", "page_no"]
# Bytes of file to a part of rows that become pages: as JSON they are some fifty times as large, and a task sorts them.
PAGED_BYTES = 1 << 20


def by_page(spark: SparkSession, sf_dir: str, name: str, key: str) -> Callable[[DataFrame], DataFrame]:
    """What deals rows of a table out by the page that each will be in, before they become JSON, so that pages are then put together where they are.

    A page has up to 500 successive numbers of a branch.
    """
    size = file_bytes(spark, f"{sf_dir}/{name}.parquet")
    n = max(pieces(size, spark.sparkContext.defaultParallelism), -(-size // PAGED_BYTES))

    def dealt(rows: DataFrame) -> DataFrame:
        number = F.floor(F.abs(F.col(key)) / 500).cast("int") + 1
        return rows.select("*", branch(F.col(key) % N_BRANCHES).alias(PAGE[0]), number.alias(PAGE[1])).repartition(n, *PAGE)

    return dealt


def pieces(size: int, cores: int) -> int:
    """How many parts to deal the rows of ``size`` bytes into: three a core if they are worth it, more if they get large."""
    return max(1, min(3 * cores, size // LEAST_BYTES), -(-size // MOST_BYTES))


def file_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file or folder, on whatever file system it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def branch(number: Column) -> Column:
    return F.concat(F.lit("branch_"), number.cast("string"))


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def days_after(start: Column, days: Column) -> Column:
    return iso(start + F.make_dt_interval(days.cast("int")))


def text_id(number: Column) -> Column:
    return number.cast("string")


def hex_number(text: Column, digits: int) -> Column:
    """Whole number out of the first hex digits of the md5 of a text."""
    return F.conv(F.left(F.md5(text), F.lit(digits)), 16, 10).cast("bigint")


def one(id_text: Column) -> Column:
    """To-one relationship; it has no ``data`` if the id is null."""
    return F.struct(F.when(id_text.isNotNull(), F.struct(id_text.alias("id"))).alias("data"))


def many(*ids: Column) -> Column:
    return F.struct(F.array(*[F.struct(i.alias("id")) for i in ids]).alias("data"))


def records_of(
    df: DataFrame,
    id_text: Column,
    branch_number: Column,
    attributes: dict[str, Column],
    relationships: dict[str, Column] | None = None,
    extracted_at: Column | None = None,
    ingest_seq: Column | None = None,
    keep_nulls: bool = False,
    turned: bool = False,
) -> DataFrame:
    """``turned`` adds the same records with their members, and the members of these, in the opposite order."""
    given = [attributes, relationships] if relationships else [attributes]

    def parts(step: int) -> list[Column]:
        inner = [F.struct(*[c.alias(k) for k, c in some.items()][::step]).alias(name) for name, some in zip(("attributes", "relationships"), given)]
        return [id_text.alias("id"), *inner][::step]

    options = {"ignoreNullFields": "false"} if keep_nulls else {}
    at = extracted_at if extracted_at is not None else F.lit(FIXED)
    return df.select(
        branch(branch_number).alias("branch_id"),
        at.cast("timestamp").alias("extracted_at"),
        (ingest_seq if ingest_seq is not None else F.lit(0)).cast("bigint").alias("ingest_seq"),
        F.to_json(F.struct(*parts(1)), options).alias("record"),
        *([F.to_json(F.struct(*parts(-1)), options).alias("turned")] if turned else []),
        *[c for c in PAGE if c in df.columns],
    )


def _in_all_branches(df: DataFrame) -> DataFrame:
    numbers = F.array(*[F.lit(i) for i in range(N_BRANCHES)])
    return df.select("*", F.explode(numbers).alias("_branch"))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_of(table(spark, sf_dir, "orders"))


def sales_of(orders: DataFrame) -> DataFrame:
    key, date, status = F.col("o_orderkey"), F.col("o_orderdate"), F.col("o_orderstatus")
    state = F.when(status == "F", "CLOSED").when(status == "O", "OPEN").otherwise("CANCELED")
    return records_of(
        orders,
        text_id(key),
        key % N_BRANCHES,
        {
            "total": F.col("o_totalprice"),
            "createdAt": iso(date),
            "closedAt": F.when(status != "P", iso(date + F.expr("INTERVAL 2 HOURS"))),
            "saleState": state,
            "saleType": F.col("o_orderpriority"),
            "people": (F.col("o_custkey") % 6 + 1).cast("int"),
            "anonymousCustomer": F.when(
                key % 4 == 0,
                F.struct(
                    F.concat(F.lit("Guest "), text_id(key)).alias("name"),
                    F.when(key % 8 == 0, F.concat(F.lit("+"), text_id(key))).alias("phone"),
                    F.when(key % 12 == 0, F.concat(text_id(key % 90), F.lit(" High St"))).alias("address"),
                ),
            ),
            "comment": F.when(key % 10 == 1, F.concat(F.lit('said "'), text_id(key), F.lit('"'))),
            "customerName": F.when(key % 10 == 2, F.concat(F.lit("Ann "), text_id(F.col("o_custkey")))),
            "expectedPayments": F.array(F.struct(text_id(F.col("o_custkey") % 5).alias("paymentMethod"))),
        },
        {
            "customer": one(text_id(F.col("o_custkey"))),
            "table": one(text_id(F.col("o_custkey") % 25)),
            "waiter": one(F.when(key % 3 != 0, text_id(key % 7))),
            "payments": many(text_id(key)),
            "items": F.when(key % 10 == 3, many(text_id(key * 10 + 1), text_id(key * 10 + 2))),
            "tips": F.when(key % 10 == 4, many(text_id(key * 10))),
            "shippingCosts": F.when(key % 10 == 5, many(text_id(key % 3))),
            "saleIdentifier": F.when(key % 10 == 6, one(text_id(key % 9))),
            "discounts": F.when(key % 2 == 0, F.struct(F.array().cast("array<struct<id:string>>").alias("data"))),
        },
        extracted_at=date + F.expr("INTERVAL 1 DAY"),
    )


def cents(name: str) -> Column:
    return F.round(F.col(name) * 100).cast("bigint")


def item_arrival() -> Column:
    """Arrival number of an order line: settles ties of the same line and date."""
    parts = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    money = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    text = F.concat_ws(
        "|",
        *[F.col(c).cast("string") for c in parts],
        *[cents(c).cast("string") for c in money],
        "l_returnflag",
        "l_linestatus",
    )
    return hex_number(text, 15)


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items_of(table(spark, sf_dir, "lineitem"))


def items_of(lineitem: DataFrame, turned: bool = False) -> DataFrame:
    order, line, flag = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_returnflag")
    item_id = text_id(order * 10 + line)
    return records_of(
        lineitem,
        item_id,
        order % N_BRANCHES,
        {
            "quantity": F.col("l_quantity") / 4,
            "price": F.col("l_extendedprice"),
            "canceled": F.when(flag == "R", True).when(flag == "A", False),
            "createdAt": iso(F.col("l_shipdate")),
            "status": F.col("l_linestatus"),
            "cancellationComment": F.when((flag == "R") & (line == 2), F.concat(F.lit("back "), item_id)),
            "comment": F.when(line == 6, F.concat(F.lit("no salt "), text_id(order))),
            "cost": F.when(line == 4, F.col("l_extendedprice") / 2),
            "paid": F.when(line == 3, order % 2 == 0),
            "lastStockCountAt": F.when(line == 5, days_after(F.col("l_shipdate"), F.lit(-1))),
        },
        {
            "sale": one(text_id(order)),
            "product": one(text_id(F.col("l_partkey"))),
            "priceList": one(F.when(line <= 5, text_id(line))),
            "subitems": F.when(line == 1, many(F.concat(item_id, F.lit("-s")))),
        },
        extracted_at=F.col("l_shipdate"),
        ingest_seq=item_arrival(),
        turned=turned,
    )


def item_states_of(lineitem: DataFrame) -> DataFrame:
    """Order lines reduced to their state, which is the same in many rows."""
    order = F.col("l_orderkey")
    return records_of(
        lineitem,
        text_id(order * 10 + F.col("l_linenumber")),
        order % N_BRANCHES,
        {"status": F.col("l_linestatus")},
        extracted_at=F.col("l_shipdate"),
        ingest_seq=item_arrival(),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments_of(table(spark, sf_dir, "events"))


def payments_of(events: DataFrame) -> DataFrame:
    key, kind = F.col("event_id"), F.col("event_type")
    return records_of(
        events,
        text_id(key),
        F.col("user_id") % N_BRANCHES,
        {
            "amount": F.col("value"),
            "createdAt": iso(F.col("ts")),
            "canceled": F.col("value") > 300,
            "externalReference": F.when(key % 10 == 0, F.col("props")),
        },
        {
            "sale": one(F.when(kind.isin("purchase", "click", "view"), text_id(key % 15000))),
            "expense": one(F.when(kind.isin("signup", "view"), text_id(key))),
            "paymentMethod": one(F.when(key % 50 != 0, text_id(F.col("user_id") % 5))),
        },
        extracted_at=F.col("ts") + F.expr("INTERVAL 1 HOUR"),
    )


def expenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    key = F.col("event_id")
    return records_of(
        events,
        text_id(key),
        F.col("user_id") % N_BRANCHES,
        {
            "amount": F.col("value"),
            "date": iso(F.col("ts")),
            "createdAt": iso(F.col("ts")),
            "canceled": F.col("value") > 300,
            "status": F.col("event_type"),
            "receiptNumber": F.when(key % 3 == 0, F.concat(F.lit("R-"), text_id(key))),
            "useInCashCount": key % 2 == 0,
            "description": F.concat(F.lit("spent on "), text_id(key % 40)),
            "dueDate": days_after(F.col("ts"), F.lit(30)),
            "paymentDate": days_after(F.col("ts"), key % 30),
        },
        {
            "user": one(text_id(F.col("user_id"))),
            "provider": one(F.when(key % 4 != 0, text_id(key % 50))),
            "receiptType": one(F.when(key % 5 != 0, text_id(key % 3))),
            "cashRegister": one(F.when(key % 6 != 0, text_id(key % 7))),
            "paymentMethod": one(F.when(key % 7 != 0, text_id(key % 9))),
            "expenseItems": many(text_id(key)),
            "expenseCategory": one(F.when(key % 11 != 0, text_id(key % 25))),
        },
        extracted_at=F.col("ts") + F.expr("INTERVAL 1 HOUR"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    return records_of(
        _in_all_branches(table(spark, sf_dir, "part")),
        text_id(key),
        F.col("_branch"),
        {
            "name": F.col("p_name"),
            "price": F.col("p_retailprice"),
            "stock": size.cast("double"),
            "active": size > 5,
            "position": size,
            "code": F.when(key % 2 == 0, F.concat(F.lit("P"), text_id(key))),
            "cost": F.when(key % 3 == 0, F.col("p_retailprice") / 2),
            "description": F.when(key % 3 == 1, F.concat(F.lit("made of "), F.col("p_type"))),
            "enableOnlineMenu": F.when(key % 3 == 2, size % 2 == 0),
            "enableQrMenu": F.when(key % 4 == 0, size % 2 == 1),
            "favourite": F.when(key % 4 == 1, size > 20),
            "imageUrl": F.when(key % 4 == 2, F.concat(F.lit("https://img.example/"), text_id(key), F.lit(".png"))),
            "preparationTime": F.when(key % 4 == 3, size * 2),
            "sellAlone": F.when(key % 5 == 0, size > 10),
            "stockControl": F.when(key % 5 == 1, size > 30),
        },
        {
            "productCategory": one(F.when(key % 13 != 0, text_id(hex_number(F.col("p_type"), 7)))),
            "kitchen": one(text_id(hex_number(F.col("p_brand"), 7))),
            "productModifiersGroups": many(text_id(size)),
            "productProportions": F.when(key % 5 == 2, many(text_id(key * 2), text_id(key * 2 + 1))),
        },
    )


def product_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = table(spark, sf_dir, "part").select("p_type").distinct()
    number = hex_number(F.col("p_type"), 7)
    return records_of(
        _in_all_branches(types),
        text_id(number),
        F.col("_branch"),
        {
            "name": F.col("p_type"),
            "position": number % 100,
            "enableOnlineMenu": number % 2 == 0,
            "preparationTime": F.when(number % 3 != 0, number % 50),
        },
        {"kitchen": one(text_id(F.col("_branch"))), "parentCategory": one(F.when(number % 4 != 0, text_id(number % 8)))},
    )


def product_modifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return records_of(
        table(spark, sf_dir, "part"),
        text_id(key),
        key % N_BRANCHES,
        {"maxQuantity": F.col("p_size"), "price": F.col("p_retailprice")},
        {"product": one(text_id(key)), "productModifiersGroup": one(F.when(key % 3 != 0, text_id(F.col("p_size"))))},
    )


def payment_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "orders").select("o_orderpriority").distinct()
    return records_of(
        _in_all_branches(names),
        text_id(hex_number(F.col("o_orderpriority"), 7)),
        F.col("_branch"),
        {"name": F.col("o_orderpriority")},
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    opened = F.lit("2023-01-01").cast("timestamp")
    return records_of(
        table(spark, sf_dir, "customer"),
        text_id(F.col("c_custkey")),
        nation % N_BRANCHES,
        {
            "name": F.col("c_name"),
            "houseAccountBalance": F.col("c_acctbal"),
            "houseAccountEnabled": F.col("c_acctbal") > 0,
            "origin": F.col("c_mktsegment"),
            "salesCount": nation,
            "active": F.when(key % 3 != 0, key % 2 == 0),
            "address": F.when(key % 3 == 0, F.concat(text_id(key), F.lit(", High St"))),
            "comment": F.when(key % 5 == 0, F.concat(F.lit("comes at "), text_id(key % 24))),
            "createdAt": F.when(key % 7 != 0, days_after(opened, key % 300)),
            "discountPercentage": F.when(key % 4 == 0, F.col("c_acctbal") / 100),
            "email": F.when(key % 4 == 1, F.concat(F.lit("c"), text_id(key), F.lit("@example.org"))),
            "firstSaleDate": F.when(key % 4 == 2, days_after(opened, key % 310)),
            "historicalSalesCount": F.when(key % 4 == 3, (key % 100).cast("int")),
            "historicalTotalSpent": F.when(key % 5 == 1, F.col("c_acctbal") * 2),
            "lastSaleDate": F.when(key % 5 == 2, days_after(opened, key % 320)),
            "phone": F.when(key % 5 == 3, F.concat(F.lit("+"), text_id(key))),
            "vatNumber": F.when(key % 5 == 4, F.concat(F.lit("VAT"), text_id(key))),
        },
        {"paymentMethod": one(text_id(nation % 5))},
    )


def discounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.col("l_orderkey")
    return records_of(
        table(spark, sf_dir, "lineitem"),
        text_id(order * 10 + F.col("l_linenumber")),
        order % N_BRANCHES,
        {
            "percentage": F.col("l_discount") * 100,
            "amount": F.col("l_extendedprice") * F.col("l_discount"),
            "canceled": F.col("l_returnflag") == "R",
        },
        {"sale": one(text_id(order))},
        extracted_at=F.col("l_shipdate"),
        ingest_seq=item_arrival(),
    )


def ingredients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records_of(
        table(spark, sf_dir, "supplier"),
        text_id(F.col("s_suppkey")),
        F.col("s_nationkey") % N_BRANCHES,
        {
            "name": F.col("s_name"),
            "cost": F.col("s_acctbal"),
            "stock": F.when(F.col("s_suppkey") % 2 == 0, F.col("s_acctbal") / 4),
            "stockControl": F.col("s_acctbal") > 0,
        },
        {"ingredientCategory": one(text_id(F.col("s_nationkey")))},
    )


def expense_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records_of(
        table(spark, sf_dir, "nation"),
        text_id(F.col("n_nationkey")),
        F.col("n_regionkey"),
        {"name": F.col("n_name"), "active": F.col("n_nationkey") % 2 == 0, "financialCategory": F.lit("COSTS")},
        {"parentCategory": one(text_id(F.col("n_regionkey")))},
    )


def tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    return records_of(
        table(spark, sf_dir, "nation"),
        text_id(key),
        F.col("n_regionkey"),
        {"number": key, "row": key % 5, "column": (key / 5).cast("int"), "shape": F.lit("ROUND"), "size": F.concat(key.cast("string"), F.lit(".0"))},
        {"room": one(text_id(F.col("n_regionkey")))},
    )


def roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written with explicit JSON nulls: a role without permissions has ``null`` there."""
    key, name = F.col("r_regionkey"), F.col("r_name")
    permissions = F.array(F.concat(F.lit("read:"), name), F.concat(F.lit("write:"), name))
    return records_of(
        table(spark, sf_dir, "region"),
        text_id(key),
        key % N_BRANCHES,
        {"name": name, "isWaiter": key % 2 == 0, "isDeliveryman": F.when(key > 1, key % 2 == 1), "permissions": F.when(key > 0, permissions)},
        keep_nulls=True,
    )


def rooms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A region has a handful of nations, so the list of a room is short at any scale."""
    inside = (
        table(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").alias("r_regionkey"))
        .agg(F.array_sort(F.collect_list("n_nationkey")).alias("_keys"))
    )
    ids = F.transform("_keys", lambda k: F.struct(k.cast("string").alias("id")))
    return records_of(
        table(spark, sf_dir, "region").join(inside, "r_regionkey"),
        text_id(F.col("r_regionkey")),
        F.col("r_regionkey") % N_BRANCHES,
        {"name": F.col("r_name")},
        {"tables": F.struct(ids.alias("data"))},
    )


def kitchens(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = hex_number(F.col("p_brand"), 7)
    return records_of(
        table(spark, sf_dir, "part").select("p_brand").distinct(),
        text_id(number),
        number % N_BRANCHES,
        {"name": F.col("p_brand")},
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("user_id")
    return records_of(
        table(spark, sf_dir, "events").select("user_id").distinct(),
        text_id(key),
        key % N_BRANCHES,
        {
            "admin": key % 10 == 0,
            "active": F.lit(True),
            "name": F.concat(F.lit("User "), text_id(key)),
            "email": F.concat(F.lit("u"), text_id(key), F.lit("@example.org")),
            "promotionalCode": F.when(key % 3 == 0, F.concat(F.lit("CODE"), text_id(key))),
        },
        {"role": one(text_id(key % 5))},
    )


RECORDS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "customers": customers,
    "discounts": discounts,
    "expenses": expenses,
    "expense-categories": expense_categories,
    "ingredients": ingredients,
    "items": items,
    "kitchens": kitchens,
    "payments": payments,
    "payment-methods": payment_methods,
    "product-categories": product_categories,
    "product-modifiers": product_modifiers,
    "products": products,
    "roles": roles,
    "rooms": rooms,
    "sales": sales,
    "tables": tables,
    "users": users,
}


def branch_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One branch per nation; every fifth is closed."""
    key = F.col("n_nationkey")
    at = F.lit(FIXED).cast("timestamp")
    return table(spark, sf_dir, "nation").select(
        branch(key).alias("branch_id"),
        F.concat(F.lit("source-"), text_id(key)).alias("source_branch"),
        F.col("n_name").alias("branch_name"),
        (key % 5 != 4).alias("is_active"),
        at.alias("created_at"),
        at.alias("updated_at"),
    )
