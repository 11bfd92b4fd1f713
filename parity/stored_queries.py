"""Queries over stored tables: pages are landed, loaded in full runs, and read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parity import fixtures as fx
from parity.expected_marts import ORDER_COLUMNS
from parity.expected_views import BRANCH
from parity.operator_queries import SECOND_LOAD, raw_of, second_sales_load
from tillmart.entities import ENTITIES
from tillmart.functions.payload import leaf
from tillmart.operators.flatten import flatten
from tillmart.plans import raw_store
from tillmart.plans.load import LoadOptions
from tillmart.plans.quarantine import held_pages, put_aside, with_held
from tillmart.plans.run import BRANCH_TABLE, STATUS_TABLE, read_audit, run
from tillmart.plans.views import open_warehouse
from tillmart.plans.warehouse import Warehouse, new_version
from tillmart.schemas import STATUS
from tillmart.session import scratch_folder

FIRST, SECOND = (dt.datetime(2024, month, 1, tzinfo=dt.timezone.utc) for month in (2, 3))
FIRST_TS, SECOND_TS = "TIMESTAMP '2024-02-01 00:00:00'", "TIMESTAMP '2024-03-01 00:00:00'"
QUERIES, ORACLES = {}, {}


def query(sql: str):
    def register(build):
        QUERIES[build.__name__] = build
        ORACLES[build.__name__] = sql
        return build

    return register


def pages_of(records: DataFrame, entity: str) -> DataFrame:
    """Up to 500 successive ids in a page; a page that has fewer records counts as short.

    Records made of rows dealt out ``by_page`` are together already, and their JSON is not shuffled.
    """
    number = F.floor(F.abs(F.get_json_object("record", "$.id").cast("bigint")) / 500).cast("int") + 1
    place = [F.col(c) for c in fx.PAGE] if set(fx.PAGE) <= set(records.columns) else [F.col("branch_id"), number.alias("page_no")]
    joined = F.concat(F.lit('{"data":['), F.concat_ws(",", F.array_sort(F.collect_list("record"))), F.lit("]}"))
    paged = records.groupBy(*place).agg(joined.alias("body")).toDF("branch_id", "page_no", "body")
    return paged.select("branch_id", F.lit(entity).alias("entity"), "page_no", "body", F.lit(None).cast("timestamp").alias("landed_at"))


def warehouse_for(spark: SparkSession, named: DataFrame, root: str | None = None) -> Warehouse:
    """A warehouse of its own, in the shared folder unless told otherwise, with the branches that ``named`` has.

    These may be records or pages. Records are the better choice: their branches are found without making any JSON.
    """
    made = Warehouse(spark, root or f"{scratch_folder(spark, spark.conf.get('spark.sql.warehouse.dir'))}/parity-{new_version()}")
    none = F.lit(None)
    config = named.select("branch_id").distinct().select(
        "branch_id", none.cast("string").alias("source_branch"), F.col("branch_id").alias("branch_name"), F.lit(True).alias("is_active"),
        none.cast("timestamp").alias("created_at"), none.cast("timestamp").alias("updated_at"),
    )
    made.publish(BRANCH_TABLE, config, new_version())
    return made


def paged_orders(spark: SparkSession, sf_dir: str):
    """Orders as they lie in their file, and what deals them out for their pages."""
    return fx.table(spark, sf_dir, "orders", dealt=False), fx.by_page(spark, sf_dir, "orders", "o_orderkey")


def two_sales_loads(spark: SparkSession, sf_dir: str, **options) -> Warehouse:
    """All orders, then a second load: unchanged, changed and new ones."""
    orders, by_page = paged_orders(spark, sf_dir)
    first, second = pages_of(fx.sales_of(by_page(orders)), "sales"), pages_of(second_sales_load(orders, by_page), "sales")
    warehouse = warehouse_for(spark, fx.sales_of(orders).unionByName(second_sales_load(orders)))
    for pages, when in ((first, FIRST), (second, SECOND)):
        run(spark, pages, warehouse.root, when, marts=["sales_order"], **{"register": False, **options})
    warehouse.refresh()
    return warehouse


@query(f"""
    WITH {SECOND_LOAD}
    SELECT CAST(k AS VARCHAR) AS source_id, {BRANCH.format("k")} AS branch_id,
           CASE WHEN is_new OR (is_seen AND differs) THEN {SECOND_TS} ELSE {FIRST_TS} END AS extracted_at,
           CASE s WHEN 'F' THEN 'CLOSED' WHEN 'O' THEN 'OPEN' ELSE 'CANCELED' END AS sale_state
    FROM merged""")
def stored_raw_sales(spark, sf_dir):
    """One row per record after two loads; what did not change keeps its first time."""
    rows = raw_store.read_raw(two_sales_loads(spark, sf_dir), ENTITIES["sales"])
    return rows.select("source_id", "branch_id", "extracted_at", leaf("attributes.saleState").alias("sale_state"))


@query(f"""
    WITH merged AS (
        SELECT * FROM orders WHERE o_orderkey % 4 <> 0
        UNION ALL BY NAME SELECT * REPLACE (-o_orderkey - 5 AS o_orderkey) FROM orders WHERE o_orderkey % 10 = 3)
    SELECT {ORDER_COLUMNS} FROM merged WHERE o_orderstatus <> 'P'""")
def stored_sales_order(spark, sf_dir):
    """The published mart after the second load, read back."""
    return two_sales_loads(spark, sf_dir).read_published("marts/sales_order")


@query(f"""
    WITH {SECOND_LOAD}
    SELECT {FIRST_TS} AS run_ts, {BRANCH.format("k")} AS branch_id, count(*) AS extracted, count(*) AS inserted,
           CAST(0 AS BIGINT) AS updated, CAST(0 AS BIGINT) AS unchanged, CAST(0 AS BIGINT) AS rejected
    FROM first GROUP BY 2
    UNION ALL
    SELECT {SECOND_TS}, {BRANCH.format("k")}, count(*) FILTER (WHERE NOT is_left), count(*) FILTER (WHERE is_new),
           count(*) FILTER (WHERE is_seen AND differs), count(*) FILTER (WHERE is_seen AND NOT differs), 0
    FROM merged GROUP BY 2 HAVING count(*) FILTER (WHERE NOT is_left) > 0""")
def stored_load_audit(spark, sf_dir):
    """What two loads say they did."""
    return read_audit(two_sales_loads(spark, sf_dir)).select(
        "run_ts", "branch_id", "extracted", "inserted", "updated", "unchanged", "rejected"
    )


@query(f"""
    WITH {SECOND_LOAD}
    SELECT CAST(k AS VARCHAR) AS source_id, {BRANCH.format("k")} AS branch_id,
           CASE s WHEN 'F' THEN 'CLOSED' WHEN 'O' THEN 'OPEN' ELSE 'CANCELED' END AS sale_state,
           CAST(row_number() OVER (PARTITION BY {BRANCH.format("k")} ORDER BY CAST(k AS VARCHAR)) AS BIGINT) AS place
    FROM merged""")
def stored_view_by_name(spark, sf_dir):
    """The sales view under its name, for a reader that only opens the warehouse."""
    warehouse = two_sales_loads(spark, sf_dir)
    open_warehouse(spark, warehouse.root)
    return spark.sql(
        "SELECT source_id, branch_id, sale_state,"
        " CAST(row_number() OVER (PARTITION BY branch_id ORDER BY source_id) AS BIGINT) AS place FROM view_sales"
    )


@query(f"""
    SELECT {BRANCH.format("o_orderkey")} AS branch_id, count(*) AS records,
           count(*) AS with_payload, CAST(sum(o_orderkey) AS BIGINT) AS id_sum
    FROM orders GROUP BY 1""")
def view_original_payload(spark, sf_dir):
    """The payload passes through the view as it came."""
    orders, by_page = paged_orders(spark, sf_dir)
    pages = pages_of(fx.sales_of(by_page(orders)), "sales")
    warehouse = warehouse_for(spark, fx.sales_of(orders))
    run(spark, pages, warehouse.root, FIRST, marts=[], register=False)
    warehouse.refresh()
    view = flatten(raw_store.read_raw(warehouse, ENTITIES["sales"]), ENTITIES["sales"])
    number = F.get_json_object("original_payload", "$.id").cast("bigint")
    return view.groupBy("branch_id").agg(F.count(F.lit(1)).alias("records"), F.count("original_payload").alias("with_payload"), F.sum(number).alias("id_sum"))


@query(f"""
    WITH paged AS (
        SELECT {BRANCH.format("o_orderkey")} AS branch_id, o_orderkey // 500 + 1 AS p, count(*) AS n FROM orders GROUP BY 1, 2),
    kinds AS (SELECT *, CASE WHEN branch_id = 'branch_0' AND p = 1 THEN 'nameless' WHEN branch_id = 'branch_1' AND p = 1 THEN 'html' ELSE 'good' END AS kind FROM paged),
    told AS (
        SELECT branch_id, sum(n) FILTER (WHERE kind <> 'html' ) AS extracted, count(*) FILTER (WHERE kind <> 'good') AS rejected
        FROM kinds GROUP BY 1)
    SELECT branch_id, CAST(extracted AS BIGINT) AS extracted, rejected,
           CAST(CASE WHEN rejected > 0 THEN 0 ELSE extracted END AS BIGINT) AS inserted,
           CAST(CASE WHEN rejected > 0 THEN 0 ELSE extracted END AS BIGINT) AS held,
           CASE WHEN rejected > 0 THEN 'FAILED' ELSE 'INCOMPLETE' END AS status
    FROM told""")
def load_audit_of_damaged_pages(spark, sf_dir):
    """A page without a number, one that is no JSON, and short pages; beside the counts, what is really held."""
    records = fx.sales(spark, sf_dir)
    pages = pages_of(records, "sales")
    first = F.col("page_no") == 1
    damaged = pages.withColumn("body", F.when(first & (F.col("branch_id") == "branch_1"), F.lit("<html>oops")).otherwise(F.col("body"))).withColumn(
        "page_no", F.when(~(first & (F.col("branch_id") == "branch_0")), F.col("page_no"))
    )
    warehouse = warehouse_for(spark, records)
    run(spark, damaged, warehouse.root, FIRST, options=LoadOptions(), marts=[], register=False)
    warehouse.refresh()
    held = raw_store.read_raw(warehouse, ENTITIES["sales"]).groupBy("branch_id").agg(F.count(F.lit(1)).alias("held"))
    told = read_audit(warehouse).select("branch_id", "extracted", "rejected", "inserted", "status")
    return told.join(held, "branch_id", "left").withColumn("held", F.coalesce("held", F.lit(0)).cast("bigint"))


@query(f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS source_id, {BRANCH.format("o_orderkey")} AS branch_id, o_totalprice + 1 AS total,
           TIMESTAMP '2024-01-02 00:00:00' AS extracted_at
    FROM orders""")
def latest_of_two_landings(spark, sf_dir):
    """Every page landed twice, with other content: the later landing counts, in whatever order they are read."""
    orders, by_page = paged_orders(spark, sf_dir)
    old = pages_of(fx.sales_of(by_page(orders)), "sales").withColumn("landed_at", F.lit("2024-01-01").cast("timestamp"))
    new = pages_of(fx.sales_of(by_page(orders.withColumn("o_totalprice", F.col("o_totalprice") + 1))), "sales")
    pages = new.withColumn("landed_at", F.lit("2024-01-02").cast("timestamp")).unionByName(old)
    warehouse = warehouse_for(spark, fx.sales_of(orders))
    run(spark, pages, warehouse.root, FIRST, marts=[], register=False)
    warehouse.refresh()
    rows = raw_store.read_raw(warehouse, ENTITIES["sales"])
    return rows.select("source_id", "branch_id", leaf("attributes.total").cast("double").alias("total"), "extracted_at")


def landed_on(pages: DataFrame, day: str) -> DataFrame:
    return pages.withColumn("landed_at", F.lit(day).cast("timestamp"))


@query(f"""
    WITH told AS (SELECT {BRANCH.format("o_orderkey")} AS branch_id, count(*) AS n FROM orders GROUP BY 1)
    SELECT {FIRST_TS} + INTERVAL (run) HOUR AS run_ts, branch_id, n AS extracted,
           CASE WHEN run = 0 THEN n ELSE 0 END AS inserted, CAST(0 AS BIGINT) AS updated,
           CASE WHEN run = 0 THEN 0 ELSE n END AS unchanged, n AS held, CAST(0 AS BIGINT) AS replaced
    FROM told, range(4) AS runs(run)""")
def reload_of_older_landing(spark, sf_dir):
    """A landing, and then three times one that is older: nothing is added, nothing is counted as changed."""
    orders, by_page = paged_orders(spark, sf_dir)
    new = landed_on(pages_of(fx.sales_of(by_page(orders.withColumn("o_totalprice", F.col("o_totalprice") + 1))), "sales"), "2024-01-02")
    old = landed_on(pages_of(fx.sales_of(by_page(orders)), "sales"), "2024-01-01")
    warehouse = warehouse_for(spark, fx.sales_of(orders))
    for hour, pages in enumerate((new, old, old, old)):
        run(spark, pages, warehouse.root, FIRST + dt.timedelta(hours=hour), marts=[], register=False)
    warehouse.refresh()
    sales = ENTITIES["sales"]
    held = raw_store.read_raw(warehouse, sales).groupBy("branch_id").agg(F.count(F.lit(1)).alias("held"))
    replaced = raw_store.read_history(warehouse, sales).groupBy("branch_id").agg(F.count(F.lit(1)).alias("replaced"))
    told = read_audit(warehouse).select("run_ts", "branch_id", "extracted", "inserted", "updated", "unchanged")
    return told.join(held, "branch_id").join(replaced, "branch_id", "left").withColumn("replaced", F.coalesce("replaced", F.lit(0)).cast("bigint"))


def line_records(orders: DataFrame, price, canceled) -> DataFrame:
    """Orders as order lines of their own."""
    key = F.col("o_orderkey")
    made = {"createdAt": fx.iso(F.col("o_orderdate")), "price": price, "quantity": F.lit(2.0), "canceled": canceled}
    return fx.records_of(orders, fx.text_id(key), key % fx.N_BRANCHES, made, {"sale": fx.one(fx.text_id(key)), "product": fx.one(fx.text_id(key % 7))})


@query(f"""
    SELECT o_orderkey AS id_order_line_source, {BRANCH.format("o_orderkey")} AS branch_id,
           CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price_from_api
    FROM orders""")
def stored_marts_by_change(spark, sf_dir):
    """Order lines over four loads, of which the last three touch some: where the newest version is canceled, the one before shows."""
    orders = fx.table(spark, sf_dir, "orders")
    key, price, no, yes = F.col("o_orderkey"), F.col("o_totalprice"), F.lit(False), F.lit(True)
    loads = [
        line_records(orders, price, no),
        line_records(orders.where(key % 3 == 0), price, yes),
        line_records(orders.where(key % 5 == 0), price + 1, no),
        line_records(orders.where(key % 15 == 0), price + 2, yes),
    ]
    # Without a time of their own they are stamped by their run.
    pages = [pages_of(records.drop("extracted_at"), "items") for records in loads]
    warehouse = warehouse_for(spark, loads[0])
    for hour, some in enumerate(pages):
        run(spark, some, warehouse.root, FIRST + dt.timedelta(hours=hour), marts=["sales_order_line"], register=False)
    warehouse.refresh()
    return warehouse.read_published("marts/sales_order_line").select("id_order_line_source", "branch_id", "price_from_api")


@query(f"""
    WITH told AS (SELECT {BRANCH.format("o_orderkey")} AS branch_id, count(*) AS n FROM orders GROUP BY 1),
    sets AS (SELECT *, (n + 499) // 500 AS pages, n % 500 <> 0 AS ends FROM told)
    SELECT {FIRST_TS} AS run_ts, branch_id, CASE WHEN pages = 1 AND ends THEN 'LOADED' ELSE 'INCOMPLETE' END AS status, ends AS advanced
    FROM sets
    UNION ALL
    SELECT {SECOND_TS}, branch_id, CASE WHEN ends THEN 'LOADED' ELSE 'INCOMPLETE' END, ends FROM sets WHERE pages > 1""")
def completeness_over_loads(spark, sf_dir):
    """The odd pages of each branch in one load, the even ones in the next: a set is complete, and its status advances, when its last page comes."""
    orders = fx.table(spark, sf_dir, "orders")
    place = F.row_number().over(Window.partitionBy(F.col("o_orderkey") % fx.N_BRANCHES).orderBy("o_orderkey"))
    number = F.floor((place - 1) / 500).cast("int") + 1
    numbers = orders.select(F.col("o_orderkey").cast("string").alias("id"), number.alias("page_no"))
    records = fx.sales_of(orders).withColumn("id", F.get_json_object("record", "$.id")).join(numbers, "id")
    body = F.concat(F.lit('{"data":['), F.concat_ws(",", F.collect_list("record")), F.lit("]}"))
    paged = records.groupBy("branch_id", "page_no").agg(body.alias("body"))
    pages = paged.select("branch_id", F.lit("sales").alias("entity"), "page_no", "body", F.lit(None).cast("timestamp").alias("landed_at"))
    # An order without a key is on no page.
    warehouse = warehouse_for(spark, fx.sales_of(orders.where(F.col("o_orderkey").isNotNull())))
    for when, odd in ((FIRST, 1), (SECOND, 0)):
        run(spark, pages.where(F.col("page_no") % 2 == odd), warehouse.root, when, marts=[], register=False)
    warehouse.refresh()
    status = warehouse.read(STATUS_TABLE, STATUS).select("branch_id", F.lit(True).alias("advanced"))
    told = read_audit(warehouse).select("run_ts", "branch_id", "status").join(status, "branch_id", "left")
    return told.withColumn("advanced", F.coalesce("advanced", F.lit(False)))


@query(f"""
    SELECT {BRANCH.format("o_orderkey")} AS branch_id, count(*) AS held, CAST(sum(o_orderkey) AS BIGINT) AS id_sum, CAST(0 AS BIGINT) AS aside
    FROM orders GROUP BY 1""")
def quarantine_and_replay(spark, sf_dir):
    """A branch whose page has a bad record fails; the others load, and it does when that page lands again, with nothing twice."""
    orders = fx.table(spark, sf_dir, "orders")
    good = pages_of(fx.sales_of(orders), "sales")
    spoilt = (F.col("branch_id") == "branch_1") & (F.col("page_no") == 1)
    bad = good.withColumn("body", F.when(spoilt, F.regexp_replace("body", r'^\{"data":\[', '{"data":[{"id":null},')).otherwise(F.col("body")))
    warehouse = warehouse_for(spark, fx.sales_of(orders))
    for hour, batch in enumerate((bad, good.where(spoilt))):
        pages = with_held(batch, held_pages(warehouse))
        report = run(spark, pages, warehouse.root, FIRST + dt.timedelta(hours=hour), marts=[], register=False)
        warehouse.refresh()
        put_aside(warehouse, pages, report)
    rows = raw_store.read_raw(warehouse, ENTITIES["sales"])
    aside = held_pages(warehouse).groupBy("branch_id").agg(F.count(F.lit(1)).alias("aside"))
    told = rows.groupBy("branch_id").agg(F.count(F.lit(1)).alias("held"), F.sum(F.col("source_id").cast("bigint")).alias("id_sum"))
    return told.join(aside, "branch_id", "left").withColumn("aside", F.coalesce("aside", F.lit(0)).cast("bigint"))


@query(f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS source_id, {BRANCH.format("o_orderkey")} AS branch_id,
           CAST(row_number() OVER (PARTITION BY {BRANCH.format("o_orderkey")} ORDER BY CAST(o_orderkey AS VARCHAR)) AS BIGINT) AS place
    FROM orders""")
def view_ordered(spark, sf_dir):
    """The sales view, sorted: the place that each row of a branch has in what comes out."""
    view = flatten(raw_of(spark, sf_dir, "sales"), ENTITIES["sales"], ordered=True)
    told = view.select("source_id", "branch_id", F.monotonically_increasing_id().alias("at"))
    place = F.row_number().over(Window.partitionBy("branch_id").orderBy("at"))
    return told.select("source_id", "branch_id", place.cast("bigint").alias("place"))


@query(f"""
    SELECT o_orderkey AS id, {BRANCH.format("o_orderkey")} AS branch_id, o_totalprice AS amount,
           CASE WHEN o_orderkey % 3 = 0 THEN 'EXPENSE' ELSE 'SALE' END AS transaction_type,
           CASE WHEN o_orderkey % 3 = 0 THEN -o_totalprice ELSE o_totalprice END AS signed_amount
    FROM orders""")
def stored_payments_there_and_back(spark, sf_dir):
    """Payments over three loads: as they were, other amounts that are canceled, and as they were again, which is nothing new."""
    orders = fx.table(spark, sf_dir, "orders")
    key, text = F.col("o_orderkey"), fx.text_id(F.col("o_orderkey"))

    def pages(amount, canceled):
        made = {"amount": amount, "createdAt": fx.iso(F.col("o_orderdate")), "canceled": canceled}
        links = {"sale": fx.one(text), "expense": fx.one(F.when(key % 3 == 0, text)), "paymentMethod": fx.one(fx.text_id(key % 5))}
        return pages_of(fx.records_of(orders, text, key % fx.N_BRANCHES, made, links).drop("extracted_at"), "payments")

    first, second = pages(F.col("o_totalprice"), F.lit(False)), pages(F.col("o_totalprice") + 1, F.lit(True))
    warehouse = warehouse_for(spark, orders.select(fx.branch(key % fx.N_BRANCHES).alias("branch_id")))
    for hour, batch in enumerate((first, second, first)):
        run(spark, batch, warehouse.root, FIRST + dt.timedelta(hours=hour), marts=["payments"], register=False)
    warehouse.refresh()
    return warehouse.read_published("marts/payments").select("id", "branch_id", "amount", "transaction_type", "signed_amount")
