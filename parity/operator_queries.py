"""Queries that show one operator each, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parity import fixtures as fx
from parity.expected_marts import ITEM_ROWS, LATEST_THEN_FILTER, LINE_COLUMNS, MARTS, PAYMENT_ROWS
from parity.expected_views import BRANCH, ITEM_BRANCH, ITEM_ID, ITEM_SEQ
from tillmart.entities import ENTITIES
from tillmart.functions.payload import leaf, with_doc
from tillmart.functions.records import accepted, canonical_json, parse_iso_timestamp, payload_checksum, to_raw
from tillmart.operators.checks import cast_failures, contract_report, evolve_schema, split_by_required, unique_violations
from tillmart.operators.dedupe import latest_per_key
from tillmart.operators.flatten import flatten
from tillmart.operators.merge import (
    append_new_versions,
    delete_by_key,
    last_extraction,
    merge_branches,
    set_last_extraction,
    upsert_latest,
)
from tillmart.plans.load import load_audit, staged_changes
from tillmart.plans.marts import payments_with_sale, payments_without_sale, sales_order_line
from tillmart.schemas import CONTRACTS, struct
from tillmart.sources.pages import page_completeness, unnest_pages
from tillmart.sources.selection import active_branches, incremental_filter, incremental_filter_by_status, project_fields

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SALES, ITEMS, PAYMENTS, USERS, EXPENSES = (
    ENTITIES[n] for n in ("sales", "items", "payments", "users", "expenses")
)
RUN_TS = "2024-03-01 00:00:00"


def query(sql: str | None = None):
    def register(build: Query) -> Query:
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


def raw_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Raw rows of an entity, all versions."""
    return accepted(to_raw(fx.RECORDS[name](spark, sf_dir), ENTITIES[name]))


# ---- sources -------------------------------------------------------------------------


@query("""
    SELECT 'branch_' || n_nationkey AS branch_id, 'source-' || n_nationkey AS source_branch, n_name AS branch_name
    FROM nation WHERE n_nationkey % 5 <> 4""")
def source_active_branches(spark, sf_dir):
    return active_branches(fx.branch_config(spark, sf_dir))


def sales_pages(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """Sales as pages of up to 100 records: 500 successive order keys, 100 for each branch.

    Order keys are unique, so a page never gets longer than that.
    """
    orders = fx.table(spark, sf_dir, "orders") if orders is None else orders
    texts = fx.sales_of(orders)
    # The record text carries its key, so pages are put in order by it.
    number = F.get_json_object("record", "$.id").cast("bigint")
    return (
        texts.withColumn("_n", number)
        .groupBy("branch_id", (F.floor(F.col("_n") / 500) + 1).cast("int").alias("page_no"))
        .agg(F.array_sort(F.collect_list(F.struct("_n", "record"))).alias("_records"))
        .select(
            "branch_id",
            F.lit("sales").alias("entity"),
            "page_no",
            F.concat(
                F.lit('{"data":['), F.concat_ws(",", F.transform("_records", lambda r: r["record"])), F.lit("]}")
            ).alias("body"),
        )
    )


@query(f"""
    SELECT {BRANCH.format("o_orderkey")} AS branch_id, 'sales' AS entity,
           CAST(o_orderkey // 500 + 1 AS INTEGER) AS page_no,
           CAST(row_number() OVER (PARTITION BY o_orderkey % 5, o_orderkey // 500 ORDER BY o_orderkey) - 1 AS INTEGER) AS pos,
           CAST(o_orderkey AS VARCHAR) AS source_id, o_totalprice AS total
    FROM orders""")
def source_pages_unnest(spark, sf_dir):
    records = unnest_pages(sales_pages(spark, sf_dir))
    raw = with_doc(records.withColumnRenamed("record", "payload"), ["id", "attributes.total"])
    return raw.select(
        "branch_id", "entity", "page_no", "pos", leaf("id").alias("source_id"),
        leaf("attributes.total").cast("double").alias("total"),
    )


@query(f"""
    WITH kept AS (
        SELECT o_orderkey % 5 AS b, CAST(o_orderkey // 500 + 1 AS INTEGER) AS p FROM orders
        WHERE NOT ((o_orderkey // 500) % 3 = 1 AND o_orderkey % 500 >= 450)),
    counted AS (SELECT b, p, count(*) AS n FROM kept GROUP BY b, p),
    summed AS (
        SELECT b, count(*) AS pages, sum(n) AS records, max(p) AS last_page, arg_max(n, p) AS last_page_size,
               count(*) FILTER (WHERE n < 100) AS short
        FROM counted GROUP BY b)
    SELECT 'branch_' || b AS branch_id, 'sales' AS entity, pages, CAST(records AS BIGINT) AS records, last_page,
           last_page_size, CAST(0 AS BIGINT) AS bad_pages,
           CAST(short - CASE WHEN last_page_size < 100 THEN 1 ELSE 0 END AS BIGINT) AS short_pages_before_last,
           CAST(last_page - pages AS BIGINT) AS missing_pages,
           short = 1 AND last_page_size < 100 AND last_page = pages AS is_complete
    FROM summed""")
def source_pages_completeness(spark, sf_dir):
    key = F.col("o_orderkey")
    dropped = (F.floor(key / 500) % 3 == 1) & (key % 500 >= 450)
    orders = fx.table(spark, sf_dir, "orders").where(~dropped)
    return page_completeness(sales_pages(spark, sf_dir, orders), page_size=100)


@query(f"""
    SELECT CAST(event_id AS VARCHAR) AS source_id, {BRANCH.format("user_id")} AS branch_id,
           'amount,canceled,createdAt,date,description,dueDate,paymentDate,' || CASE WHEN event_id % 3 = 0 THEN 'receiptNumber,' ELSE '' END
               || 'status,useInCashCount' AS attributes,
           'cashRegister,expenseCategory,expenseItems,paymentMethod,provider,receiptType,user' AS relationships
    FROM events""")
def source_project_fields(spark, sf_dir):
    """Records come with members nobody asked for; those must go."""
    extra = F.regexp_replace(
        F.regexp_replace("record", r'"attributes":\{', r'"attributes":{"internalNote":"x",'),
        r'"relationships":\{', r'"relationships":{"auditLog":{"data":{"id":"1"}},',
    )
    cut = project_fields(fx.expenses(spark, sf_dir).withColumn("record", extra), EXPENSES)

    def names(member: str):
        return F.concat_ws(",", F.array_sort(F.json_object_keys(F.get_json_object("record", f"$.{member}")))).alias(member)

    return cut.select(
        F.get_json_object("record", "$.id").alias("source_id"), "branch_id", names("attributes"), names("relationships")
    )


@query(f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS source_id, {BRANCH.format("o_orderkey")} AS branch_id
    FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""")
def source_incremental_filter(spark, sf_dir):
    import datetime as dt

    since = dt.datetime(1998, 1, 1, tzinfo=dt.timezone.utc)
    taken = incremental_filter(fx.sales(spark, sf_dir), SALES, since)
    return taken.select(F.get_json_object("record", "$.id").alias("source_id"), "branch_id")


@query(f"""
    WITH s AS (
        SELECT o_orderkey % 5 AS b, max(o_orderdate) - INTERVAL 100 DAY AS since
        FROM orders WHERE o_orderkey % 5 < 4 GROUP BY b)
    SELECT CAST(o_orderkey AS VARCHAR) AS source_id, {BRANCH.format("o_orderkey")} AS branch_id
    FROM orders LEFT JOIN s ON b = o_orderkey % 5 WHERE since IS NULL OR o_orderdate >= since""")
def source_incremental_by_status(spark, sf_dir):
    """Four branches were loaded before, up to 100 days before their newest order."""
    key = F.col("o_orderkey")
    status = (
        fx.table(spark, sf_dir, "orders").where(key % 5 < 4)
        .groupBy(fx.branch(key % 5).alias("branch_id"), F.lit("sales").alias("entity"))
        .agg((F.max("o_orderdate").cast("timestamp") - F.expr("INTERVAL 100 DAYS")).alias("last_successful_extraction"))
    )
    taken = incremental_filter_by_status(fx.sales(spark, sf_dir), SALES, status)
    return taken.select(F.get_json_object("record", "$.id").alias("source_id"), "branch_id")


@query("""
    SELECT max(ts) AS last_successful_extraction FROM events WHERE user_id = 7 AND event_type = 'click' HAVING count(*) > 0""")
def source_last_extraction(spark, sf_dir):
    return last_extraction(event_status(fx.table(spark, sf_dir, "events")), "branch_7", "click")


# ---- raw rows ------------------------------------------------------------------------

USER_JSON = """'{"attributes":{"active":true,"admin":' || (u % 10 = 0) || ',"email":"u' || u
    || '@example.org","name":"User ' || u || '"' || CASE WHEN u % 3 = 0 THEN ',"promotionalCode":"CODE' || u || '"' ELSE '' END
    || '},"id":"' || u || '","relationships":{"role":{"data":{"id":"' || (u % 5) || '"}}}}'"""


@query(f"""
    SELECT CAST(u AS VARCHAR) AS source_id, {BRANCH.format("u")} AS branch_id, TIMESTAMP '{RUN_TS}' AS extracted_at,
           CAST(NULL AS TIMESTAMP) AS source_updated_at, md5({USER_JSON}) AS payload_checksum
    FROM (SELECT DISTINCT user_id AS u FROM events)""")
def raw_rows_of_a_run(spark, sf_dir):
    """Records stamped with the time of the run, id and checksum taken from the text."""
    records = fx.users(spark, sf_dir).withColumn("extracted_at", F.lit(RUN_TS).cast("timestamp"))
    return accepted(to_raw(records, USERS)).select(
        "source_id", "branch_id", "extracted_at", "source_updated_at", "payload_checksum"
    )


@query(f"""
    SELECT CAST(u AS VARCHAR) AS source_id, {USER_JSON} AS canonical
    FROM (SELECT DISTINCT user_id AS u FROM events)""")
def raw_canonical_json(spark, sf_dir):
    """Keys come sorted at every level, whatever their order was."""
    parsed = F.parse_json("record")
    return fx.users(spark, sf_dir).select(
        F.get_json_object("record", "$.id").alias("source_id"), canonical_json(parsed).alias("canonical")
    )


ITEM_CONTENT = "l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_shipdate, l_linestatus, l_partkey"


@query(f"""
    SELECT {ITEM_BRANCH} AS branch_id, count(*) AS records, count(*) AS same_in_other_order,
           count(DISTINCT ({ITEM_CONTENT})) AS contents
    FROM lineitem GROUP BY 1""")
def raw_payload_checksum(spark, sf_dir):
    """Checksums do not see the order of keys, and differ when the content does."""
    sums = fx.items_of(fx.table(spark, sf_dir, "lineitem"), turned=True).select(
        "branch_id",
        payload_checksum(F.parse_json("record")).alias("a"),
        payload_checksum(F.parse_json("turned")).alias("b"),
    )
    # Count per checksum first, as bytes: map-side sums leave one row per checksum to shuffle, half as long as its digits.
    per_sum = sums.groupBy("branch_id", F.unhex("a").alias("a")).agg(F.count("*").alias("n"), F.count_if(F.col("a") == F.col("b")).alias("same"))
    return per_sum.groupBy("branch_id").agg(
        F.sum("n").alias("records"), F.sum("same").alias("same_in_other_order"), F.count("*").alias("contents")
    )


@query(f"""
    SELECT {BRANCH.format("o_orderkey")} AS branch_id, count(*) AS records,
           count(*) FILTER (WHERE o_orderkey % 7 = 0) AS made_up_ids,
           count(*) FILTER (WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 = 0) AS rejected,
           count(*) FILTER (WHERE o_orderkey % 7 = 0 OR o_orderkey % 11 <> 0) AS distinct_ids
    FROM orders GROUP BY 1""")
def raw_record_id(spark, sf_dir):
    """Every 7th record has no id and gets one; every 11th has id null and is rejected."""
    key = F.col("o_orderkey")
    rest = F.concat(F.lit('"attributes":{"total":'), F.col("o_totalprice").cast("string"), F.lit("}}"))
    head = (
        F.when(key % 7 == 0, F.lit("{"))
        .when(key % 11 == 0, F.lit('{"id":null,'))
        .otherwise(F.concat(F.lit('{"id":"'), key.cast("string"), F.lit('",')))
    )
    records = fx.table(spark, sf_dir, "orders").select(
        fx.branch(key % 5).alias("branch_id"), key.alias("ingest_seq"), F.concat(head, rest).alias("record"),
        F.lit(RUN_TS).cast("timestamp").alias("extracted_at"),
    )
    rows = to_raw(records, SALES)
    per_id = rows.groupBy("branch_id", "source_id").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("source_id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")).alias("made_up"),
        F.count_if(F.col("reject_reason") == "null_id").alias("bad"),
    )
    return per_id.groupBy("branch_id").agg(
        F.sum("n").alias("records"), F.sum("made_up").alias("made_up_ids"), F.sum("bad").alias("rejected"),
        F.count("source_id").alias("distinct_ids"),
    )


@query("""
    SELECT o_orderkey, CASE o_orderkey % 8
        WHEN 0 THEN o_orderdate WHEN 1 THEN o_orderdate WHEN 2 THEN o_orderdate + INTERVAL 3 HOUR
        WHEN 3 THEN date_trunc('day', o_orderdate) END AS parsed
    FROM orders""")
def raw_parse_iso_timestamp(spark, sf_dir):
    """Z, an offset and a bare date are read; empty and senseless text, a time of day and a year give null."""
    key, date = F.col("o_orderkey"), F.col("o_orderdate")
    plain = F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss")
    text = (
        F.when(key % 8 == 0, fx.iso(date))
        .when(key % 8 == 1, F.concat(plain, F.lit("+00:00")))
        .when(key % 8 == 2, F.concat(plain, F.lit("-03:00")))
        .when(key % 8 == 3, F.date_format(date, "yyyy-MM-dd"))
        .when(key % 8 == 4, F.lit(""))
        .when(key % 8 == 5, F.lit("12:30"))
        .when(key % 8 == 6, F.lit("2024"))
        .otherwise(F.concat(F.lit("on "), plain))
    )
    return fx.table(spark, sf_dir, "orders").select("o_orderkey", parse_iso_timestamp(text).alias("parsed"))


@query(f"""
    SELECT 'sales' AS entity, CAST(o_orderkey AS VARCHAR) AS source_id,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL 2 HOUR ELSE o_orderdate END AS source_updated_at
    FROM orders
    UNION ALL SELECT 'payments', CAST(event_id AS VARCHAR), ts FROM events
    UNION ALL SELECT DISTINCT 'payment-methods', o_orderpriority, CAST(NULL AS TIMESTAMP) FROM orders""")
def raw_source_updated_at(spark, sf_dir):
    """Sales are dated by closing, else by creation; payments by creation; methods not at all."""
    sales, payments, methods = (
        raw_of(spark, sf_dir, name).withColumn("entity", F.lit(name)) for name in ("sales", "payments", "payment-methods")
    )
    columns = ["entity", "source_id", "source_updated_at"]
    # Every branch has the same methods; by name they are one each.
    named = methods.withColumn("source_id", F.get_json_object("payload", "$.attributes.name")).select(*columns).distinct()
    return sales.select(*columns).unionByName(payments.select(*columns)).unionByName(named)


# ---- merges --------------------------------------------------------------------------


@query(f"""
    WITH rows AS (SELECT *, {ITEM_SEQ} AS seq, l_suppkey % 3 = 0 AS before FROM lineitem)
    SELECT {ITEM_ID} AS source_id, {ITEM_BRANCH} AS branch_id, l_linestatus AS status,
           coalesce(arg_min(l_shipdate, seq) FILTER (WHERE before), arg_min(l_shipdate, seq)) AS extracted_at,
           coalesce(min(seq) FILTER (WHERE before), min(seq)) AS ingest_seq
    FROM rows GROUP BY l_orderkey, l_linenumber, l_linestatus""")
def raw_append_new_versions(spark, sf_dir):
    """A third of the lines were loaded before; the second load brings all of them.

    The records hold the state of a line only, so many versions of a line are the same.
    """
    lines = fx.table(spark, sf_dir, "lineitem")
    before = accepted(to_raw(fx.item_states_of(lines.where(F.col("l_suppkey") % 3 == 0)), ITEMS))
    batch = accepted(to_raw(fx.item_states_of(lines), ITEMS))
    held = append_new_versions(before.limit(0), before)
    after = with_doc(append_new_versions(held, batch), ["attributes.status"])
    return after.select(
        "source_id", "branch_id", leaf("attributes.status").alias("status"), "extracted_at", "ingest_seq"
    )


def second_sales_load(orders: DataFrame, dealt=lambda rows: rows) -> DataFrame:
    """Even orders once more, every fourth now canceled, and some orders never seen. ``dealt`` deals out the orders before they become records."""
    key = F.col("o_orderkey")
    again = orders.where(key % 2 == 0).withColumn(
        "o_orderstatus", F.when(key % 4 == 0, F.lit("P")).otherwise(F.col("o_orderstatus"))
    )
    fresh = orders.where(key % 10 == 3).withColumn("o_orderkey", -key - 5)
    return fx.sales_of(dealt(again.unionByName(fresh))).withColumn("extracted_at", F.lit(RUN_TS).cast("timestamp"))


SECOND_LOAD = f"""
    first AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_orderdate + INTERVAL 1 DAY AS seen FROM orders),
    second AS (
        SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 = 0 THEN 'P' ELSE o_orderstatus END AS s FROM orders
        WHERE o_orderkey % 2 = 0
        UNION ALL SELECT -o_orderkey - 5, o_orderstatus FROM orders WHERE o_orderkey % 10 = 3),
    merged AS (
        SELECT coalesce(f.k, n.k) AS k, coalesce(n.s, f.s) AS s, f.k IS NULL AS is_new,
               f.k IS NOT NULL AND n.k IS NOT NULL AS is_seen, f.s IS DISTINCT FROM n.s AS differs, f.seen AS seen,
               n.k IS NULL AS is_left
        FROM first f FULL JOIN second n ON f.k = n.k)"""


@query(f"""
    WITH {SECOND_LOAD}
    SELECT CAST(k AS VARCHAR) AS source_id, {BRANCH.format("k")} AS branch_id,
           CASE WHEN is_new OR (is_seen AND differs) THEN TIMESTAMP '{RUN_TS}' ELSE seen END AS extracted_at,
           CASE s WHEN 'F' THEN 'CLOSED' WHEN 'O' THEN 'OPEN' ELSE 'CANCELED' END AS sale_state
    FROM merged""")
def raw_upsert_latest(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders")
    raw = accepted(to_raw(fx.sales_of(orders), SALES))
    batch = accepted(to_raw(second_sales_load(orders), SALES))
    merged = with_doc(upsert_latest(raw, batch), ["attributes.saleState"])
    return merged.select("source_id", "branch_id", "extracted_at", leaf("attributes.saleState").alias("sale_state"))


@query(f"""
    WITH {SECOND_LOAD}
    SELECT TIMESTAMP '{RUN_TS}' AS run_ts, {BRANCH.format("k")} AS branch_id, 'sales' AS entity,
           count(*) FILTER (WHERE NOT is_left) AS extracted, count(*) FILTER (WHERE is_new) AS inserted,
           count(*) FILTER (WHERE is_seen AND differs) AS updated,
           count(*) FILTER (WHERE is_seen AND NOT differs) AS unchanged, CAST(0 AS BIGINT) AS rejected,
           CAST(0 AS BIGINT) AS bad_dates, 'INCOMPLETE' AS status, CAST(NULL AS VARCHAR) AS detail
    FROM merged GROUP BY 2 HAVING count(*) FILTER (WHERE NOT is_left) > 0""")
def load_audit_of_sales(spark, sf_dir):
    """The second load, from pages to counts of what it did. Its pages are not full, so it does not count as complete."""
    import datetime as dt

    orders = fx.table(spark, sf_dir, "orders")
    raw = accepted(to_raw(fx.sales_of(orders), SALES))
    run_ts = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
    records = second_sales_load(orders)
    # Pages by id number, so that they stay short.
    number = F.floor(F.get_json_object("record", "$.id").cast("bigint") / 500).cast("int")
    pages = (
        records.groupBy("branch_id", number.alias("page_no"))
        .agg(F.concat_ws(",", F.collect_list("record")).alias("_body"))
        .select("branch_id", F.lit("sales").alias("entity"), "page_no", F.concat(F.lit('{"data":['), "_body", F.lit("]}")).alias("body"))
    )
    staged = staged_changes(unnest_pages(pages), raw, SALES, run_ts)
    return load_audit(page_completeness(pages), staged, SALES, run_ts)


def event_status(events: DataFrame) -> DataFrame:
    return events.groupBy(
        F.concat(F.lit("branch_"), F.col("user_id").cast("string")).alias("branch_id"), F.col("event_type").alias("entity")
    ).agg(F.max("ts").cast("timestamp").alias("last_successful_extraction"))


@query("""
    SELECT 'branch_' || user_id AS branch_id, event_type AS entity, coalesce(
        max(ts) FILTER (WHERE event_id % 3 = 0), max(ts)) AS last_successful_extraction
    FROM events GROUP BY user_id, event_type""")
def status_upsert(spark, sf_dir):
    """Pairs loaded again take their new time, even an earlier one; others keep theirs."""
    events = fx.table(spark, sf_dir, "events")
    return set_last_extraction(event_status(events), event_status(events.where("event_id % 3 = 0")))


CUSTOMER_BRANCHES = "SELECT 'c' || c_custkey AS branch_id, c_name AS branch_name, c_custkey AS k FROM customer"


def customer_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, at = F.col("c_custkey"), F.lit(fx.FIXED).cast("timestamp")
    return fx.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("c"), key.cast("string")).alias("branch_id"), F.lit("old").alias("source_branch"),
        F.col("c_name").alias("branch_name"), (key % 3 != 0).alias("is_active"), at.alias("created_at"), at.alias("updated_at"),
    )


@query(f"""
    SELECT branch_id, CASE WHEN k % 2 = 0 THEN 'new' ELSE 'old' END AS source_branch,
           CASE WHEN k % 2 = 0 THEN upper(branch_name) ELSE branch_name END AS branch_name, k % 3 <> 0 AS is_active,
           TIMESTAMP '{fx.FIXED}' AS created_at,
           CASE WHEN k % 2 = 0 THEN TIMESTAMP '{RUN_TS}' ELSE TIMESTAMP '{fx.FIXED}' END AS updated_at
    FROM ({CUSTOMER_BRANCHES})
    UNION ALL
    SELECT 's' || s_suppkey, 'new', s_name, TRUE, TIMESTAMP '{RUN_TS}', TIMESTAMP '{RUN_TS}' FROM supplier""")
def config_merge(spark, sf_dir):
    """Known branches get new names but stay open or closed; new ones are open."""
    known = customer_branches(spark, sf_dir)
    renamed = known.where(F.substring("branch_id", 2, 20).cast("bigint") % 2 == 0).select(
        "branch_id", F.lit("new").alias("source_branch"), F.upper("branch_name").alias("branch_name")
    )
    added = fx.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("branch_id"), F.lit("new").alias("source_branch"),
        F.col("s_name").alias("branch_name"),
    )
    return merge_branches(known, renamed.unionByName(added), F.lit(RUN_TS).cast("timestamp"))


@query(f"SELECT branch_id, branch_name FROM ({CUSTOMER_BRANCHES}) WHERE branch_id <> 'c7'")
def config_delete(spark, sf_dir):
    return delete_by_key(customer_branches(spark, sf_dir), "branch_id", "c7").select("branch_id", "branch_name")


@query("""
    SELECT o_orderkey AS id_order, CAST(0 AS DOUBLE) AS amount_tax, o_totalprice AS amount_total,
           o_orderdate AS date_order, CAST(NULL AS VARCHAR) AS sale_type, CAST(NULL AS VARCHAR) AS table_id,
           CAST(NULL AS VARCHAR) AS waiter_id
    FROM orders""")
def schema_evolve(spark, sf_dir):
    """A table of the first shape gets the three columns that came later."""
    first = fx.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id_order"), F.lit(0.0).alias("amount_tax"), F.col("o_totalprice").alias("amount_total"),
        F.col("o_orderdate").alias("date_order"),
    )
    return evolve_schema(first, struct("amount_tax:double sale_type:string table_id:string waiter_id:string"))


# ---- choice of versions and checks ---------------------------------------------------


@query(f"""
    SELECT DISTINCT ON (id, branch_id) id AS source_id, branch_id, seen AS extracted_at, seq AS ingest_seq
    FROM ({ITEM_ROWS}) ORDER BY id, branch_id, seen DESC, seq DESC""")
def latest_version(spark, sf_dir):
    return latest_per_key(raw_of(spark, sf_dir, "items").select("source_id", "branch_id", "extracted_at", "ingest_seq"))


@query(LATEST_THEN_FILTER)
def latest_then_filter(spark, sf_dir):
    return sales_order_line(raw_of(spark, sf_dir, "items"), latest_first=True)


@query(f"""
    SELECT p.id, p.branch_id, p.sale AS pos_order_id FROM ({PAYMENT_ROWS}) p
    WHERE method IS NOT NULL AND NOT canceled AND sale IS NOT NULL AND NOT EXISTS (
        SELECT 1 FROM orders WHERE o_orderkey = p.sale AND {BRANCH.format("o_orderkey")} = p.branch_id)""")
def payments_orphan_check(spark, sf_dir):
    return payments_without_sale(raw_of(spark, sf_dir, "payments"), raw_of(spark, sf_dir, "sales"))


@query(f"""
    SELECT p.id, p.branch_id, p.sale AS pos_order_id, o_orderkey IS NOT NULL AS has_sale
    FROM ({PAYMENT_ROWS}) p LEFT JOIN orders ON o_orderkey = p.sale AND {BRANCH.format("o_orderkey")} = p.branch_id
    WHERE method IS NOT NULL AND NOT canceled""")
def payments_joined_to_sales(spark, sf_dir):
    return payments_with_sale(raw_of(spark, sf_dir, "payments"), raw_of(spark, sf_dir, "sales"))


@query(f"""
    SELECT {ITEM_ID} AS source_id, {ITEM_BRANCH} AS branch_id, count(*) AS copies
    FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def check_unique(spark, sf_dir):
    """Record keys of the raw lines, which are not unique."""
    return unique_violations(raw_of(spark, sf_dir, "items"), ["source_id", "branch_id"])


@query(f"""
    SELECT CAST(id AS VARCHAR) AS payment_id, concat_ws(',', CASE WHEN sale IS NULL THEN 'sale_id' END,
           CASE WHEN method IS NULL THEN 'payment_method_id' END) AS missing
    FROM ({PAYMENT_ROWS}) WHERE sale IS NULL OR method IS NULL""")
def check_required(spark, sf_dir):
    view = flatten(raw_of(spark, sf_dir, "payments"), PAYMENTS)
    _, rejects = split_by_required(view, ["payment_id", "sale_id", "payment_method_id"])
    return rejects.select("payment_id", F.concat_ws(",", "missing").alias("missing"))


def damaged_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines, every 9th order with a quantity that is no number."""
    lines = fx.items(spark, sf_dir)
    number = F.get_json_object("record", "$.relationships.sale.data.id").cast("bigint")
    broken = F.regexp_replace("record", r'"quantity":[^,]*', '"quantity":"some"')
    return accepted(to_raw(lines.withColumn("record", F.when(number % 9 == 0, broken).otherwise(F.col("record"))), ITEMS))


@query(f"""
    SELECT {ITEM_ID} AS source_id, {ITEM_BRANCH} AS branch_id, l_shipdate AS extracted_at, 'quantity' AS bad
    FROM lineitem WHERE l_orderkey % 9 = 0""")
def check_casts(spark, sf_dir):
    found = cast_failures(damaged_items(spark, sf_dir), ITEMS)
    return found.select("source_id", "branch_id", "extracted_at", F.concat_ws(",", "bad").alias("bad"))


@query(f"""
    SELECT {LINE_COLUMNS} FROM (
        SELECT DISTINCT ON (id, branch_id) * FROM ({ITEM_ROWS})
        WHERE canceled IS NOT TRUE AND q > 0 AND sale % 9 <> 0 ORDER BY id, branch_id, seen DESC, seq DESC)""")
def lenient_sales_order_line(spark, sf_dir):
    """Without strict casts the lines that cannot be read drop out and the mart stands."""
    return sales_order_line(damaged_items(spark, sf_dir), strict=False)


@query(f"""
    SELECT c AS "column", w AS wanted_type, a AS actual_type, r AS required,
           CASE c WHEN 'id' THEN ids WHEN 'pos_order_id' THEN sales ELSE 0 END AS nulls
    FROM (SELECT count(*) FILTER (WHERE id IS NULL) AS ids, count(*) FILTER (WHERE pos_order_id IS NULL) AS sales
          FROM ({MARTS["payments"]})),
         (VALUES ('id', 'bigint', 'bigint', TRUE), ('pos_order_id', 'bigint', 'bigint', TRUE),
                 ('id_payment', 'bigint', 'bigint', TRUE), ('amount', 'double', 'double', TRUE),
                 ('payment_date', 'timestamp', 'timestamp', TRUE), ('branch_id', 'string', 'string', TRUE)) v(c, w, a, r)""")
def check_contract(spark, sf_dir):
    """The payments mart against its documented shape, which wants a sale on every one."""
    from tillmart.plans.marts import payments

    return contract_report(payments(raw_of(spark, sf_dir, "payments")), CONTRACTS["payments"])


@query(MARTS["sales_order"])
def sales_order_from_pages(spark, sf_dir):
    """The whole way: pages, records, raw rows, first load of the raw table, mart."""
    from tillmart.plans.marts import sales_order

    records = unnest_pages(sales_pages(spark, sf_dir)).withColumn("extracted_at", F.lit(RUN_TS).cast("timestamp"))
    batch = accepted(to_raw(records, SALES))
    return sales_order(latest_per_key(batch))
