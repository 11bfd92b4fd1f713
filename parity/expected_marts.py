"""What the marts must hold, computed straight from the tables in SQL."""

from parity.expected_views import (
    ALL_BRANCHES,
    BRANCH,
    CATEGORY_NUMBER,
    ITEM_BRANCH,
    ITEM_CANCELED,
    ITEM_ID,
    ITEM_SEQ,
    PRIORITY_NUMBER,
)

PAYMENT_ROWS = f"""
    SELECT event_id AS id, {BRANCH.format("user_id")} AS branch_id, value AS amount, ts,
           CASE WHEN event_type IN ('purchase', 'click', 'view') THEN event_id % 15000 END AS sale,
           CASE WHEN event_type IN ('signup', 'view') THEN event_id END AS expense,
           CASE WHEN event_id % 50 <> 0 THEN user_id % 5 END AS method, value > 300 AS canceled
    FROM events"""

ITEM_ROWS = f"""
    SELECT {ITEM_ID} AS id, {ITEM_BRANCH} AS branch_id, l_shipdate AS seen, {ITEM_SEQ} AS seq,
           l_orderkey AS sale, l_partkey AS product, l_quantity / 4 AS q, l_extendedprice AS p,
           {ITEM_CANCELED} AS canceled
    FROM lineitem"""

LINE_COLUMNS = """
    CAST(id AS BIGINT) AS id_order_line_source, branch_id, id || '-' || branch_id AS order_line_key,
    sale AS id_order_source, sale || '-' || branch_id AS order_key_fk, seen AS date_order_time,
    CAST(seen AS DATE) AS date_order, product AS id_product_source, product || '-' || branch_id AS product_key_fk,
    q AS qty_from_api, p AS price_from_api, p / q AS price_unit, CAST(q AS BIGINT) AS qty, (p / q) * q AS amount_total"""

ORDER_COLUMNS = f"""
    o_orderkey AS id_order, {BRANCH.format("o_orderkey")} AS branch_id,
    o_orderkey || '-' || {BRANCH.format("o_orderkey")} AS order_key, CAST(0 AS DOUBLE) AS amount_tax,
    o_totalprice AS amount_total, o_orderdate AS date_order, o_orderpriority AS sale_type,
    CAST(o_custkey % 25 AS VARCHAR) AS table_id,
    CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderkey % 7 AS VARCHAR) END AS waiter_id, o_orderdate AS created_at,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL 2 HOUR END AS closed_at"""

MARTS = {
    "branches": """
        SELECT 'branch_' || n_nationkey AS branch_id, n_name AS branch_name FROM nation WHERE n_nationkey % 5 <> 4""",
    "categories": f"""
        SELECT k AS id_rubro_source, 'branch_' || b AS branch_id, k || '-branch_' || b AS rubro_key,
               p_type AS rubro_name
        FROM (SELECT DISTINCT p_type, {CATEGORY_NUMBER} AS k FROM part), {ALL_BRANCHES}""",
    "payment_methods": f"""
        SELECT k AS id_payment_source, 'branch_' || b AS branch_id, k || '-branch_' || b AS payment_method_key,
               o_orderpriority AS payment_method
        FROM (SELECT DISTINCT o_orderpriority, {PRIORITY_NUMBER} AS k FROM orders), {ALL_BRANCHES}""",
    "products": f"""
        SELECT p_partkey AS id_product_source, 'branch_' || b AS branch_id, p_partkey || '-branch_' || b AS product_key,
               p_name AS product_name, CASE WHEN p_partkey % 13 <> 0 THEN {CATEGORY_NUMBER} END AS id_rubro_source,
               CASE WHEN p_partkey % 13 <> 0 THEN {CATEGORY_NUMBER} || '-branch_' || b END AS rubro_key_fk
        FROM part, {ALL_BRANCHES}""",
    "sales_order": f"SELECT {ORDER_COLUMNS} FROM orders WHERE o_orderstatus <> 'P'",
    "payments": f"""
        SELECT id, branch_id, id || '-' || branch_id AS payment_key, sale AS pos_order_id, method AS id_payment, amount,
               CASE WHEN expense IS NOT NULL THEN 'EXPENSE' WHEN sale IS NOT NULL THEN 'SALE' ELSE 'OTHER' END
                   AS transaction_type,
               CASE WHEN expense IS NOT NULL THEN -amount ELSE amount END AS signed_amount, ts AS payment_date,
               CAST(expense AS VARCHAR) AS expense_id, sale || '-' || branch_id AS order_key_fk
        FROM ({PAYMENT_ROWS}) WHERE method IS NOT NULL AND NOT canceled""",
    "sales_order_line": f"""
        SELECT {LINE_COLUMNS} FROM (
            SELECT DISTINCT ON (id, branch_id) * FROM ({ITEM_ROWS})
            WHERE canceled IS NOT TRUE AND q > 0 ORDER BY id, branch_id, seen DESC, seq DESC)""",
    "expense_categories": """
        SELECT CAST(n_nationkey AS BIGINT) AS id_expense_category, n_name AS expense_category_name,
               'COSTS' AS financial_category, n_nationkey % 2 = 0 AS active,
               CAST(n_regionkey AS VARCHAR) AS parent_category_id, 'branch_' || n_regionkey AS branch_id,
               n_nationkey || '-branch_' || n_regionkey AS expense_category_key
        FROM nation""",
    "expenses": f"""
        SELECT event_id AS id_expense, {BRANCH.format("user_id")} AS branch_id, value AS amount,
               'spent on ' || (event_id % 40) AS description, ts AS expense_date, event_type AS status,
               ts + INTERVAL 30 DAY AS due_date, value > 300 AS canceled, ts AS created_at,
               ts + to_days(CAST(event_id % 30 AS INTEGER)) AS payment_date,
               CASE WHEN event_id % 3 = 0 THEN 'R-' || event_id END AS receipt_number,
               event_id % 2 = 0 AS use_in_cash_count, CAST(user_id AS VARCHAR) AS user_id,
               CASE WHEN event_id % 4 <> 0 THEN CAST(event_id % 50 AS VARCHAR) END AS provider_id, CASE WHEN event_id % 5 <> 0 THEN CAST(event_id % 3 AS VARCHAR) END AS receipt_type_id,
               CASE WHEN event_id % 6 <> 0 THEN CAST(event_id % 7 AS VARCHAR) END AS cash_register_id, CASE WHEN event_id % 7 <> 0 THEN CAST(event_id % 9 AS VARCHAR) END AS payment_method_id,
               CASE WHEN event_id % 11 <> 0 THEN CAST(event_id % 25 AS VARCHAR) END AS expense_category_id,
               CASE WHEN event_id % 11 <> 0 THEN (event_id % 25) || '-' || {BRANCH.format("user_id")} END
                   AS expense_category_key
        FROM events""",
    "product_categories_details": f"""
        SELECT k AS id_product_category, p_type AS product_category_name, CAST(k % 100 AS INTEGER) AS position,
               CASE WHEN k % 3 <> 0 THEN CAST(k % 50 AS INTEGER) END AS preparation_time, k % 2 = 0 AS enable_online_menu,
               CAST(b AS VARCHAR) AS kitchen_id, CASE WHEN k % 4 <> 0 THEN CAST(k % 8 AS VARCHAR) END AS parent_category_id,
               'branch_' || b AS branch_id, k || '-branch_' || b AS product_category_key
        FROM (SELECT DISTINCT p_type, {CATEGORY_NUMBER} AS k FROM part), {ALL_BRANCHES}""",
    "product_prices_by_branch": f"""
        SELECT CAST(p_partkey AS VARCHAR) AS id_product_source, 'branch_' || b AS branch_id, p_name AS product_name,
               p_retailprice AS price, CAST(p_size AS DOUBLE) AS stock, p_size > 5 AS is_active_in_branch,
               p_partkey || '-branch_' || b AS product_branch_key
        FROM part, {ALL_BRANCHES}""",
}

# Latest version first, filter after: a line whose newest version is canceled is gone.
LATEST_THEN_FILTER = f"""
    SELECT {LINE_COLUMNS} FROM (
        SELECT DISTINCT ON (id, branch_id) * FROM ({ITEM_ROWS}) ORDER BY id, branch_id, seen DESC, seq DESC)
    WHERE canceled IS NOT TRUE AND q > 0"""
