"""The documents of ``feeds`` restated as SQL over the flat tables.

Named table expressions for the expected results. They never touch JSON, so
they are independent of the code they check.
"""

from __future__ import annotations

import re

# Fixed value: what a NULL part of a surrogate key counts as.
NULL_PART = "_dbt_utils_surrogate_key_null_"


def sk(*columns: str) -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), '{NULL_PART}')" for c in columns]
    return f"md5({parts[0]})" if len(parts) == 1 else f"md5(concat_ws('-', {', '.join(parts)}))"


def dk(c: str) -> str:
    return f"CAST(strftime({c}, '%Y%m%d') AS INTEGER)"


def dbl(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


_M = "DECIMAL(18,2)"
_METHOD = "coalesce(nullif(trim(lower(gateway)), ''), 'unknown')"
_ADJUSTMENT_DAY = "CAST(make_date(ym // 100, ym % 100, {d}) AS TIMESTAMP)"

CTES = {
    "line_rows": f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_shipdate,
  CAST(l_quantity AS INTEGER) AS qty, CAST(l_extendedprice AS {_M}) AS price,
  CAST(round(l_discount * 100) AS INTEGER) AS pct,
  CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CAST(round(l_quantity * 100) AS BIGINT), CAST(round(l_extendedprice * 100) AS BIGINT),
    CAST(round(l_discount * 100) AS BIGINT), CAST(round(l_tax * 100) AS BIGINT),
    l_returnflag, l_linestatus, strftime(l_shipdate, '%Y%m%d'))), 1, 15) AS BIGINT) AS line_id
FROM lineitem""",
    "order_line_rows": """
SELECT *, l_orderkey + 1000000000000 * ((row_number() OVER (PARTITION BY l_orderkey ORDER BY line_id) - 1) // 4) AS order_id,
  CASE WHEN l_partkey % 10 = 9 THEN l_partkey + 1000000000 ELSE l_partkey END AS sold_as
FROM line_rows""",
    "headers": f"""
SELECT o.*, coalesce(d.order_id, o_orderkey) AS order_id,
  CASE WHEN coalesce(d.order_id, o_orderkey) = o_orderkey THEN CAST(o_totalprice AS {_M}) ELSE 0 END AS total,
  CASE o_orderpriority WHEN '1-URGENT' THEN ' COD ' WHEN '2-HIGH' THEN 'VNPay' WHEN '3-MEDIUM' THEN ''
    WHEN '5-LOW' THEN 'bank_transfer' END AS gateway
FROM orders o LEFT JOIN (SELECT DISTINCT l_orderkey, order_id FROM order_line_rows) d ON o_orderkey = l_orderkey""",
    "refunds": f"""
SELECT line_id AS refund_id, order_id, l_shipdate AS created_at,
  CASE WHEN l_linestatus = 'O' THEN '' END AS note,
  CASE WHEN l_linestatus = 'O' THEN 'customer' ELSE 'damaged' END AS reason,
  CASE WHEN line_id % 29 <> 0 THEN price END AS refund_amount_vnd,
  line_id % 2 = 0 AS restock, price, line_id
FROM order_line_rows WHERE l_returnflag = 'R'""",
    "refund_sums": f"""
SELECT order_id, CAST(sum(refund_amount_vnd) AS DECIMAL(38,2)) AS refunded FROM refunds GROUP BY order_id""",
    "staged_orders": f"""
SELECT h.order_id, '#' || h.order_id AS order_name, CAST(h.order_id AS VARCHAR) AS order_number,
  CASE WHEN o_orderkey % 17 <> 0 THEN o_custkey END AS customer_id,
  CASE WHEN o_orderkey % 13 <> 0 THEN o_custkey % 25 END AS location_id,
  'VND' AS currency,
  CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'pending' ELSE 'partially_paid' END AS financial_status,
  CASE o_orderstatus WHEN 'F' THEN 'fulfilled' WHEN 'P' THEN 'partial' END AS fulfillment_status,
  total AS subtotal_vnd,
  CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(0 AS {_M}) END AS total_discount_vnd,
  CASE WHEN o_orderkey % 7 <> 0 THEN CAST((o_orderkey % 1000) * 0.25 AS {_M}) END AS total_tax_vnd,
  CAST(o_orderkey % 50 AS {_M}) AS total_shipping_vnd,
  total AS total_price_vnd,
  CASE WHEN o_orderkey % 5 <> 0 THEN CAST(coalesce(refunded, 0)
    + CASE WHEN o_orderkey % 19 = 0 THEN 2.50 ELSE 0 END AS {_M}) END AS total_refunded_vnd,
  o_orderdate AS created_at,
  o_orderdate + CAST(o_orderkey % 40 AS INTEGER) * INTERVAL 1 DAY AS order_updated_at,
  CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 10 DAY END AS closed_at,
  CAST(NULL AS TIMESTAMP) AS cancelled_at,
  coalesce(refunded, 0) AS refunded, gateway
FROM headers h LEFT JOIN refund_sums r ON h.order_id = r.order_id""",
    "net_orders": """
SELECT *, total_refunded_vnd AS total_refunded_reported_vnd, refunded AS total_refunded_calc_vnd,
  total_price_vnd - refunded AS net_revenue_vnd FROM staged_orders""",
    "transactions": """
SELECT order_id AS transaction_id, order_id, CAST(NULL AS BIGINT) AS refund_id, 'sale' AS kind,
  'success' AS status, gateway, total_price_vnd AS amount_vnd, created_at FROM staged_orders
UNION ALL
SELECT line_id, r.order_id, line_id, CASE WHEN line_id % 31 = 0 THEN 'chargeback' ELSE 'refund' END,
  'success', gateway, price, r.created_at FROM refunds r JOIN headers h ON r.order_id = h.order_id""",
    "sold_lines": f"""
SELECT l.order_id, s.customer_id, s.location_id, s.created_at, s.currency, line_id AS line_item_id,
  CASE WHEN line_id % 23 <> 0 THEN sold_as * 10 + l_linenumber % 3 END AS variant_id,
  CASE WHEN line_id % 11 <> 0 THEN sold_as END AS product_id,
  qty AS quantity, price AS unit_price_vnd,
  CASE WHEN pct > 5 THEN CAST(price + 10 AS {_M}) ELSE price END AS unit_price_original_vnd,
  CASE WHEN pct <> 0 THEN CAST(pct + 0.5 AS {_M}) END AS line_discount_vnd,
  CAST(price * qty AS DECIMAL(38,2)) AS line_total_vnd,
  'SKU-' || l_partkey AS sku,
  CASE WHEN l_partkey % 29 = 0 THEN '' ELSE 'Item ' || l_partkey || ' - ' || l_linenumber END AS title,
  CASE WHEN l_linenumber % 2 = 0 THEN 'V' || (l_linenumber % 3) END AS variant_title, l_partkey
FROM order_line_rows l JOIN staged_orders s ON l.order_id = s.order_id""",
    "customers": f"""
SELECT c_custkey AS customer_id, lower(c_name) || '@example.com' AS email,
  CASE WHEN c_nationkey % 2 = 0 THEN '+84' || c_custkey END AS phone,
  'Customer' AS first_name, c_name AS last_name,
  CASE WHEN c_acctbal < 0 THEN 'disabled' ELSE 'enabled' END AS state,
  c_mktsegment IN ('BUILDING', 'MACHINERY') AS accepts_marketing, c_nationkey AS orders_count,
  CASE WHEN c_mktsegment <> 'FURNITURE' THEN CAST(c_acctbal AS {_M}) END AS total_spent_vnd,
  c_mktsegment AS tags, CAST(DATE '2019-01-01' + c_nationkey AS TIMESTAMP) AS created_at,
  CAST(DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS TIMESTAMP) AS customer_updated_at
FROM customer""",
    "products": """
SELECT p_partkey AS product_id, p_name AS title, replace(p_name, ' ', '-') || '-' || p_partkey AS handle,
  p_brand AS vendor, p_type AS product_type, 'active' AS status, p_type || ',' || p_brand AS tags,
  CAST(DATE '2020-01-01' + p_size AS TIMESTAMP) AS created_at,
  CAST(DATE '2020-06-01' + CAST(p_partkey % 300 AS INTEGER) AS TIMESTAMP) AS product_updated_at,
  CASE WHEN p_type <> 'ECONOMY' THEN CAST(DATE '2020-02-01' + p_size AS TIMESTAMP) END AS published_at
FROM part""",
    "variants": f"""
SELECT p_partkey * 10 + i AS variant_id, p_partkey AS product_id, 'V' || i AS title,
  'SKU-' || p_partkey || '-' || i AS sku, CASE WHEN i = 1 THEN 'B' || p_partkey END AS barcode,
  CAST(p_retailprice AS {_M}) AS price_vnd,
  CASE WHEN i = 1 THEN CAST(CAST(p_retailprice AS {_M}) + 5 AS {_M}) END AS compare_at_price_vnd,
  p_size AS inventory_quantity, 'S' || i AS option1, '' AS option2, CAST(NULL AS VARCHAR) AS option3,
  'shop' AS inventory_management, 'deny' AS inventory_policy,
  CAST(CAST('0.' || (p_size + 100) AS DECIMAL(18,3)) AS DECIMAL(18,3)) AS weight, 'kg' AS weight_unit,
  CASE WHEN i <> 0 THEN CAST(DATE '2020-01-01' + p_size AS TIMESTAMP) END AS created_at,
  CAST(DATE '2020-06-01' + p_size + CAST(i AS INTEGER) AS TIMESTAMP) AS variant_updated_at
FROM part, range(3) t(i)""",
    "locations": """
SELECT CAST(n_nationkey AS BIGINT) AS location_id, n_name AS name, n_nationkey || ' High Street' AS address1, '' AS address2,
  'City ' || n_nationkey AS city, r_name AS province, n_name AS country, 'N' || n_nationkey AS country_code,
  lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS zip, CAST(NULL AS VARCHAR) AS phone, n_regionkey <> 3 AS active,
  CASE WHEN n_nationkey % 4 <> 0 THEN CAST(DATE '2018-01-01' + n_nationkey AS TIMESTAMP) END AS created_at,
  CASE WHEN n_nationkey % 5 <> 0 AND n_nationkey % 2 = 0
    THEN CAST(DATE '2023-01-01' + n_nationkey AS TIMESTAMP) END AS location_updated_at
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "adjustments": f"""
SELECT line_id AS adjustment_id,
  l_suppkey * 1000000 + ym + 10000000000000 * ((row_number() OVER (PARTITION BY l_suppkey, ym ORDER BY line_id) - 1) // 4) AS parent_adjustment_id,
  l_partkey * 10 + l_linenumber % 4 AS variant_id,
  CASE WHEN line_id % 37 = 0 THEN l_partkey + 1000000000 ELSE l_partkey END AS product_id,
  l_suppkey % 25 AS location_id, CASE WHEN l_returnflag = 'R' THEN qty ELSE -qty END AS quantity_delta,
  CASE WHEN l_linestatus <> 'O' THEN price END AS cost_delta_vnd, 'SKU-' || l_partkey AS sku,
  CAST(NULL AS VARCHAR) AS barcode,
  CASE WHEN l_suppkey % 9 <> 0 THEN {_ADJUSTMENT_DAY.format(d=1)} END AS created_at,
  {_ADJUSTMENT_DAY.format(d=15)} + INTERVAL '12 hours 30 minutes 250 milliseconds' AS adjustment_updated_at,
  CASE WHEN l_suppkey % 2 = 0 THEN 'recount' ELSE 'damage' END AS reason, CAST(NULL AS VARCHAR) AS note
FROM (SELECT *, CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS ym FROM line_rows)""",
    "levels": """
SELECT location_id, variant_id, snapshot_date, available_quantity, current_quantity, committed_quantity
FROM (SELECT user_id % 25 AS location_id, (event_id % 200) * 10 AS variant_id, CAST(ts AS DATE) AS snapshot_date,
  CAST(floor(value) AS INTEGER) - 20 AS available_quantity, CAST(floor(value) AS INTEGER) AS current_quantity,
  CASE WHEN event_type <> 'error' THEN 5 END AS committed_quantity,
  row_number() OVER (PARTITION BY user_id % 25, event_id % 200, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""",
    "products_seen": """
SELECT product_id, nullif(regexp_replace(title, ' - [^-]+$', ''), '') AS title
FROM (SELECT *, row_number() OVER (PARTITION BY product_id
  ORDER BY created_at DESC NULLS FIRST, order_id DESC, line_item_id DESC) AS rn FROM sold_lines) WHERE rn = 1""",
    "variants_seen": """
SELECT variant_id, product_id, sku, coalesce(variant_title, title) AS title, unit_price_vnd AS price_vnd
FROM (SELECT *, row_number() OVER (PARTITION BY variant_id
  ORDER BY created_at DESC NULLS FIRST, order_id DESC, line_item_id DESC) AS rn
  FROM sold_lines WHERE variant_id IS NOT NULL) WHERE rn = 1""",
    "adjusted_products": "SELECT DISTINCT product_id, CAST(NULL AS VARCHAR) AS title FROM adjustments",
    "adjusted_variants": f"""
SELECT variant_id, product_id, sku, CAST(NULL AS VARCHAR) AS title, CAST(NULL AS {_M}) AS price_vnd
FROM (SELECT *, row_number() OVER (PARTITION BY variant_id
  ORDER BY created_at DESC NULLS LAST, adjustment_id DESC) AS rn FROM adjustments) WHERE rn = 1""",
    "product_dim": f"""
SELECT {sk('product_id')} AS product_key, * FROM (
  SELECT *, false AS is_historical FROM products
  UNION ALL
  SELECT product_id, coalesce(title, '(unknown)'), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, true
  FROM (SELECT product_id, title, row_number() OVER (PARTITION BY product_id ORDER BY src) AS rn FROM (
    SELECT 1 AS src, * FROM products_seen UNION ALL SELECT 2, * FROM adjusted_products))
  WHERE rn = 1 AND product_id IS NOT NULL AND product_id NOT IN (SELECT product_id FROM products)
  UNION ALL
  SELECT NULL, '(unknown)', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, true)""",
    "variant_dim": f"""
SELECT {sk('variant_id')} AS variant_key, {sk('product_id')} AS product_key, * FROM (
  SELECT *, false AS is_historical FROM variants
  UNION ALL
  SELECT variant_id, product_id, title, sku, NULL, price_vnd, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
    NULL, NULL, true
  FROM (SELECT *, row_number() OVER (PARTITION BY variant_id ORDER BY src) AS rn FROM (
    SELECT 1 AS src, * FROM variants_seen UNION ALL SELECT 2, * FROM adjusted_variants))
  WHERE rn = 1 AND variant_id IS NOT NULL AND variant_id NOT IN (SELECT variant_id FROM variants)
  UNION ALL
  SELECT NULL, NULL, '(unknown)', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
    NULL, NULL, true)""",
    "holiday_list": """
SELECT DISTINCT d AS date_actual, CASE strftime(d, '%m-%d') WHEN '01-01' THEN 'New Year''s Day'
  WHEN '03-08' THEN 'Women''s Day' WHEN '04-30' THEN 'Reunification Day' WHEN '05-01' THEN 'Labour Day'
  WHEN '09-02' THEN 'National Day' ELSE 'Teachers'' Day' END AS holiday_name,
  strftime(d, '%m-%d') NOT IN ('03-08', '11-20') AS is_public_holiday
FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2008-12-31', INTERVAL 1 DAY)) AS DATE) AS d)
WHERE strftime(d, '%m-%d') IN ('01-01', '03-08', '04-30', '05-01', '09-02', '11-20')""",
    "date_dim": f"""
SELECT {dk('d')} AS date_key, d AS date_actual, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
  CAST(month(d) AS INTEGER) AS month_of_year, CAST(day(d) AS INTEGER) AS day_of_month,
  CAST(dayofweek(d) AS INTEGER) AS day_of_week, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
  dayofweek(d) IN (0, 6) AS is_weekend, coalesce(is_public_holiday, false) AS is_holiday, holiday_name,
  NOT (dayofweek(d) IN (0, 6) OR coalesce(is_public_holiday, false)) AS is_business_day
FROM (SELECT CAST(unnest(generate_series(CAST(min(o_orderdate) AS DATE),
    CAST(max(o_orderdate) AS DATE) + INTERVAL 4 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d FROM orders)
LEFT JOIN holiday_list ON d = date_actual""",
    "method_dim": f"""
SELECT {sk('method_name')} AS payment_method_key, method_name
FROM (SELECT DISTINCT {_METHOD} AS method_name FROM transactions)""",
    "order_facts": f"""
SELECT {sk('order_id')} AS order_key, order_id, {sk('customer_id')} AS customer_key, {sk('location_id')} AS location_key,
  {dk('created_at')} AS order_date_key, created_at, order_updated_at, financial_status, fulfillment_status, currency,
  subtotal_vnd, total_discount_vnd, total_tax_vnd, total_shipping_vnd, total_price_vnd, total_refunded_reported_vnd,
  total_refunded_calc_vnd AS total_refunded_vnd, net_revenue_vnd FROM net_orders""",
    "line_facts": f"""
SELECT {sk('order_id', 'line_item_id')} AS line_key, {sk('order_id')} AS order_key, {sk('variant_id')} AS variant_key,
  {sk('product_id')} AS product_key, {dk('created_at')} AS order_date_key, order_id, line_item_id, variant_id,
  product_id, quantity, unit_price_vnd, unit_price_original_vnd, line_discount_vnd, line_total_vnd, created_at
FROM sold_lines""",
    "transaction_facts": f"""
SELECT {sk('transaction_id')} AS transaction_key, {sk('order_id')} AS order_key,
  {sk(_METHOD)} AS payment_method_key, {dk('created_at')} AS transaction_date_key, transaction_id, order_id, refund_id,
  kind, status, gateway, amount_vnd, created_at FROM transactions""",
    "refund_facts": f"""
SELECT {sk('refund_id')} AS refund_key, {sk('order_id')} AS order_key, {dk('created_at')} AS refund_date_key, refund_id,
  order_id, reason, note, refund_amount_vnd, restock, created_at FROM refunds""",
    "adjustment_facts": f"""
SELECT {sk('adjustment_id')} AS adjustment_key, {sk('variant_id')} AS variant_key, {sk('location_id')} AS location_key,
  {dk('created_at')} AS adjustment_date_key, adjustment_id, variant_id, location_id, quantity_delta, cost_delta_vnd,
  reason, created_at AS adjusted_at FROM adjustments""",
    "snapshot_facts": f"""
SELECT {sk('location_id', 'variant_id', 'snapshot_date')} AS snapshot_key, {sk('variant_id')} AS variant_key,
  {sk('location_id')} AS location_key, {dk('snapshot_date')} AS snapshot_date_key, location_id, variant_id, snapshot_date,
  current_quantity AS on_hand_quantity, available_quantity, committed_quantity FROM levels""",
    "runs": """
SELECT 'run-' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS run_id, event_type AS domain,
  CASE WHEN user_id % 2 = 0 THEN 'full' ELSE 'incremental' END AS mode, ts AS started_at,
  CASE WHEN event_type <> 'purchase'
    THEN ts + CAST(round(value * 100) AS BIGINT) * INTERVAL 10 MILLISECOND END AS ended_at,
  CASE WHEN event_type <> 'purchase' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS rows_ingested,
  CASE event_type WHEN 'purchase' THEN 'running' WHEN 'error' THEN 'failed' ELSE 'success' END AS status,
  CASE WHEN event_type = 'error' THEN repeat('boom ', event_id % 400) END AS error_message, 'cron' AS triggered_by
FROM events""",
    "state": """
SELECT event_type AS domain, max(ts) - INTERVAL 10 DAY AS last_updated_at, 'run-before' AS last_run_id,
  TIMESTAMP '2024-01-20' AS updated_at,
  CASE WHEN event_type <> 'view' THEN max(event_id) // 2 END AS last_high_id
FROM events WHERE event_type <> 'signup' GROUP BY event_type""",
}


def sql(body: str) -> str:
    """``body`` preceded by the table expressions it uses, directly or not."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                visit(CTES[name])

    visit(body)
    used = [n for n in CTES if n in needed]
    if not used:
        return body.strip()
    head = ",\n".join(f"{n} AS ({CTES[n]})" for n in used)
    return f"WITH {head}\n{body.strip()}"
