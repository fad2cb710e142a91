"""Queries on staging and intermediate tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.catalog.feeds import raw
from tradeloom.catalog.flat import dbl, sql
from tradeloom.catalog.registry import query
from tradeloom.operators import intermediate as im
from tradeloom.operators import staging as st
from tradeloom.operators.dimensions import missing_from
from tradeloom.operators.pick import first_source

HEADER_COLUMNS = [
    "order_id", "order_name", "order_number", "customer_id", "location_id", "currency", "financial_status",
    "fulfillment_status", "subtotal_vnd", "total_discount_vnd", "total_tax_vnd", "total_shipping_vnd",
    "total_price_vnd", "total_refunded_vnd", "created_at", "order_updated_at", "closed_at", "cancelled_at",
]
ORDER_MONEY = dbl(
    "subtotal_vnd", "total_discount_vnd", "total_tax_vnd", "total_shipping_vnd", "total_price_vnd", "total_refunded_vnd"
)
HEADER_SQL = f"""order_id, order_name, order_number, customer_id, location_id, currency, financial_status,
  fulfillment_status, {ORDER_MONEY}, created_at, order_updated_at, closed_at, cancelled_at"""
COLLECTION_COLUMNS = ["collection_id", "title", "handle", "description", "published_at", "collection_updated_at"]


def staged_orders(spark: SparkSession, sf: str, *keep: str) -> DataFrame:
    return st.orders(raw(spark, sf, "orders"), keep=keep)


def staged_refunds(spark: SparkSession, sf: str) -> DataFrame:
    return st.order_refunds(staged_orders(spark, sf, "order_id", "refunds_json"))


def staged_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return st.order_transactions(staged_orders(spark, sf, "order_id", "refunds_json", "transactions_json"))


def staged_lines(spark: SparkSession, sf: str) -> DataFrame:
    return im.order_lines(
        staged_orders(spark, sf, "order_id", "customer_id", "location_id", "created_at", "currency", "line_items_json")
    )


def lines_for_latest(spark: SparkSession, sf: str) -> DataFrame:
    return staged_orders(spark, sf, "order_id", "created_at", "line_items_json")


def staged_adjustments(spark: SparkSession, sf: str, *keep: str) -> DataFrame:
    return st.inventory_adjustments(raw(spark, sf, "inventory_adjustments"), keep=keep or None)


def adjusted_products(spark: SparkSession, sf: str) -> DataFrame:
    return im.products_in_adjustments(staged_adjustments(spark, sf, "product_id"))


def adjusted_variants(spark: SparkSession, sf: str) -> DataFrame:
    return im.variants_in_adjustments(staged_adjustments(spark, sf, "variant_id", "product_id", "sku", "created_at", "adjustment_id"))


def without_envelope(df: DataFrame) -> DataFrame:
    return df.drop(*st.ENVELOPE)


@query(
    "stg_orders",
    sql(f"""
SELECT {HEADER_SQL}, CAST(coalesce(n_lines, 0) AS INTEGER) AS n_lines, CAST(coalesce(n_refunds, 0) AS INTEGER) AS n_refunds,
  CAST(1 + coalesce(n_copies, 0) AS INTEGER) AS n_transactions,
  'City ' || (o_custkey % 25) AS city, true AS has_payload
FROM staged_orders s
JOIN (SELECT order_id AS oid, o_custkey FROM headers) ON oid = order_id
LEFT JOIN (SELECT order_id AS lid, count(*) AS n_lines, count_if(l_returnflag = 'R') AS n_refunds,
  count_if(l_returnflag = 'R' AND line_id % 2 = 0) AS n_copies FROM order_line_rows GROUP BY order_id) ON lid = order_id"""),
)
def _(spark, sf):
    df = st.orders(raw(spark, sf, "orders"))
    return df.select(
        *HEADER_COLUMNS,
        F.size("line_items_json").alias("n_lines"),
        F.size("refunds_json").alias("n_refunds"),
        F.size("transactions_json").alias("n_transactions"),
        F.get_json_object("shipping_address_json", "$.city").alias("city"),
        F.col("payload_raw").isNotNull().alias("has_payload"),
    )


@query(
    "stg_customers",
    sql("""SELECT customer_id, email, phone, first_name, last_name, state, accepts_marketing, orders_count,
CAST(total_spent_vnd AS DOUBLE) AS total_spent_vnd, tags, created_at, customer_updated_at,
'[{"country":"' || orders_count || '"}]' AS addresses_json,
CASE WHEN orders_count > 5 THEN '{"label":"main"}' END AS default_address_json FROM customers"""),
)
def _(spark, sf):
    return without_envelope(st.customers(raw(spark, sf, "customers")))


@query(
    "stg_products",
    sql("SELECT *, 4 AS n_variants, '[]' AS images_json, '[{\"name\":\"Size\"}]' AS options_json FROM products"),
)
def _(spark, sf):
    df = without_envelope(st.products(raw(spark, sf, "products")))
    return df.withColumn("n_variants", F.size("variants_json")).drop("variants_json")


@query(
    "stg_variants",
    sql(f"""SELECT variant_id, product_id, title, sku, barcode, {dbl('price_vnd', 'compare_at_price_vnd')},
inventory_quantity, option1, option2, option3, inventory_management, inventory_policy, {dbl('weight')}, weight_unit,
created_at, variant_updated_at FROM variants"""),
)
def _(spark, sf):
    staged = st.products(raw(spark, sf, "products"), keep=["product_id", "variants_json"])
    return without_envelope(st.variants(staged))


@query("stg_locations", sql("SELECT * FROM locations"))
def _(spark, sf):
    return without_envelope(st.locations(raw(spark, sf, "locations")))


@query(
    "stg_refunds",
    sql("""SELECT refund_id, order_id, created_at, note, reason, CAST(refund_amount_vnd AS DOUBLE) AS refund_amount_vnd, restock,
1 AS n_transactions, '[{"line_item_id":' || refund_id || ',"quantity":' || qty || '}]' AS refund_line_items_json
FROM refunds JOIN (SELECT line_id AS lid, qty FROM line_rows) ON lid = refund_id"""),
)
def _(spark, sf):
    df = without_envelope(staged_refunds(spark, sf))
    return df.withColumn("n_transactions", F.size("refund_transactions_json")).drop("refund_transactions_json")


@query(
    "stg_transactions",
    sql("""SELECT transaction_id, order_id, refund_id, kind, status, gateway, CAST(amount_vnd AS DOUBLE) AS amount_vnd,
created_at FROM transactions"""),
)
def _(spark, sf):
    return without_envelope(staged_transactions(spark, sf))


@query(
    "stg_adjustments",
    sql("""SELECT adjustment_id, parent_adjustment_id, variant_id, product_id, location_id, quantity_delta,
CAST(cost_delta_vnd AS DOUBLE) AS cost_delta_vnd, sku, barcode, created_at, adjustment_updated_at, reason, note,
'ADJ-' || parent_adjustment_id AS adjust_number FROM adjustments"""),
)
def _(spark, sf):
    return without_envelope(staged_adjustments(spark, sf))


@query("stg_inventory", sql("SELECT * FROM levels"))
def _(spark, sf):
    return without_envelope(st.inventory_levels(raw(spark, sf, "inventory_locations")))


@query(
    "stg_custom_collections",
    """SELECT doc_id AS collection_id, source AS title, lang AS handle, text AS description,
CASE WHEN n_chars % 4 <> 0 THEN CAST(DATE '2022-01-01' + CAST(n_chars % 365 AS INTEGER) AS TIMESTAMP) END AS published_at,
CAST(DATE '2022-01-01' + CAST(doc_id % 700 AS INTEGER) AS TIMESTAMP) AS collection_updated_at FROM documents""",
)
def _(spark, sf):
    return without_envelope(st.collections(raw(spark, sf, "custom_collections")))


@query(
    "stg_smart_collections",
    """SELECT page_id AS collection_id, url AS title, 'page-' || page_id AS handle, html AS description,
CAST(NULL AS TIMESTAMP) AS published_at, TIMESTAMP '2022-06-01 01:00:00' AS collection_updated_at FROM pages""",
)
def _(spark, sf):
    return without_envelope(st.collections(raw(spark, sf, "smart_collections")))


@query(
    "stg_discounts",
    """SELECT p_partkey AS discount_id, 'D' || p_partkey AS code,
CASE WHEN p_size % 2 = 0 THEN 'percentage' ELSE 'fixed_amount' END AS value_type,
CASE WHEN p_size % 5 <> 0 THEN CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) END AS value, p_type AS applies_to,
CAST(DATE '2020-01-01' + p_size AS TIMESTAMP) AS starts_at,
CASE WHEN p_size <= 25 THEN CAST(DATE '2020-02-01' + p_size AS TIMESTAMP) END AS ends_at,
p_size AS usage_count, 'enabled' AS status, CAST(DATE '2020-01-01' + p_size AS TIMESTAMP) AS discount_updated_at FROM part""",
)
def _(spark, sf):
    return without_envelope(st.discounts(raw(spark, sf, "discounts")))


@query(
    "stg_promotions",
    """SELECT s_suppkey AS promotion_id, s_name AS title, 'fixed_amount' AS value_type,
CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS value, CAST(DATE '2021-01-01' + s_nationkey AS TIMESTAMP) AS starts_at,
CAST(NULL AS TIMESTAMP) AS ends_at, CASE WHEN s_acctbal < 0 THEN 'disabled' ELSE 'enabled' END AS status,
CAST(DATE '2021-03-01' + s_nationkey AS TIMESTAMP) AS promotion_updated_at FROM supplier""",
)
def _(spark, sf):
    return without_envelope(st.promotions(raw(spark, sf, "promotions")))


@query(
    "order_lines",
    sql(f"""SELECT order_id, customer_id, location_id, created_at, currency, line_item_id, variant_id, product_id, quantity,
{dbl('unit_price_vnd', 'unit_price_original_vnd', 'line_discount_vnd', 'line_total_vnd')} FROM sold_lines"""),
)
def _(spark, sf):
    return staged_lines(spark, sf)


@query("latest_product_seen", sql("SELECT * FROM products_seen"))
def _(spark, sf):
    return im.products_in_orders(lines_for_latest(spark, sf))


@query(
    "latest_variant_seen",
    sql("SELECT variant_id, product_id, sku, title, CAST(price_vnd AS DOUBLE) AS price_vnd FROM variants_seen"),
)
def _(spark, sf):
    return im.variants_in_orders(lines_for_latest(spark, sf))


@query("adj_products_seen", sql("SELECT * FROM adjusted_products"))
def _(spark, sf):
    return adjusted_products(spark, sf)


@query(
    "adj_variants_seen",
    sql("SELECT variant_id, product_id, sku, title, CAST(price_vnd AS DOUBLE) AS price_vnd FROM adjusted_variants"),
)
def _(spark, sf):
    return adjusted_variants(spark, sf)


@query("refund_sum_by_order", sql(f"SELECT order_id, {dbl('refunded')} FROM refund_sums"))
def _(spark, sf):
    return im.refunds_by_order(staged_refunds(spark, sf))


@query(
    "order_net_revenue",
    sql(f"""SELECT order_id, {dbl('total_price_vnd', 'total_refunded_vnd', 'total_refunded_reported_vnd',
        'total_refunded_calc_vnd', 'net_revenue_vnd')} FROM net_orders"""),
)
def _(spark, sf):
    staged = staged_orders(spark, sf, "order_id", "total_price_vnd", "total_refunded_vnd")
    return im.order_net_revenue(without_envelope(staged), staged_refunds(spark, sf))


@query(
    "orders_with_customer",
    sql(f"""SELECT {HEADER_SQL}, email AS customer_email, first_name AS customer_first_name, last_name AS customer_last_name
FROM staged_orders LEFT JOIN (SELECT customer_id AS cid, email, first_name, last_name FROM customers) ON customer_id = cid"""),
)
def _(spark, sf):
    staged = without_envelope(staged_orders(spark, sf, *HEADER_COLUMNS))
    who = st.customers(raw(spark, sf, "customers"), keep=["customer_id", "email", "first_name", "last_name"])
    return im.orders_with_customer(staged, who)


@query(
    "anti_join_historical",
    sql("SELECT product_id, title FROM products_seen WHERE product_id IS NULL OR product_id NOT IN (SELECT product_id FROM products)"),
)
def _(spark, sf):
    current = st.products(raw(spark, sf, "products"), keep=["product_id"])
    return missing_from(im.products_in_orders(lines_for_latest(spark, sf)), current, "product_id")


@query(
    "source_priority_pick",
    sql("""SELECT product_id, title, src FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY src) AS rn
FROM (SELECT 1 AS src, * FROM products_seen UNION ALL SELECT 2, * FROM adjusted_products)) WHERE rn = 1"""),
)
def _(spark, sf):
    sold = im.products_in_orders(lines_for_latest(spark, sf)).withColumn("src", F.lit(1))
    adjusted = adjusted_products(spark, sf).withColumn("src", F.lit(2))
    return first_source(sold.unionByName(adjusted), ["product_id"], "src")
