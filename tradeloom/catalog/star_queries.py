"""Queries on dimensions, facts, merges and the whole build."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.catalog.feeds import ITEMS, as_of, landed, raw, table
from tradeloom.catalog.flat import dbl, sql
from tradeloom.catalog.registry import query
from tradeloom.catalog.staging_queries import (
    adjusted_products,
    adjusted_variants,
    lines_for_latest,
    staged_adjustments,
    staged_lines,
    staged_orders,
    staged_refunds,
    staged_transactions,
)
from tradeloom.operators import dimensions as dim
from tradeloom.operators import facts
from tradeloom.operators import intermediate as im
from tradeloom.operators import staging as st
from tradeloom.operators.merge import merge_rows, recent_days, since_target
from tradeloom.plans.star import StarBuild, build, fact_specs
from tradeloom.session import DENSE, scratch, written
from tradeloom.sources.seeds import read_holidays
from tradeloom.sources.tables import KeyedTable
from tradeloom.streaming.landing import land_rows

PRODUCT_SQL = """product_key, product_id, title, handle, vendor, product_type, status, tags, created_at, product_updated_at,
published_at, is_historical"""
VARIANT_SQL = f"""variant_key, product_key, variant_id, product_id, title, sku, barcode, {dbl('price_vnd',
    'compare_at_price_vnd')}, inventory_quantity, option1, option2, option3, inventory_management, inventory_policy,
{dbl('weight')}, weight_unit, created_at, variant_updated_at, is_historical"""
ORDER_FACT_SQL = f"""order_key, order_id, customer_key, location_key, order_date_key, created_at, order_updated_at,
financial_status, fulfillment_status, currency, {dbl('subtotal_vnd', 'total_discount_vnd', 'total_tax_vnd',
    'total_shipping_vnd', 'total_price_vnd', 'total_refunded_reported_vnd', 'total_refunded_vnd', 'net_revenue_vnd')}"""
LINE_FACT_SQL = f"""line_key, order_key, variant_key, product_key, order_date_key, order_id, line_item_id, variant_id,
product_id, quantity, {dbl('unit_price_vnd', 'unit_price_original_vnd', 'line_discount_vnd', 'line_total_vnd')}, created_at"""
TX_FACT_SQL = f"""transaction_key, order_key, payment_method_key, transaction_date_key, transaction_id, order_id, refund_id,
kind, status, gateway, {dbl('amount_vnd')}, created_at"""
REFUND_FACT_SQL = f"""refund_key, order_key, refund_date_key, refund_id, order_id, reason, note, {dbl('refund_amount_vnd')},
restock, created_at"""
ADJUSTMENT_FACT_SQL = f"""adjustment_key, variant_key, location_key, adjustment_date_key, adjustment_id, variant_id, location_id,
quantity_delta, {dbl('cost_delta_vnd')}, reason, adjusted_at"""

NET_COLUMNS = [
    "order_id", "customer_id", "location_id", "created_at", "order_updated_at", "financial_status", "fulfillment_status",
    "currency", "subtotal_vnd", "total_discount_vnd", "total_tax_vnd", "total_shipping_vnd", "total_price_vnd",
    "total_refunded_vnd", "refunds_json",
]


def order_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """First and last order day of the data."""
    day = F.to_date("o_orderdate")
    return table(spark, sf, "orders").agg(F.min(day).alias("start"), F.max(day).alias("as_of"))


def order_facts(spark, sf):
    return facts.fct_orders(im.order_net_revenue_in_document(staged_orders(spark, sf, *NET_COLUMNS)))


def line_facts(spark, sf):
    return facts.fct_order_lines(staged_lines(spark, sf))


def transaction_facts(spark, sf):
    return facts.fct_transactions(staged_transactions(spark, sf))


def refund_facts(spark, sf):
    return facts.fct_refunds(staged_refunds(spark, sf))


def adjustment_facts(spark, sf):
    keep = [*facts.ADJUSTMENT_COLUMNS, "created_at"]
    return facts.fct_inventory_adjustments(staged_adjustments(spark, sf, *keep))


def snapshot_facts(spark, sf):
    return facts.fct_inventory_snapshot(st.inventory_levels(raw(spark, sf, "inventory_locations")))


def product_dim(spark, sf):
    return dim.dim_products(
        st.products(raw(spark, sf, "products"), keep=dim.PRODUCT_COLUMNS),
        im.products_in_orders(lines_for_latest(spark, sf)),
        adjusted_products(spark, sf),
    )


@query(
    "dim_customers",
    sql("""SELECT md5(CAST(customer_id AS VARCHAR)) AS customer_key, customer_id, email, phone, first_name, last_name,
state AS customer_state, accepts_marketing, orders_count, CAST(total_spent_vnd AS DOUBLE) AS total_spent_vnd, tags, created_at,
customer_updated_at FROM customers"""),
)
def _(spark, sf):
    keep = [c if c != "customer_state" else "state" for c in dim.CUSTOMER_COLUMNS]
    return dim.dim_customers(st.customers(raw(spark, sf, "customers"), keep=keep))


@query("dim_locations", sql("SELECT md5(CAST(location_id AS VARCHAR)) AS location_key, * FROM locations"))
def _(spark, sf):
    return dim.dim_locations(st.locations(raw(spark, sf, "locations")))


@query("dim_products", sql(f"SELECT {PRODUCT_SQL} FROM product_dim"))
def _(spark, sf):
    return product_dim(spark, sf)


@query("dim_variants", sql(f"SELECT {VARIANT_SQL} FROM variant_dim"))
def _(spark, sf):
    current = st.variants(st.products(raw(spark, sf, "products"), keep=["product_id", "variants_json"]))
    return dim.dim_variants(
        current,
        im.variants_in_orders(lines_for_latest(spark, sf)),
        adjusted_variants(spark, sf),
    )


@query("dim_date", sql("SELECT * FROM date_dim"))
def _(spark, sf):
    return dim.dim_date(order_bounds(spark, sf), read_holidays(spark))


@query("dim_payment_methods", sql("SELECT * FROM method_dim"))
def _(spark, sf):
    return dim.dim_payment_methods(staged_transactions(spark, sf))


@query("fct_orders", sql(f"SELECT {ORDER_FACT_SQL} FROM order_facts"))
def _(spark, sf):
    return order_facts(spark, sf)


@query("fct_order_lines", sql(f"SELECT {LINE_FACT_SQL} FROM line_facts"))
def _(spark, sf):
    return line_facts(spark, sf)


@query("fct_transactions", sql(f"SELECT {TX_FACT_SQL} FROM transaction_facts"))
def _(spark, sf):
    return transaction_facts(spark, sf)


@query("fct_refunds", sql(f"SELECT {REFUND_FACT_SQL} FROM refund_facts"))
def _(spark, sf):
    return refund_facts(spark, sf)


@query("fct_adjustments", sql(f"SELECT {ADJUSTMENT_FACT_SQL} FROM adjustment_facts"))
def _(spark, sf):
    return adjustment_facts(spark, sf)


@query("fct_inventory_snapshot", sql("SELECT * FROM snapshot_facts"))
def _(spark, sf):
    return snapshot_facts(spark, sf)


@query(
    "star_revenue_by_product",
    sql("""SELECT product_key, CAST(sum(line_total_vnd) AS DOUBLE) AS revenue_vnd, CAST(sum(quantity) AS BIGINT) AS units,
count(*) AS line_count, any_value(p.product_id) AS product_id, any_value(title) AS title, any_value(is_historical) AS is_historical
FROM line_facts JOIN (SELECT product_key AS pk, product_id, title, is_historical FROM product_dim) p ON product_key = pk
GROUP BY product_key"""),
)
def _(spark, sf):
    return facts.revenue_by_product(line_facts(spark, sf), product_dim(spark, sf))


# Merges: the target is what an earlier run stored, with one column that differs
# from today's; the source is the whole current table. As in a build, both are
# read from storage.


def _stale(df: DataFrame, column: str, before: str, **changes) -> DataFrame:
    """The table as it was before a day, with some columns differing from today's."""
    old = df.filter(F.col(column) < F.lit(before).cast("timestamp"))
    return old.withColumns({c: v for c, v in changes.items()})


def _merged(name: str, rows: DataFrame, target: DataFrame) -> DataFrame:
    spec = fact_specs(1)[name]
    batch = since_target(rows, spec.column, target, spec.target_column, spec.lookback_days)
    return merge_rows(target, batch, spec.keys, spec.append_new_columns)


def _merge_sql(columns: str, source: str, key: str, column: str, before: str, stale: str, lookback: int = 0) -> str:
    return sql(f"""
SELECT {columns} FROM (
  SELECT * REPLACE ({stale}) FROM {source}
  WHERE {column} < TIMESTAMP '{before}' AND NOT coalesce({column} >= floor_at, false)
  UNION ALL
  SELECT * FROM {source} WHERE {column} >= floor_at)""".replace(
        "floor_at",
        f"(SELECT max({column}) - INTERVAL {lookback} DAY FROM {source} WHERE {column} < TIMESTAMP '{before}')",
    ))


@query(
    "merge_orders_30d",
    _merge_sql(ORDER_FACT_SQL, "order_facts", "order_id", "order_updated_at", "2000-01-01",
               "'stale' AS financial_status", 30),
)
def _(spark, sf):
    rows = written(order_facts(spark, sf), "orders", DENSE)
    target = _stale(rows, "order_updated_at", "2000-01-01", financial_status=F.lit("stale"))
    return _merged("fct_orders", rows, target)


@query(
    "merge_order_lines",
    _merge_sql(LINE_FACT_SQL, "line_facts", "line_key", "created_at", "2000-01-01", "-1 AS quantity"),
)
def _(spark, sf):
    rows = written(line_facts(spark, sf), "lines", DENSE)
    return _merged("fct_order_lines", rows, _stale(rows, "created_at", "2000-01-01", quantity=F.lit(-1)))


@query(
    "merge_transactions",
    _merge_sql(TX_FACT_SQL, "transaction_facts", "transaction_id", "created_at", "2000-01-01", "'stale' AS status"),
)
def _(spark, sf):
    rows = written(transaction_facts(spark, sf), "transactions", DENSE)
    return _merged("fct_transactions", rows, _stale(rows, "created_at", "2000-01-01", status=F.lit("stale")))


@query(
    "merge_refunds",
    _merge_sql(REFUND_FACT_SQL, "refund_facts", "refund_id", "created_at", "2000-01-01", "'stale' AS reason"),
)
def _(spark, sf):
    rows = written(refund_facts(spark, sf), "refunds", DENSE)
    return _merged("fct_refunds", rows, _stale(rows, "created_at", "2000-01-01", reason=F.lit("stale")))


@query(
    "merge_adjustments",
    _merge_sql(ADJUSTMENT_FACT_SQL, "adjustment_facts", "adjustment_id", "adjusted_at", "2000-01-01", "'stale' AS reason"),
)
def _(spark, sf):
    rows = written(adjustment_facts(spark, sf), "adjustments", DENSE)
    return _merged("fct_inventory_adjustments", rows, _stale(rows, "adjusted_at", "2000-01-01", reason=F.lit("stale")))


@query(
    "merge_snapshot_90d",
    sql("""
SELECT * FROM (
  SELECT * REPLACE (-1 AS on_hand_quantity) FROM snapshot_facts WHERE snapshot_date < DATE '2024-01-16'
  UNION ALL
  SELECT * FROM snapshot_facts WHERE snapshot_date >= DATE '2024-01-16')"""),
)
def _(spark, sf):
    """As of 90 days after mid January: earlier days stay, that day and later ones are merged."""
    rows = written(snapshot_facts(spark, sf), "levels", DENSE)
    target = rows.filter("snapshot_date < DATE'2024-01-25'").withColumn("on_hand_quantity", F.lit(-1))
    batch = recent_days(rows, "snapshot_date", F.lit("2024-04-15").cast("date"), 90)
    return merge_rows(target, batch, fact_specs(1)["fct_inventory_snapshot"].keys)


@query(
    "merge_new_column",
    sql(f"""
SELECT refund_id, order_id, {dbl('refund_amount_vnd')}, created_at, note
FROM (SELECT * REPLACE (CAST(NULL AS VARCHAR) AS note) FROM refund_facts WHERE created_at < (
    SELECT max(created_at) FROM refund_facts WHERE created_at < TIMESTAMP '2000-01-01')
  UNION ALL
  SELECT * FROM refund_facts WHERE created_at >= (
    SELECT max(created_at) FROM refund_facts WHERE created_at < TIMESTAMP '2000-01-01'))"""),
)
def _(spark, sf):
    """The feed gained ``note``; rows stored before have none."""
    rows = written(refund_facts(spark, sf), "refunds", DENSE).select("refund_id", "order_id", "refund_amount_vnd", "created_at", "note")
    target = _stale(rows, "created_at", "2000-01-01").drop("note")
    return _merged("fct_refunds", rows, target)


@query(
    "star_build",
    sql("""
SELECT 'dim_customers' AS table_name, count(*) AS n_rows, CAST(sum(total_spent_vnd) AS DOUBLE) AS amount FROM customers
UNION ALL SELECT 'dim_locations', count(*), NULL FROM locations
UNION ALL SELECT 'dim_products', count(*), NULL FROM product_dim
UNION ALL SELECT 'dim_variants', count(*), CAST(sum(price_vnd) AS DOUBLE) FROM variant_dim
UNION ALL SELECT 'dim_date', count(*), NULL FROM date_dim
UNION ALL SELECT 'dim_payment_methods', count(*), NULL FROM method_dim
UNION ALL SELECT 'fct_orders', count(*), CAST(sum(net_revenue_vnd) AS DOUBLE) FROM order_facts
UNION ALL SELECT 'fct_order_lines', count(*), CAST(sum(line_total_vnd) AS DOUBLE) FROM line_facts
UNION ALL SELECT 'fct_transactions', count(*), CAST(sum(amount_vnd) AS DOUBLE) FROM transaction_facts
UNION ALL SELECT 'fct_refunds', count(*), CAST(sum(refund_amount_vnd) AS DOUBLE) FROM refund_facts
UNION ALL SELECT 'fct_inventory_adjustments', count(*), CAST(sum(cost_delta_vnd) AS DOUBLE) FROM adjustment_facts
UNION ALL SELECT 'fct_inventory_snapshot', count(*), CAST(sum(on_hand_quantity) AS DOUBLE) FROM snapshot_facts"""),
)
def _(spark, sf):
    """Build the star schema into the shared folder; rows and amounts per table."""
    star = built(spark, sf)
    amounts = {
        "dim_customers": "total_spent_vnd", "dim_locations": None, "dim_products": None, "dim_variants": "price_vnd",
        "dim_date": None, "dim_payment_methods": None, "fct_orders": "net_revenue_vnd",
        "fct_order_lines": "line_total_vnd", "fct_transactions": "amount_vnd", "fct_refunds": "refund_amount_vnd",
        "fct_inventory_adjustments": "cost_delta_vnd", "fct_inventory_snapshot": "on_hand_quantity",
    }
    out = None
    for name, column in amounts.items():
        total = F.sum(F.col(column).cast("decimal(38,2)")) if column else F.lit(None)
        one = star.tables[name].agg(F.count("*").alias("n_rows"), total.cast("double").alias("amount"))
        one = one.select(F.lit(name).alias("table_name"), "n_rows", "amount")
        out = one if out is None else out.unionByName(one)
    return out


_built: dict[tuple[str, str], StarBuild] = {}


def built(spark: SparkSession, sf: str) -> StarBuild:
    """A complete build from all feeds of ``sf``; one per session, as a user has one."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _built:
        _built[key] = _build(spark, sf)
    return _built[key]


#: Ranges of what is partitioned by an id of 60 bits, and of the order keys of one document number.
ID_RANGE, ORDER_RANGES = 2**56, 16


def _order_bucket(spark: SparkSession, sf: str) -> int:
    return table(spark, sf, "orders").agg(F.max("o_orderkey")).first()[0] // ORDER_RANGES + 1


def _build(spark: SparkSession, sf: str) -> StarBuild:
    feeds = {name: raw(spark, sf, name) for name in ITEMS}
    return build(
        spark, feeds, scratch(spark, "star"), order_bounds(spark, sf), as_of(), read_holidays(spark),
        id_bucket=ID_RANGE, order_bucket=_order_bucket(spark, sf),
    )


@query(
    "star_rebuild",
    sql("""
SELECT 'product' AS member, product_id AS id, title, is_historical FROM product_dim
UNION ALL SELECT 'variant', variant_id, title, is_historical FROM variant_dim"""),
)
def _(spark, sf):
    """Build from orders of which some sold other products, land these orders as they are, and build again.

    What only the first build saw is gone, what the second one saw is there, and
    only the id ranges of the changed orders were looked at again.
    """
    bucket = _order_bucket(spark, sf)
    store = KeyedTable(spark, scratch(spark, "raw-orders"), ["id"], f"id div {bucket}")
    changed = F.col("id") % 50 == 1
    sold = F.regexp_replace("payload", '"(product_id|variant_id)":("?)([0-9])', '"$1":$277$3')
    with landed(spark, sf, "orders") as orders:
        store.replace(orders.withColumn("payload", F.when(changed, sold).otherwise(F.col("payload"))))
        as_they_are = written(orders.filter(changed), "changed-orders", DENSE)
    out = scratch(spark, "star-again")
    for batch in (None, as_they_are):
        if batch is not None:
            land_rows(store, batch)
        feeds = {name: raw(spark, sf, name) for name in ITEMS if name != "orders"} | {"orders": store.read()}
        star = build(
            spark, feeds, out, order_bounds(spark, sf), as_of(), read_holidays(spark),
            id_bucket=ID_RANGE, order_bucket=bucket, snapshots={"orders": store.snapshot()}, keep_versions=1,
        )
    products, variants = star.tables["dim_products"], star.tables["dim_variants"]
    members = products.select(F.lit("product").alias("member"), F.col("product_id").alias("id"), "title", "is_historical")
    return members.unionByName(variants.select(F.lit("variant").alias("member"), F.col("variant_id").alias("id"), "title", "is_historical"))
