"""Facts of the star schema: the select part; merging is in ``merge``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.keys import date_key, surrogate_key
from tradeloom.functions.values import payment_method

# Passthrough columns of the facts, in order.
ORDER_COLUMNS = [
    "created_at", "order_updated_at", "financial_status", "fulfillment_status", "currency", "subtotal_vnd",
    "total_discount_vnd", "total_tax_vnd", "total_shipping_vnd", "total_price_vnd", "total_refunded_reported_vnd",
]
ORDER_LINE_COLUMNS = [
    "order_id", "line_item_id", "variant_id", "product_id", "quantity", "unit_price_vnd",
    "unit_price_original_vnd", "line_discount_vnd", "line_total_vnd", "created_at",
]
TRANSACTION_COLUMNS = [
    "transaction_id", "order_id", "refund_id", "kind", "status", "gateway", "amount_vnd", "created_at",
]
REFUND_COLUMNS = ["refund_id", "order_id", "reason", "note", "refund_amount_vnd", "restock", "created_at"]
ADJUSTMENT_COLUMNS = ["adjustment_id", "variant_id", "location_id", "quantity_delta", "cost_delta_vnd", "reason"]
SNAPSHOT_COLUMNS = ["location_id", "variant_id", "snapshot_date"]


def fct_orders(net_orders: DataFrame) -> DataFrame:
    """One row per order; the computed refund total is the authoritative one."""
    return net_orders.select(
        surrogate_key("order_id").alias("order_key"),
        "order_id",
        surrogate_key("customer_id").alias("customer_key"),
        surrogate_key("location_id").alias("location_key"),
        date_key("created_at").alias("order_date_key"),
        *ORDER_COLUMNS,
        F.col("total_refunded_calc_vnd").alias("total_refunded_vnd"),
        "net_revenue_vnd",
    )


def fct_order_lines(lines: DataFrame) -> DataFrame:
    return lines.select(
        surrogate_key("order_id", "line_item_id").alias("line_key"),
        surrogate_key("order_id").alias("order_key"),
        surrogate_key("variant_id").alias("variant_key"),
        surrogate_key("product_id").alias("product_key"),
        date_key("created_at").alias("order_date_key"),
        *ORDER_LINE_COLUMNS,
    )


def fct_transactions(transactions: DataFrame) -> DataFrame:
    return transactions.select(
        surrogate_key("transaction_id").alias("transaction_key"),
        surrogate_key("order_id").alias("order_key"),
        surrogate_key(payment_method("gateway")).alias("payment_method_key"),
        date_key("created_at").alias("transaction_date_key"),
        *TRANSACTION_COLUMNS,
    )


def fct_refunds(refunds: DataFrame) -> DataFrame:
    return refunds.select(
        surrogate_key("refund_id").alias("refund_key"),
        surrogate_key("order_id").alias("order_key"),
        date_key("created_at").alias("refund_date_key"),
        *REFUND_COLUMNS,
    )


def fct_inventory_adjustments(adjustments: DataFrame) -> DataFrame:
    return adjustments.select(
        surrogate_key("adjustment_id").alias("adjustment_key"),
        surrogate_key("variant_id").alias("variant_key"),
        surrogate_key("location_id").alias("location_key"),
        date_key("created_at").alias("adjustment_date_key"),
        *ADJUSTMENT_COLUMNS,
        F.col("created_at").alias("adjusted_at"),
    )


def fct_inventory_snapshot(levels: DataFrame) -> DataFrame:
    return levels.select(
        surrogate_key("location_id", "variant_id", "snapshot_date").alias("snapshot_key"),
        surrogate_key("variant_id").alias("variant_key"),
        surrogate_key("location_id").alias("location_key"),
        date_key("snapshot_date").alias("snapshot_date_key"),
        *SNAPSHOT_COLUMNS,
        F.col("current_quantity").alias("on_hand_quantity"),
        "available_quantity",
        "committed_quantity",
    )


def revenue_by_product(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Star join read by reports.

    Lines without product all carry the key of the sentinel row. Summing per
    key before the join leaves one row per product on both sides, so neither
    that hot key nor the size of either table matters to the join. The products
    are shuffled, never sent whole to the driver, whatever the optimizer takes them for.
    """
    totals = lines.groupBy("product_key").agg(
        F.sum("line_total_vnd").cast("decimal(38,2)").alias("revenue_vnd"),
        F.sum("quantity").alias("units"),
        F.count("*").alias("line_count"),
    )
    labels = products.select("product_key", "product_id", "title", "is_historical")
    return totals.join(labels.hint("merge"), "product_key", "inner")
