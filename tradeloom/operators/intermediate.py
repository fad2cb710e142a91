"""Transforms between staging and the star schema."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.values import blank_to_null, product_title
from tradeloom.operators.pick import latest_by, nulls_lose, nulls_win
from tradeloom.operators.staging import MONEY, elements

NET = "decimal(38,2)"


def _number(path: str, type: str) -> Column:
    return blank_to_null(F.col(path)).cast(type)


def _lines(staged_orders: DataFrame, *columns: str) -> DataFrame:
    return elements(staged_orders, "line_items_json", *columns)


def order_lines(staged_orders: DataFrame) -> DataFrame:
    """One row per line item; the original price falls back to the paid price."""
    head = ("order_id", "customer_id", "location_id", "created_at", "currency")
    price = _number("item.price", MONEY)
    quantity = _number("item.quantity", "int")
    zero = F.lit(0)
    return (
        _lines(staged_orders, *head)
        .filter("item.id IS NOT NULL")
        .select(
            *head,
            F.col("item.id").cast("bigint").alias("line_item_id"),
            _number("item.variant_id", "bigint").alias("variant_id"),
            _number("item.product_id", "bigint").alias("product_id"),
            quantity.alias("quantity"),
            price.alias("unit_price_vnd"),
            F.coalesce(_number("item.price_original", MONEY), price).alias("unit_price_original_vnd"),
            _number("item.total_discount", MONEY).alias("line_discount_vnd"),
            (F.coalesce(price, zero.cast(MONEY)) * F.coalesce(quantity, zero)).alias("line_total_vnd"),
        )
    )


@dataclass(frozen=True)
class Mentions:
    """Where products or variants are seen, and which mention of one counts.

    ``newest`` of the newest of parts is the newest of all, so parts can be
    picked from apart, kept, and picked from again when one has changed.
    """

    key: str
    seen: Callable[[DataFrame], DataFrame]
    order: Callable[[], list[Column]]
    result: Callable[[DataFrame], DataFrame]

    def newest(self, seen: DataFrame, within: Sequence[str] = ()) -> DataFrame:
        return latest_by(seen, [*within, self.key], self.order())


def _products_ordered(staged_orders: DataFrame) -> DataFrame:
    return (
        _lines(staged_orders, "order_id", "created_at")
        .filter("item.product_id IS NOT NULL")
        .select(
            _number("item.product_id", "bigint").alias("product_id"),
            F.col("item.title").alias("title"),
            "created_at",
            "order_id",
            F.col("item.id").cast("bigint").alias("line_id"),
        )
    )


def _variants_ordered(staged_orders: DataFrame) -> DataFrame:
    return (
        _lines(staged_orders, "order_id", "created_at")
        .filter("item.variant_id IS NOT NULL")
        .select(
            _number("item.variant_id", "bigint").alias("variant_id"),
            _number("item.product_id", "bigint").alias("product_id"),
            F.col("item.sku").alias("sku"),
            F.coalesce("item.variant_title", "item.title").alias("title"),
            _number("item.price", MONEY).alias("price_vnd"),
            "created_at",
            "order_id",
            F.col("item.id").cast("bigint").alias("line_id"),
        )
    )


def _adjusted(adjustments: DataFrame, key: str, *columns: str) -> DataFrame:
    """Mentions in stock corrections, with the id range of those that are kept by range."""
    ranged = [c for c in adjustments.columns if c == "range"]
    return adjustments.filter(F.col(key).isNotNull()).select(key, *columns, *ranged)


#: Newest title per product seen in order lines, also of delisted products.
ORDERED_PRODUCTS = Mentions(
    "product_id", _products_ordered,
    lambda: [*nulls_win("created_at"), F.col("order_id"), F.col("line_id"), F.col("title")],
    lambda picked: picked.select("product_id", product_title(F.col("title")).alias("title")),
)
#: Newest product, sku, title and price per variant seen in order lines.
ORDERED_VARIANTS = Mentions(
    "variant_id", _variants_ordered,
    lambda: [*nulls_win("created_at"), F.col("order_id"), F.col("line_id"), F.col("sku")],
    lambda picked: picked.select("variant_id", "product_id", "sku", "title", "price_vnd"),
)
#: Products seen in stock corrections; these carry no title, so the ids are all there is to pick.
ADJUSTED_PRODUCTS = Mentions(
    "product_id", lambda adjustments: _adjusted(adjustments, "product_id"), list,
    lambda picked: picked.select("product_id", F.lit(None).cast("string").alias("title")),
)
ADJUSTED_VARIANTS = Mentions(
    "variant_id", lambda adjustments: _adjusted(adjustments, "variant_id", "product_id", "sku", "created_at", "adjustment_id"),
    lambda: [*nulls_lose("created_at"), F.col("adjustment_id")],
    lambda picked: picked.select(
        "variant_id", "product_id", "sku", F.lit(None).cast("string").alias("title"), F.lit(None).cast(MONEY).alias("price_vnd")
    ),
)


def _all(mentions: Mentions, rows: DataFrame) -> DataFrame:
    return mentions.result(mentions.newest(mentions.seen(rows)))


def products_in_orders(staged_orders: DataFrame) -> DataFrame:
    return _all(ORDERED_PRODUCTS, staged_orders)


def variants_in_orders(staged_orders: DataFrame) -> DataFrame:
    return _all(ORDERED_VARIANTS, staged_orders)


def products_in_adjustments(adjustments: DataFrame) -> DataFrame:
    return _all(ADJUSTED_PRODUCTS, adjustments)


def variants_in_adjustments(adjustments: DataFrame) -> DataFrame:
    return _all(ADJUSTED_VARIANTS, adjustments)


def refunds_by_order(refunds: DataFrame) -> DataFrame:
    return refunds.groupBy("order_id").agg(F.sum("refund_amount_vnd").cast(NET).alias("refunded"))


def order_net_revenue(staged_orders: DataFrame, refunds: DataFrame) -> DataFrame:
    """Orders with reported and computed refund totals and net revenue."""
    joined = staged_orders.join(refunds_by_order(refunds), "order_id", "left")
    return _with_net(joined, F.col("refunded")).drop("refunded")


def order_net_revenue_in_document(staged_orders: DataFrame) -> DataFrame:
    """The same from each order's own refunds array, without any shuffle.

    Valid when the raw table holds one document per order id, which the keyed
    landing guarantees: then an order's refunds all sit in its own document.
    """
    amounts = F.transform(
        F.filter("refunds_json", lambda r: r.id.isNotNull()),
        lambda r: F.coalesce(blank_to_null(r.amount).cast(MONEY), F.lit(0).cast(MONEY)),
    )
    total = F.aggregate(amounts, F.lit(0).cast(NET), lambda acc, x: (acc + x).cast(NET))
    return _with_net(staged_orders, total)


def _with_net(orders: DataFrame, refunded: Column) -> DataFrame:
    # In two steps: the sum over the array is evaluated once, and keeps only its
    # own projection out of generated code.
    known = orders.select(
        *orders.columns,
        F.col("total_refunded_vnd").alias("total_refunded_reported_vnd"),
        F.coalesce(refunded, F.lit(0)).cast(NET).alias("total_refunded_calc_vnd"),
    )
    net = F.col("total_price_vnd") - F.col("total_refunded_calc_vnd")
    return known.select("*", net.cast(NET).alias("net_revenue_vnd"))


def orders_with_customer(staged_orders: DataFrame, staged_customers: DataFrame) -> DataFrame:
    """Orders with their customer's mail and names; guests keep NULLs.

    Guest orders share the NULL customer id. They match nothing, so they skip
    the join instead of meeting in one task. The customers are shuffled too: the
    size of the documents they are parsed from does not tell whether they are few.
    """
    who = staged_customers.select(
        "customer_id",
        F.col("email").alias("customer_email"),
        F.col("first_name").alias("customer_first_name"),
        F.col("last_name").alias("customer_last_name"),
    )
    # A NULL id gets a spread, never matching join value (real ids match as text of digits).
    spread = F.concat(F.lit("guest "), F.col("order_id").cast("string"))
    left = staged_orders.withColumn("_who", F.coalesce(F.col("customer_id").cast("string"), spread))
    right = who.withColumn("_who", F.col("customer_id").cast("string")).drop("customer_id")
    return left.join(right.hint("merge"), "_who", "left").drop("_who")
