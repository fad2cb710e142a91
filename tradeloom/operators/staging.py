"""Staging: one typed table per document feed.

Every function takes a raw table (``payload`` plus envelope columns) and returns
typed columns followed by ``ingested_at`` and ``source_run_id``. Arrays of
objects stay arrays of structs, so a table that explodes them needs no second
parse. ``keep`` restricts the columns that are parsed at all.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.documents import (
    Field,
    lenient,
    narrowed,
    objects,
    parse,
    strict,
    texts,
    typed,
)
from tradeloom.operators.pick import latest_by

MONEY = "decimal(18,2)"
WEIGHT = "decimal(18,3)"
ENVELOPE = ("ingested_at", "source_run_id")

# ---------------------------------------------------------------------------
# Field names inside the documents, and the staging columns and
# types they become. ``strict`` casts as is, ``lenient`` reads "" as NULL.

TRANSACTION_ITEM = "id: string, kind: string, status: string, gateway: string, amount: string, created_at: string"

LINE_ITEM = (
    "id: string, product_id: string, variant_id: string, quantity: string, price: string, "
    "price_original: string, total_discount: string, sku: string, title: string, variant_title: string"
)

REFUND_ITEM = (
    "id: string, created_at: string, note: string, reason: string, amount: string, restock: string, "
    f"refund_line_items: string, transactions: array<struct<{TRANSACTION_ITEM}>>"
)

VARIANT_ITEM = (
    "id: string, title: string, sku: string, barcode: string, price: string, compare_at_price: string, "
    "inventory_quantity: string, option1: string, option2: string, option3: string, "
    "inventory_management: string, inventory_policy: string, weight: string, weight_unit: string, "
    "created_at: string, updated_at: string"
)

ORDERS = [
    strict("order_id", "id", "bigint"),
    strict("order_name", "name"),
    strict("order_number", "order_number"),
    lenient("customer_id", ("customer.id", "customer_id"), "bigint"),
    lenient("location_id", "location_id", "bigint"),
    *texts("currency", "financial_status", "fulfillment_status"),
    lenient("subtotal_vnd", "subtotal_price", MONEY),
    lenient("total_discount_vnd", "total_discounts", MONEY),
    lenient("total_tax_vnd", "total_tax", MONEY),
    lenient("total_shipping_vnd", "total_shipping", MONEY),
    lenient("total_price_vnd", "total_price", MONEY),
    lenient("total_refunded_vnd", "total_refunded", MONEY),
    strict("created_at", "created_at", "timestamp"),
    strict("order_updated_at", "updated_at", "timestamp"),
    lenient("closed_at", "closed_at", "timestamp"),
    lenient("cancelled_at", "cancelled_at", "timestamp"),
    objects("line_items_json", "line_items", LINE_ITEM),
    objects("refunds_json", "refunds", REFUND_ITEM),
    objects("transactions_json", "transactions", TRANSACTION_ITEM),
    strict("shipping_address_json", "shipping_address"),
    strict("billing_address_json", "billing_address"),
]

CUSTOMERS = [
    strict("customer_id", "id", "bigint"),
    *texts("email", "phone", "first_name", "last_name", "state"),
    strict("accepts_marketing", "accepts_marketing", "boolean"),
    strict("orders_count", "orders_count", "int"),
    lenient("total_spent_vnd", "total_spent", MONEY),
    *texts("tags"),
    strict("created_at", "created_at", "timestamp"),
    strict("customer_updated_at", "updated_at", "timestamp"),
    strict("addresses_json", "addresses"),
    strict("default_address_json", "default_address"),
]

PRODUCTS = [
    strict("product_id", "id", "bigint"),
    *texts("title", "handle", "vendor", "product_type", "status", "tags"),
    strict("created_at", "created_at", "timestamp"),
    strict("product_updated_at", "updated_at", "timestamp"),
    lenient("published_at", "published_at", "timestamp"),
    objects("variants_json", "variants", VARIANT_ITEM),
    strict("images_json", "images"),
    strict("options_json", "options"),
]

VARIANTS = [
    strict("variant_id", "id", "bigint"),
    *texts("title", "sku", "barcode"),
    lenient("price_vnd", "price", MONEY),
    lenient("compare_at_price_vnd", "compare_at_price", MONEY),
    lenient("inventory_quantity", "inventory_quantity", "int"),
    *texts("option1", "option2", "option3", "inventory_management", "inventory_policy"),
    lenient("weight", "weight", WEIGHT),
    *texts("weight_unit"),
    lenient("created_at", "created_at", "timestamp"),
    lenient("variant_updated_at", "updated_at", "timestamp"),
]

LOCATIONS = [
    strict("location_id", "id", "bigint"),
    *texts("name", "address1", "address2", "city", "province", "country", "country_code", "zip", "phone"),
    strict("active", "active", "boolean"),
    lenient("created_at", "created_at", "timestamp"),
    lenient("location_updated_at", "updated_at", "timestamp"),
]

REFUNDS = [
    strict("refund_id", "id", "bigint"),
    strict("created_at", "created_at", "timestamp"),
    *texts("note", "reason"),
    lenient("refund_amount_vnd", "amount", MONEY),
    strict("restock", "restock", "boolean"),
    strict("refund_line_items_json", "refund_line_items"),
    objects("refund_transactions_json", "transactions", TRANSACTION_ITEM),
]

TRANSACTIONS = [
    strict("transaction_id", "id", "bigint"),
    *texts("kind", "status", "gateway"),
    lenient("amount_vnd", "amount", MONEY),
    strict("created_at", "created_at", "timestamp"),
]

ADJUSTMENTS = [
    strict("parent_adjustment_id", "id", "bigint"),
    strict("location_id", "location_id", "bigint"),
    lenient("created_at", "created_at", "timestamp"),
    lenient("adjustment_updated_at", "updated_at", "timestamp"),
    *texts("reason", "note", "adjust_number"),
    # The line items are listed by ADJUSTMENT_LINES.
]

ADJUSTMENT_LINES = [
    strict("adjustment_id", "id", "bigint"),
    strict("variant_id", "product_variant_id", "bigint"),
    strict("product_id", "product_id", "bigint"),
    lenient("quantity_delta", "quantity", "int"),
    lenient("cost_delta_vnd", "cost_amount", MONEY),
    *texts("sku", "barcode"),
]

INVENTORY_LEVELS = [
    lenient("available_quantity", "available", "int"),
    lenient("current_quantity", "on_hand", "int"),
    lenient("committed_quantity", "committed", "int"),
]

COLLECTIONS = [
    strict("collection_id", "id", "bigint"),
    *texts("title", "handle", "description"),
    lenient("published_at", "published_at", "timestamp"),
    lenient("collection_updated_at", "updated_at", "timestamp"),
]

DISCOUNTS = [
    strict("discount_id", "id", "bigint"),
    *texts("code", "value_type"),
    lenient("value", "value", MONEY),
    *texts("applies_to"),
    lenient("starts_at", "starts_at", "timestamp"),
    lenient("ends_at", "ends_at", "timestamp"),
    lenient("usage_count", "usage_count", "int"),
    *texts("status"),
    lenient("discount_updated_at", "updated_at", "timestamp"),
]

PROMOTIONS = [
    strict("promotion_id", "id", "bigint"),
    *texts("title", "value_type"),
    lenient("value", "value", MONEY),
    lenient("starts_at", "starts_at", "timestamp"),
    lenient("ends_at", "ends_at", "timestamp"),
    *texts("status"),
    lenient("promotion_updated_at", "updated_at", "timestamp"),
]

# Column order of the tables whose columns come from two document levels.
TRANSACTION_COLUMNS = [
    "transaction_id", "order_id", "refund_id", "kind", "status", "gateway", "amount_vnd", "created_at",
]
ADJUSTMENT_COLUMNS = [
    "adjustment_id", "parent_adjustment_id", "variant_id", "product_id", "location_id", "quantity_delta",
    "cost_delta_vnd", "sku", "barcode", "created_at", "adjustment_updated_at", "reason", "note", "adjust_number",
]
# ---------------------------------------------------------------------------


def _project(
    raw: DataFrame, fields: Sequence[Field], keep: Iterable[str] | None = None, before: Sequence[str] = ()
) -> DataFrame:
    chosen = narrowed(fields, keep)
    slim = raw.select(*before, "payload", *ENVELOPE)
    return parse(slim, chosen).select(*before, *typed(chosen, "doc"), *ENVELOPE)


def _items(df: DataFrame, array: str, *columns: str) -> DataFrame:
    """One row per array element that has an id; rows without elements vanish."""
    return elements(df, array, *columns).filter("item.id IS NOT NULL")


def elements(df: DataFrame, array: str | Column, *columns: str) -> DataFrame:
    """Array elements as ``item``, NULL for a row without any; callers filter on a field of it.

    The outer form, because for the inner one the optimizer adds a filter on the
    array's size below the projection, and that filter would parse each document
    once more.
    """
    return df.select(F.explode_outer(array).alias("item"), *columns)


def orders(raw: DataFrame, keep: Iterable[str] | None = None) -> DataFrame:
    """Order headers; ``payload_raw`` is the document itself."""
    wanted = None if keep is None else [c for c in keep if c != "payload_raw"]
    chosen = narrowed(ORDERS, wanted)
    with_raw = keep is None or "payload_raw" in set(keep)
    if not with_raw:
        return _project(raw, ORDERS, wanted)
    slim = raw.select("payload", F.col("payload").alias("payload_raw"), *ENVELOPE)
    return parse(slim, chosen).select(*typed(chosen, "doc"), "payload_raw", *ENVELOPE)


def customers(raw: DataFrame, keep: Iterable[str] | None = None) -> DataFrame:
    return _project(raw, CUSTOMERS, keep)


def products(raw: DataFrame, keep: Iterable[str] | None = None) -> DataFrame:
    return _project(raw, PRODUCTS, keep)


def variants(staged_products: DataFrame) -> DataFrame:
    rows = _items(staged_products, "variants_json", "product_id", *ENVELOPE)
    key, *rest = typed(VARIANTS, "item")
    return rows.select(key, "product_id", *rest, *ENVELOPE)


def locations(raw: DataFrame, keep: Iterable[str] | None = None) -> DataFrame:
    return _project(raw, LOCATIONS, keep)


def order_refunds(staged_orders: DataFrame) -> DataFrame:
    rows = _items(staged_orders, "refunds_json", "order_id", *ENVELOPE)
    key, *rest = typed(REFUNDS, "item")
    return rows.select(key, "order_id", *rest, *ENVELOPE)


def order_transactions(staged_orders: DataFrame) -> DataFrame:
    """Order-level and refund-level transactions, one row per transaction id.

    Both arrays are joined inside the document, so the orders are read and
    exploded once. A transaction listed twice keeps its refund-level row; the
    remaining columns only break ties, to make reruns repeatable.
    """
    tagged = F.concat(
        F.coalesce(
            F.transform(
                "transactions_json",
                lambda t: F.struct(F.lit(None).cast("bigint").alias("refund_id"), t.alias("item")),
            ),
            F.array(),
        ),
        F.coalesce(
            F.flatten(
                F.transform(
                    "refunds_json",
                    lambda r: F.transform(
                        F.coalesce(r.transactions, F.array()),
                        lambda t: F.struct(r.id.cast("bigint").alias("refund_id"), t.alias("item")),
                    ),
                )
            ),
            F.array(),
        ),
    )
    rows = (
        elements(staged_orders, tagged, "order_id", *ENVELOPE)
        .select("order_id", "item.refund_id", "item.item", *ENVELOPE)
        .filter("item.id IS NOT NULL")
        .select("order_id", "refund_id", *typed(TRANSACTIONS, "item"), *ENVELOPE)
    )
    preference = [F.col("refund_id").isNotNull(), -F.col("refund_id"), -F.col("order_id"), F.col("created_at")]
    return latest_by(rows, ["transaction_id"], preference).select(*TRANSACTION_COLUMNS, *ENVELOPE)


def inventory_adjustments(raw: DataFrame, keep: Iterable[str] | None = None) -> DataFrame:
    """One row per adjustment line; the line id is the row id."""
    wanted = ADJUSTMENT_COLUMNS if keep is None else list(keep)
    of_lines = {f.name for f in ADJUSTMENT_LINES}
    lines = narrowed(ADJUSTMENT_LINES, [c for c in wanted if c in of_lines])
    heads = narrowed(ADJUSTMENTS, [c for c in wanted if c not in of_lines])
    # A line is known by its id, whatever else is kept of it.
    held = ", ".join(f"{path}: string" for path in dict.fromkeys(["id", *[f.paths[0] for f in lines]]))
    staged = _project(raw, [*heads, objects("line_items", "line_items", held)])
    rows = _items(staged, "line_items", *[c for c in staged.columns if c != "line_items"])
    return rows.select("*", *typed(lines, "item")).select(*[c for c in ADJUSTMENT_COLUMNS if c in set(wanted)], *ENVELOPE)


def inventory_levels(raw: DataFrame) -> DataFrame:
    return _project(raw, INVENTORY_LEVELS, before=("location_id", "variant_id", "snapshot_date"))


def collections(raw: DataFrame) -> DataFrame:
    """Custom and smart collections have one shape."""
    return _project(raw, COLLECTIONS)


def discounts(raw: DataFrame) -> DataFrame:
    return _project(raw, DISCOUNTS)


def promotions(raw: DataFrame) -> DataFrame:
    return _project(raw, PROMOTIONS)
