"""The document feeds this package can land."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Domain:
    name: str
    envelope: str
    raw_table: str
    incremental: bool = True
    static_filter: tuple[tuple[str, str], ...] = ()


# Feed name, envelope key of its pages, and whether the feed can be
# read from a watermark. Listed in landing order, dimension feeds first.
_FEEDS = [
    Domain("locations", "locations", "raw.locations", incremental=False),
    Domain("customers", "customers", "raw.customers"),
    Domain("products", "products", "raw.products"),
    Domain("custom_collections", "custom_collections", "raw.custom_collections"),
    Domain("smart_collections", "smart_collections", "raw.smart_collections"),
    Domain("discounts", "discounts", "raw.discounts"),
    Domain("promotions", "promotions", "raw.promotions"),
    Domain("orders", "orders", "raw.orders", static_filter=(("status", "any"),)),
    Domain("inventory_adjustments", "adjustments", "raw.inventory_adjustments"),
    Domain("inventory_locations", "inventory_locations", "raw.inventory_locations", incremental=False),
]

DOMAINS: dict[str, Domain] = {d.name: d for d in _FEEDS}


def domain(name: str) -> Domain:
    if name not in DOMAINS:
        raise ValueError(f"unknown domain: {name!r}")
    return DOMAINS[name]


def split_table(qualified: str) -> tuple[str, str]:
    """``raw.orders`` to its two parts; anything else is an error."""
    schema, dot, table = qualified.partition(".")
    if not (schema and dot and table) or "." in table:
        raise ValueError(f"table name must be schema.table: {qualified!r}")
    return schema, table
