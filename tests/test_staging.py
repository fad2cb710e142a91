"""Typing and exploding of documents, and what is derived from them."""

import json
from decimal import Decimal

import pytest
from conftest import raw_table, rows
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tradeloom.operators import dimensions as dim
from tradeloom.operators import intermediate as im
from tradeloom.operators import staging as st

# Some executor errors reach Python unconverted.
ERRORS = (PySparkException, Py4JJavaError)

T = "2026-04-01T10:00:00Z"


def order(id, total, created=T, **extra):
    return json.dumps({"id": id, "total_price": total, "created_at": created, "updated_at": created, **extra})


PLAIN = order(
    1, "480000", customer_id=501,
    line_items=[{"id": 11, "product_id": 2, "variant_id": 3, "quantity": 2, "price": "250000"}],
    transactions=[{"id": 21, "kind": "sale", "amount": "480000", "created_at": T}],
)
REFUNDED = order(
    2, "320000", customer={"id": 502}, total_refunded="", location_id="",
    refunds=[
        {"id": 31, "created_at": T, "amount": "100000", "restock": True,
         "transactions": [{"id": 42, "kind": "refund", "amount": "100000", "created_at": T}]},
        {"id": 32, "created_at": T, "amount": "", "restock": False},
        {"created_at": T, "amount": "7"},
    ],
    transactions=[
        {"id": 41, "kind": "sale", "amount": "320000", "created_at": T},
        {"id": 42, "kind": "refund", "status": "order level", "amount": "100000", "created_at": T},
        {"kind": "no id", "created_at": T},
    ],
)
BARE = order(3, "", customer={"id": ""}, line_items=None, refunds=None)


@pytest.fixture(scope="module")
def orders(spark):
    return st.orders(raw_table(spark, PLAIN, REFUNDED, BARE)).cache()


def test_customer_id_comes_nested_or_flat(orders):
    assert rows(orders, "order_id", "customer_id", "location_id") == [(1, 501, None), (2, 502, None), (3, None, None)]


def test_net_revenue_both_ways(orders):
    want = [(1, Decimal(480000)), (2, Decimal(220000)), (3, None)]
    joined = im.order_net_revenue(orders, st.order_refunds(orders))
    assert rows(joined, "order_id", "net_revenue_vnd") == want
    in_document = im.order_net_revenue_in_document(orders)
    columns = ["order_id", "total_refunded_calc_vnd", "total_refunded_reported_vnd", "net_revenue_vnd"]
    assert rows(in_document, *columns) == rows(joined, *columns)


def test_transactions_prefer_the_refund_level_row(orders):
    got = rows(st.order_transactions(orders), "transaction_id", "order_id", "refund_id", "status")
    assert got == [(21, 1, None, None), (41, 2, None, None), (42, 2, 31, None)]


def test_line_totals(orders):
    line = im.order_lines(orders).first()
    assert (line.line_total_vnd, line.unit_price_original_vnd) == (Decimal(500000), Decimal(250000))


def test_payload_is_kept_and_columns_can_be_narrowed(spark):
    raw = raw_table(spark, PLAIN)
    assert json.loads(st.orders(raw).first().payload_raw)["total_price"] == "480000"
    assert st.orders(raw, keep=["order_id"]).columns == ["order_id", "ingested_at", "source_run_id"]
    with pytest.raises(ValueError, match="no such staging columns"):
        st.orders(raw, keep=["nope"])


@pytest.mark.parametrize(
    "doc", [order("", "1"), order(1, "abc"), order(1, "1", created=""), '{"id": 1', order(1, "1", refunds="text")]
)
def test_bad_values_are_errors(spark, doc):
    with pytest.raises(ERRORS):
        st.orders(raw_table(spark, doc)).collect()


def test_latest_title_and_variant(spark):
    def line(i, title, **kw):
        return [{"id": i, "product_id": "5", "variant_id": 50, "title": title, "price": "1", **kw}]

    staged = st.orders(
        raw_table(
            spark,
            order(1, "1", "2026-01-01T00:00:00Z", line_items=line(1, "Old - S")),
            order(2, "1", "2026-01-02T00:00:00Z", line_items=line(2, "Ao - Do - L", variant_title="L")),
            order(3, "1", "2026-01-01T12:00:00Z", line_items=[{"id": 3, "product_id": "", "title": " - X"}, {"id": 4}]),
        )
    )
    assert rows(im.products_in_orders(staged), "*") == [(5, "Ao - Do"), (None, None)]
    assert rows(im.variants_in_orders(staged), "variant_id", "product_id", "title") == [(50, 5, "L")]


def test_adjustment_lines(spark):
    doc = json.dumps(
        {"id": 9, "location_id": 4, "created_at": "", "line_items": [
            {"id": 1, "product_variant_id": 50, "product_id": 5, "quantity": "-3", "cost_amount": ""}, {"quantity": "1"}]}
    )
    got = st.inventory_adjustments(raw_table(spark, doc))
    assert rows(got, "adjustment_id", "parent_adjustment_id", "quantity_delta", "cost_delta_vnd", "created_at") == [
        (1, 9, -3, None, None)
    ]
    assert rows(im.variants_in_adjustments(got), "variant_id", "product_id", "title") == [(50, 5, None)]


def test_product_dimension_has_history_and_one_sentinel(spark):
    current = st.products(raw_table(spark, json.dumps({"id": 1, "title": "Now", "created_at": T, "updated_at": T})))
    sold = spark.createDataFrame([(1, "Then"), (2, "Gone"), (3, None), (None, "no id")], "product_id bigint, title string")
    adjusted = spark.createDataFrame([(2, None), (4, None)], "product_id bigint, title string")
    got = dim.dim_products(current, sold, adjusted)
    assert rows(got, "product_id", "title", "is_historical") == [
        (1, "Now", False), (2, "Gone", True), (3, "(unknown)", True), (4, "(unknown)", True), (None, "(unknown)", True)
    ]
    assert got.filter("product_id IS NULL").first().product_key == "f14cc5cdce0420f4a5a6b6d9d7b85f39"
    assert got.select("product_key").distinct().count() == 5


def test_date_dimension_end_is_exclusive(spark):
    bounds = spark.sql("SELECT DATE'2026-01-01' AS start, DATE'2026-02-01' AS as_of")
    holidays = spark.sql("SELECT DATE'2026-01-01' AS date, 'New Year' AS holiday_name, true AS is_public_holiday")
    days = dim.dim_date(bounds, holidays)
    ends = days.agg(F.min("date_actual").cast("string"), F.max("date_actual").cast("string")).first()
    assert tuple(ends) == ("2026-01-01", "2030-01-31")
    first, sunday = days.filter("date_key = 20260101").first(), days.filter("date_key = 20260104").first()
    assert (first.is_holiday, first.is_business_day, first.day_of_week) == (True, False, 4)
    assert (sunday.is_weekend, sunday.day_of_week, sunday.week_of_year) == (True, 0, 1)


def test_payment_methods(spark):
    tx = spark.createDataFrame([(" COD ",), ("cod",), ("",), (None,), ("\tcod",)], "gateway string")
    assert rows(dim.dim_payment_methods(tx), "method_name") == [("\tcod",), ("cod",), ("unknown",)]
