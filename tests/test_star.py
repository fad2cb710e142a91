"""The whole build, run twice, on documents in which one key is hot."""

import json
from datetime import timedelta

import pytest
from conftest import RAW, at, rows
from pyspark.sql import functions as F

from tradeloom.plans.star import build

T0 = at("2026-01-01")


def iso(day):
    return (T0 + timedelta(days=day)).isoformat().replace("+00:00", "Z")


def order(i, day, status="paid", updated=None):
    lines = [
        {"id": i * 100 + n, "product_id": 1 if n % 3 else "", "variant_id": 10 if n % 3 else None, "quantity": "2", "price": "5.00"}
        for n in range(6)
    ]
    return {
        "id": i, "customer": {"id": 7 if i % 3 else i}, "location_id": "1", "financial_status": status, "total_price": "60.00",
        "created_at": iso(day), "updated_at": iso(day if updated is None else updated), "line_items": lines,
        "refunds": [{"id": i * 100, "created_at": iso(day), "amount": "10.00", "restock": True, "transactions": [
            {"id": i * 100, "kind": "refund", "gateway": "COD", "amount": "10.00", "created_at": iso(day)}]}],
        "transactions": [{"id": i * 100 + 1, "kind": "sale", "gateway": "", "amount": "60.00", "created_at": iso(day)}],
    }


def raw(spark, docs):
    return spark.createDataFrame([(d["id"], json.dumps(d), T0, T0, "r") for d in docs], RAW)


def feeds(spark, orders):
    def simple(**kw):
        return {"created_at": iso(0), "updated_at": iso(0), **kw}

    levels = spark.createDataFrame(
        [("1:10:2026-01-05", 1, 10, (T0 + timedelta(days=4)).date(), json.dumps({"on_hand": "3", "available": -1}), T0, T0, "r")],
        "id string, location_id bigint, variant_id bigint, snapshot_date date, payload string, updated_at timestamp, "
        "ingested_at timestamp, source_run_id string",
    )
    return {
        "orders": raw(spark, orders),
        "customers": raw(spark, [simple(id=i, orders_count=1, accepts_marketing=True) for i in (7, *range(3, 40, 3))]),
        "products": raw(spark, [simple(id=1, title="One", variants=[{"id": 10, "price": "5"}])]),
        "locations": raw(spark, [simple(id=1, active=True)]),
        "inventory_adjustments": raw(spark, [simple(id=1, location_id=1, line_items=[
            {"id": 1, "product_variant_id": 99, "product_id": 9, "quantity": "1"}])]),
        "inventory_locations": levels,
    }


@pytest.fixture(scope="module")
def out(tmp_path_factory):
    return str(tmp_path_factory.mktemp("star"))


def run(spark, out, orders):
    bounds = spark.sql("SELECT DATE'2026-01-01' AS start, DATE'2026-03-01' AS as_of")
    holidays = spark.sql("SELECT DATE'2026-01-01' AS date, 'New Year' AS holiday_name, true AS is_public_holiday")
    return build(spark, feeds(spark, orders), out, bounds, F.lit("2026-03-01").cast("timestamp"), holidays, id_bucket=10)


def test_first_build_passes_its_own_tests(spark, out):
    star = run(spark, out, [order(i, i) for i in range(1, 21)])
    assert rows(star.check().filter("status = 'fail'"), "table_name", "column_name", "test") == []
    warned = rows(star.check().filter("status = 'warn'"), "table_name", "column_name")
    assert warned == [("stg_inventory_locations", "available_quantity")]
    facts = star.tables
    assert facts["fct_order_lines"].count() == 120
    assert facts["fct_orders"].agg(F.sum("net_revenue_vnd")).first()[0] == 1000
    assert rows(facts["dim_variants"].filter("is_historical"), "variant_id", "product_id") == [(99, 9), (None, None)]


def test_second_build_merges_by_its_windows(spark, out):
    """An order updated within 30 days is refreshed; its old lines are not."""
    docs = [order(i, i, status="refunded", updated=20) for i in range(1, 21)] + [order(21, 25)]
    docs[0]["updated_at"] = iso(-60)
    star = run(spark, out, docs)
    status = dict(rows(star.tables["fct_orders"], "order_id", "financial_status"))
    assert len(status) == 21 and status[1] == "paid" and status[2] == "refunded" and status[21] == "paid"
    assert star.tables["fct_order_lines"].count() == 126
    assert rows(star.check().filter("status = 'fail'"), "table_name", "column_name") == []


def test_only_newly_landed_documents_are_parsed(spark, out):
    """A stored document older than the newest parsed one is not read again."""
    stale = order(5, 5, status="must not be seen", updated=27)
    row = (5, json.dumps(stale), T0, T0 - timedelta(days=1), "r")
    landed = feeds(spark, [order(21, 25, status="paid late")])
    landed["orders"] = landed["orders"].unionByName(spark.createDataFrame([row], RAW))
    bounds = spark.sql("SELECT DATE'2026-01-01' AS start, DATE'2026-03-01' AS as_of")
    holidays = spark.sql("SELECT DATE'2026-01-01' AS date, 'New Year' AS holiday_name, true AS is_public_holiday")
    day = F.lit("2026-03-01").cast("timestamp")
    star = build(spark, landed, out, bounds, day, holidays, id_bucket=10)
    status = dict(rows(star.tables["fct_orders"], "order_id", "financial_status"))
    assert (status[5], status[21], len(status)) == ("refunded", "paid late", 21)
    again = build(spark, landed, out + "-full", bounds, day, holidays, id_bucket=10, full_refresh=True)
    assert again.tables["fct_orders"].count() == 2


def test_rows_missing_upstream_stay(spark, out):
    star = run(spark, out, [order(22, 26)])
    assert star.tables["fct_orders"].count() == 22
    assert star.tables["fct_transactions"].count() == 44


def test_members_taken_from_documents_are_not_sent_to_the_driver(spark):
    from tradeloom.operators import facts, intermediate
    from tradeloom.operators.dimensions import missing_from

    ids = spark.createDataFrame([(1, "a"), (2, "b")], "product_id bigint, title string")
    lines = ids.selectExpr("title AS product_key", "1.5BD AS line_total_vnd", "1 AS quantity")
    members = ids.selectExpr("title AS product_key", "product_id", "title", "false AS is_historical")
    orders = spark.createDataFrame([(1, 1), (2, None)], "order_id bigint, customer_id bigint")
    customers = spark.createDataFrame([(1, "e", "f", "l")], "customer_id bigint, email string, first_name string, last_name string")
    for df in (missing_from(ids, ids.limit(1), "product_id"), facts.revenue_by_product(lines, members), intermediate.orders_with_customer(orders, customers)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
