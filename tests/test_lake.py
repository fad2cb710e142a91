"""The landing job, its state and its log."""

import json
from datetime import datetime
from functools import partial

import pytest
from conftest import rows
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tradeloom.plans.lake import Lake
from tradeloom.session import in_parallel
from tradeloom.sources import tables
from tradeloom.sources.domains import domain
from tradeloom.sources.tables import KeyedTable


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"), id_bucket=10)


def save(tmp_path, name, key, *docs):
    folder = tmp_path / name
    folder.mkdir()
    (folder / "1.jsonl").write_text(json.dumps({"page": 1, key: list(docs)}) + "\n")
    return str(folder)


def doc(id, day, **kw):
    return {"id": id, "updated_at": f"2026-05-{day:02d}T00:00:00Z", **kw}


def mark(lake):
    return rows(lake.sync_state().select("domain", F.to_date("last_updated_at").cast("string")), "*")


def test_full_then_incremental(lake, tmp_path):
    assert lake.land("orders", save(tmp_path, "a", "orders", doc(1, 1), doc(12, 28)), mode="full") == 2
    assert mark(lake) == [("orders", "2026-05-28")]
    # The window starts on the 21st: the document of the 20th is not read.
    batch = save(tmp_path, "b", "orders", doc(2, 20), doc(3, 21), doc(12, 27, late=True))
    assert lake.land("orders", batch) == 2
    assert rows(lake.raw("orders").read(), "id") == [(1,), (12,), (3,)]
    assert mark(lake) == [("orders", "2026-05-28")]
    assert {r.status for r in lake.run_log().collect()} == {"success"}
    assert rows(lake.status(), "domain", "rows_ingested") == [("orders", 2)]


def test_dry_run_writes_rows_only_and_full_feeds_have_no_watermark(lake, tmp_path):
    lake.land("orders", save(tmp_path, "a", "orders", doc(1, 1)), dry_run=True)
    lake.land("locations", save(tmp_path, "b", "locations", {"id": 5}))
    assert lake.raw("orders").read().count() == 1 and lake.raw("locations").read().count() == 1
    assert mark(lake) == []


def test_explicit_bounds_are_shop_time(lake, tmp_path):
    batch = save(tmp_path, "a", "orders", doc(1, 1), doc(2, 2), doc(3, 3))
    assert lake.land("orders", batch, since=datetime(2026, 5, 2), until=datetime(2026, 5, 3)) == 1


def test_failure_is_logged_and_stops_the_rest(lake, tmp_path):
    good = save(tmp_path, "a", "customers", doc(1, 1))
    bad = save(tmp_path, "b", "products", {"id": 1})
    with pytest.raises((PySparkException, Py4JJavaError)):
        lake.land_all({"orders": good, "products": bad, "customers": good})
    log = {r.domain: r for r in lake.run_log().collect()}
    assert {d: r.status for d, r in log.items()} == {"customers": "success", "products": "failed"}
    assert 0 < len(log["products"].error_message) <= 1000
    assert mark(lake) == [("customers", "2026-05-01")]
    with pytest.raises(ValueError, match="unknown domain"):
        lake.land_all({"events": good})


def test_stream_lands_new_files_and_moves_the_watermark(lake, tmp_path):
    folder = save(tmp_path, "a", "orders", doc(1, 1), doc(12, 9))
    lake.stream("orders", folder)
    lake.stream("orders", folder)
    (tmp_path / "a" / "2.jsonl").write_text(json.dumps({"page": 2, "orders": [doc(2, 3), doc(12, 8, late=True)]}) + "\n")
    lake.stream("orders", folder)
    assert rows(lake.raw("orders").read(), "id") == [(1,), (12,), (2,)]
    assert mark(lake) == [("orders", "2026-05-09")]
    assert rows(lake.run_log(), "rows_ingested", "status") == [(0, "success"), (2, "success"), (2, "success")]
    ages = dict(rows(lake.freshness(F.current_timestamp()), "source", "status"))
    assert ages.pop("orders") == "pass" and set(ages.values()) == {"error"} and len(ages) == 8


def test_stream_and_land_log_the_same(lake, spark, tmp_path):
    pages = save(tmp_path, "a", "orders", doc(1, 9), doc(1, 3), doc(12, 5))
    other = Lake(spark, str(tmp_path / "other"), id_bucket=10)
    other.stream("orders", pages)
    assert lake.land("orders", pages, mode="full") == 3
    assert rows(lake.run_log(), "rows_ingested") == rows(other.run_log(), "rows_ingested") == [(3,)]
    assert mark(lake) == mark(other)


def test_a_run_that_died_before_its_watermark_is_caught_up(lake, tmp_path, monkeypatch):
    folder = save(tmp_path, "a", "orders", doc(1, 1), doc(12, 9))
    with monkeypatch.context() as m:
        m.setattr(Lake, "_advance", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            lake.stream("orders", folder)
    assert mark(lake) == []
    lake.stream("orders", folder)
    lake.stream("orders", folder)
    assert mark(lake) == [("orders", "2026-05-09")]
    assert rows(lake.run_log(), "rows_ingested", "status") == [(0, "failed"), (0, "success"), (2, "success")]


def test_two_feeds_at_once_both_show(lake, spark, tmp_path):
    pages = {f: save(tmp_path, f, f, doc(1, 1), doc(2, 2)) for f in ("orders", "customers", "products")}
    in_parallel(spark, {f: partial(lake.land, f, p) for f, p in pages.items()}, 3)
    assert rows(lake.status(), "domain", "rows_ingested") == [(f, 2) for f in sorted(pages)]
    assert mark(lake) == [(f, "2026-05-02") for f in sorted(pages)]


def test_what_was_never_landed(lake):
    assert rows(lake.validate({"orders": 7}), "domain", "drift", "ok") == [("orders", 1.0, False)]
    with pytest.raises(ValueError, match="not landed yet"):
        lake.build_star(None, None, None)


def test_old_versions_are_freed(lake, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "MOST_DELTAS", 1)
    for n in range(6):
        lake.land("orders", save(tmp_path, str(n), "orders", doc(1, 10 + n)))
    for folder in ("raw/*/data", "meta/sync_state/data", "meta/run_log/data"):
        assert all(len(list(d.iterdir())) <= lake.keep_versions + tables.MOST_DELTAS + 1 for d in (tmp_path / "lake").glob(folder))


def test_requests_counts_and_archive(lake, tmp_path):
    lake.land("locations", save(tmp_path, "a", "locations", {"id": 101}, {"id": 102}))
    lake.land("products", save(tmp_path, "b", "products", doc(1, 1, variants=[{"id": 3}, {"id": 1}, {"id": 2}])))
    assert rows(lake.inventory_requests(), "location_id", "ids") == [(101, "1,2,3"), (102, "1,2,3")]
    assert rows(lake.validate({"products": 1, "locations": 3}), "domain", "ok") == [("locations", False), ("products", True)]
    lake.archive_runs(F.lit("2999-01-01").cast("timestamp"))
    assert lake.run_log().count() == 0 and lake.run_log_archive().count() == 2


def test_archive_beside_a_landing_loses_no_run(lake, spark, tmp_path):
    page = save(tmp_path, "a", "customers", doc(1, 1))
    for _ in range(2):
        lake.land("customers", page)
    far = F.lit("2999-01-01").cast("timestamp")
    in_parallel(spark, {"land": lambda: lake.land("customers", page), "archive": lambda: lake.archive_runs(far)}, 2)
    log, archive = lake.run_log(), lake.run_log_archive()
    assert log.count() + archive.count() == log.unionByName(archive).select("run_id").distinct().count() == 3


def daily(spark, tmp_path, name, *orders):
    from test_star import iso, order

    def simple(**kw):
        return {"created_at": iso(0), "updated_at": iso(0), **kw}

    items = {
        "orders": [order(*o) if isinstance(o, tuple) else o for o in orders],
        "customers": [simple(id=i, orders_count=1) for i in (3, 6, 7, 9)],
        "products": [simple(id=1, title="One", variants=[{"id": 10, "price": "5"}])],
        "locations": [simple(id=1, active=True)],
        "inventory_adjustments": [simple(id=1, location_id=1, line_items=[{"id": 1, "product_variant_id": 99, "product_id": 9, "quantity": "1"}])],
        "inventory_locations": [{"loc_id": 1, "variant_id": 10, "on_hand": 3, "available": 3}],
    }
    (tmp_path / name).mkdir()
    keys = {f: domain(f).envelope for f in items}
    return {f: save(tmp_path / name, f, keys[f], *docs) for f, docs in items.items()}


OPTIONAL = [f"{layer}_{feed}" for layer in ("raw", "stg") for feed in ("custom_collections", "smart_collections", "discounts", "promotions")]


def test_the_daily_job_lands_builds_tests_and_then_publishes(lake, spark, tmp_path):
    from test_star import order

    bounds = spark.sql("SELECT DATE'2026-01-01' AS start, DATE'2030-03-01' AS as_of")
    holidays = spark.sql("SELECT DATE'2026-01-01' AS date, 'New Year' AS holiday_name, true AS is_public_holiday")
    as_of = F.lit("2026-03-01").cast("timestamp")

    def facts():
        return KeyedTable(spark, f"{lake.root}/star/fct_orders", []).read()

    lake.run_all(daily(spark, tmp_path, "good", (3, 1), (6, 2)), bounds, as_of, holidays, optional=OPTIONAL)
    assert facts().count() == 2
    bad = {**order(9, 3), "total_price": "-5.00"}
    with pytest.raises(ValueError, match="stg_orders.total_price_vnd"):
        lake.run_all(daily(spark, tmp_path, "bad", bad), bounds, as_of, holidays, optional=OPTIONAL)
    assert facts().count() == 2
    assert not list((tmp_path / "lake" / "star").glob("*/claims/version*"))
    with pytest.raises((PySparkException, Py4JJavaError)):
        lake.run_all({"orders": save(tmp_path, "broken", "orders", {"id": 1})}, bounds, as_of, holidays)
    assert facts().count() == 2
    log = [(r.status, bool(r.error_message)) for r in lake.run_log().filter("domain = 'all'").orderBy("started_at").collect()]
    assert log == [("success", False), ("failed", True), ("failed", True)]


def test_a_late_commit_with_an_older_stamp_is_parsed_and_nothing_new_is_not(lake, spark, tmp_path):
    from test_star import order

    bounds = spark.sql("SELECT DATE'2026-01-01' AS start, DATE'2030-03-01' AS as_of")
    holidays = spark.sql("SELECT DATE'2026-01-01' AS date, 'New Year' AS holiday_name, true AS is_public_holiday")

    def build():
        lake.build_star(bounds, F.lit("2026-03-01").cast("timestamp"), holidays)
        table = KeyedTable(spark, f"{lake.root}/star/stg_orders", ["order_id"])
        return table.version(), rows(table.read(), "order_id")

    lake.land_all(daily(spark, tmp_path, "one", (3, 1)))
    assert build() == build() == (1, [(3,)])
    # As a landing that stamped its rows before the first build and committed them after it.
    old = lake.raw("orders").read()
    late = old.withColumns({"id": F.lit(6).cast("bigint"), "payload": F.lit(json.dumps(order(6, 2))), "ingested_at": F.lit("2020-01-01").cast("timestamp")})
    lake.raw("orders").apply(late, lambda known, new: new)
    assert build() == (2, [(3,), (6,)])


def test_a_changed_order_picks_anew_from_its_id_range_only(lake, spark, tmp_path):
    bounds = spark.sql("SELECT DATE'2026-01-01' AS start, DATE'2030-03-01' AS as_of")
    holidays = spark.sql("SELECT DATE'2026-01-01' AS date, 'New Year' AS holiday_name, true AS is_public_holiday")

    def build():
        lake.build_star(bounds, F.lit("2026-03-01").cast("timestamp"), holidays)
        return KeyedTable(spark, f"{lake.root}/star/dim_products", []).read()

    def live(table):
        return {p: folders[-1][0] for p, folders in KeyedTable(spark, f"{lake.root}/star/{table}", ["range"], "range")._content().live.items()}

    def line(product):
        return [{"id": 1, "product_id": product, "title": f"P{product}", "quantity": "1", "price": "1"}]

    from test_star import iso, order

    pages = daily(spark, tmp_path, "first", {**order(3, 1), "line_items": line(50)}, {**order(33, 1), "line_items": line(60)})
    lake.land_all(pages)
    assert rows(build().filter("is_historical and product_id is not null"), "product_id") == [(50,), (60,), (9,)]
    before = live("seen_product_id_stg_orders")
    assert set(before) == {"0", "3"}
    changed = {**order(3, 1), "updated_at": iso(3), "line_items": line(70)}
    lake.land("orders", save(tmp_path, "second", "orders", changed))
    # Product 50 was seen in this order only and is gone; 60 comes from a range that was not read again.
    assert rows(build().filter("is_historical and product_id is not null"), "product_id") == [(60,), (70,), (9,)]
    after = live("seen_product_id_stg_orders")
    assert after["3"] == before["3"] and after["0"] != before["0"]
    assert live("stg_inventory_adjustments") == live("stg_inventory_adjustments") and len(live("stg_inventory_adjustments")) == 1
