"""Windows, watermarks, high ids and the run log."""

from datetime import UTC, datetime, timedelta, timezone

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from tradeloom.operators import runlog, state

def now():
    return F.lit("2026-06-01 00:00:00").cast("timestamp")



def days(spark, *texts):
    return spark.createDataFrame([(at(t),) for t in texts], "updated_at timestamp")


def shown(df):
    return [str(t) for (t,) in rows(df.select(F.to_date("updated_at").cast("string")), "*")]


def mark(text):
    return F.lit(text).cast("timestamp")


def test_window_floor_is_seven_days_below_the_watermark(spark):
    df = days(spark, "2026-05-20", "2026-05-21", "2026-05-28")
    assert shown(state.read_window(df, watermark=mark("2026-05-28"))) == ["2026-05-21", "2026-05-28"]


def test_explicit_since_has_no_buffer_and_full_has_no_floor(spark):
    df = days(spark, "2026-05-20", "2026-05-27", "2026-05-28")
    assert shown(state.read_window(df, mark("2026-05-28"), since=mark("2026-05-27"))) == ["2026-05-27", "2026-05-28"]
    assert len(shown(state.read_window(df, mark("2026-05-28"), mode="full"))) == 3
    assert len(shown(state.read_window(df, mark("2026-05-28"), incremental=False))) == 3
    assert shown(state.read_window(df, mode="full", until=mark("2026-05-20"))) == ["2026-05-20"]
    with pytest.raises(ValueError, match="unknown mode"):
        state.read_window(df, mode="both")


def test_naive_bounds_are_shop_time(spark):
    one = spark.range(1)
    naive = one.select(state.as_shop_instant(datetime(2026, 1, 1)).cast("string")).first()[0]
    aware = one.select(state.as_shop_instant(datetime(2026, 1, 1, tzinfo=timezone(timedelta(hours=1)))).cast("string")).first()[0]
    assert (naive, aware) == ("2025-12-31 17:00:00", "2025-12-31 23:00:00")
    assert state.as_shop_instant(None) is None
    assert one.select(state.shop_time(mark("2026-01-01 07:00:00")).cast("string")).first()[0] == "2026-01-01 00:00:00"


def test_watermark_never_goes_back(spark):
    t = at("2026-05-28")
    before = spark.createDataFrame([("orders", t, "r0", t, None), ("idle", t, "r0", t, None)], state.STATE_SCHEMA)
    loads = spark.createDataFrame(
        [("orders", t - timedelta(days=10), "r1"), ("fresh", t, "r1"), ("idle", None, "r1")],
        "domain string, max_updated_at timestamp, run_id string",
    )
    after = state.advance_watermarks(before, loads, now())
    got = rows(after.select("domain", F.to_date("last_updated_at").cast("string"), "last_run_id"), "*")
    assert got == [("fresh", "2026-05-28", "r1"), ("idle", "2026-05-28", "r0"), ("orders", "2026-05-28", "r1")]


def test_high_id_never_goes_back(spark):
    t = at("2026-05-28")
    before = spark.createDataFrame([("events", t, "r0", t, 200), ("none", t, "r0", t, None)], state.STATE_SCHEMA)
    loads = spark.createDataFrame([("events", 100, "r1"), ("none", 7, "r1"), ("new", 5, "r1")], "domain string, max_id bigint, run_id string")
    after = state.advance_high_ids(before, loads, now())
    assert rows(after, "domain", "last_high_id") == [("events", 200), ("new", 5), ("none", 7)]
    feed = spark.createDataFrame([("events", 200), ("events", 201), ("none", 1), ("other", 3)], "domain string, id bigint")
    assert rows(state.above_high_id(feed, before), "*") == [("events", 201), ("none", 1), ("other", 3)]


def test_run_log_lifecycle(spark):
    starts = spark.createDataFrame(
        [("a", "orders", "full", "cron"), ("b", "orders", "full", "cron"), ("c", "x", "full", "cron")],
        "run_id string, domain string, mode string, triggered_by string",
    )
    log = runlog.start_runs(starts, now())
    assert {r.status for r in log.collect()} == {"running"}
    ends = spark.createDataFrame(
        [("a", 5, "success", ""), ("b", 0, "failed", "x" * 5000), ("zz", 1, "success", None)],
        "run_id string, rows bigint, outcome string, error string",
    )
    closed = {r.run_id: r for r in runlog.close_runs(log, ends, now()).collect()}
    assert set(closed) == {"a", "b", "c"}
    assert closed["a"].status == "success" and closed["a"].error_message is None and closed["a"].rows_ingested == 5
    assert len(closed["b"].error_message) == 1000
    assert closed["c"].status == "running" and closed["c"].ended_at is None


def test_latest_runs_status_and_archive(spark):
    t0 = datetime(2026, 1, 1, tzinfo=UTC)
    log = spark.createDataFrame(
        [(f"r{i}", "orders" if i % 2 else "customers", "full", t0 + timedelta(days=i), None, i, "success", None, "cron") for i in range(14)]
        + [("never", "odd", "full", None, None, 0, "running", None, "cron")],
        runlog.RUN_LOG_SCHEMA,
    )
    started = log.filter("started_at IS NOT NULL")
    assert [r.run_id for r in runlog.latest_runs(started, 3).collect()] == ["r13", "r12", "r11"]
    st = spark.createDataFrame([("orders", t0, "x", t0, None), ("idle", t0, "x", t0, None)], state.STATE_SCHEMA)
    assert [(r.domain, r.rows_ingested) for r in runlog.status(st, log).collect()] == [("idle", None), ("orders", 13)]
    hot, archive = runlog.archive_split(log, log.limit(0), F.lit("2026-04-05").cast("timestamp"))
    assert archive.count() == 4 and hot.count() == 11
    assert runlog.history(hot, archive).count() == log.count()
