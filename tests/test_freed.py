"""Shuffle files go with the query that made them."""

from __future__ import annotations

import time
from functools import partial
from pathlib import Path

from pyspark.sql import functions as F

from tradeloom.catalog import feeds
from tradeloom.plans.star import StarBuild
from tradeloom.session import folder_exists, in_parallel, shuffles_freed, written
from tradeloom.sources.tables import KeyedTable

NAME = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark) -> set[str]:
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    return {p.name for d in env.blockManager().diskBlockManager().localDirsString() for p in Path(d).rglob("shuffle_*")}


def left_after(spark, before: set[str]) -> set[str]:
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return left


def test_a_stored_table_leaves_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    rows = spark.range(1000).withColumn("v", F.md5(F.col("id").cast("string")))
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"], "id div 100")
    table.replace(rows.groupBy("id").agg(F.max("v").alias("v")))
    table.apply(rows.filter("id < 10"), lambda old, new: new)
    again = written(rows.repartition(4, "v"), "freed")
    assert left_after(spark, before) == set()
    assert table.read().count() == again.count() == 1000


def test_side_by_side_blocks_put_the_setting_back(spark):
    before = spark.conf.get(NAME)

    def block(i: int) -> str:
        with shuffles_freed(spark):
            time.sleep(0.05 * i)
            return spark.conf.get(NAME)

    assert set(in_parallel(spark, {str(i): partial(block, i) for i in range(4)}, 4).values()) == {"true"}
    assert spark.conf.get(NAME) == before


def test_data_tests_leave_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    days = spark.sql("SELECT DATE'2024-01-01' AS date, 'x' AS holiday_name, true AS is_public_holiday")
    found = StarBuild(spark, {}, str(tmp_path), None, None, days.unionByName(days)).check()
    assert left_after(spark, before) == set()
    got = {(r.column_name, r.test): r.failures for r in found.collect() if r.status != "skipped"}
    assert got == {("date", "unique"): 1, ("date", "not_null"): 0, ("holiday_name", "not_null"): 0, ("is_public_holiday", "not_null"): 0}


def test_a_build_that_keeps_one_version_frees_the_others_at_once(spark, tmp_path):
    star = StarBuild(spark, {}, str(tmp_path), None, None, None, keep_versions=1)
    star._kept("dim", spark.range(3))
    assert star._kept("dim", spark.range(5)).count() == 5
    assert len(list((tmp_path / "dim" / "data").iterdir())) == 1


def test_a_feed_landed_for_a_block_goes_with_it(spark, monkeypatch):
    item = spark.createDataFrame([('{"id": 1, "updated_at": "2026-01-01T00:00:00Z"}',)], "item string")
    monkeypatch.setitem(feeds.ITEMS, "orders", lambda spark, sf: item)
    monkeypatch.setattr(feeds, "_landed", {})
    with feeds.landed(spark, "/nowhere", "orders") as orders:
        assert [r.id for r in orders.collect()] == [1]
        [path] = feeds._landed.values()
    assert not feeds._landed and not folder_exists(spark, path)
    kept = feeds.raw(spark, "/nowhere", "orders")
    with feeds.landed(spark, "/nowhere", "orders"):
        pass
    assert kept.count() == 1 and len(feeds._landed) == 1
