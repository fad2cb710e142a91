"""Id collection, batches, the request grid and count drift."""

import json

import pytest
from conftest import raw_table, rows

from tradeloom.operators import grid, reconcile


def test_nested_ids_are_distinct_and_need_the_key(spark):
    raw = raw_table(
        spark,
        json.dumps({"id": 1, "variants": [{"id": 3}, {"id": 1}, {"sku": "no id"}]}),
        json.dumps({"id": 2, "variants": [{"id": 3}, {"id": "2"}]}),
        json.dumps({"id": 3}),
    )
    assert rows(grid.nested_ids(raw, "variants", "v"), "v") == [(1,), (2,), (3,)]


def test_batches_of_two(spark):
    ids = spark.createDataFrame([(i,) for i in (5, 3, 1, 2, 4, 3)], "v bigint")
    assert rows(grid.id_batches(ids, "v", 2), "batch", "ids") == [(0, "1,2"), (1, "3,4"), (2, "5")]


def test_batches_over_many_slices(spark):
    ids = spark.range(0, 5000, 1, 7).selectExpr("id * 37 % 100003 AS v")
    want = sorted(r.v for r in ids.collect())
    got = sorted(grid.id_batches(ids, "v").collect(), key=lambda r: r.batch)
    assert [int(x) for r in got for x in r.ids.split(",")] == want
    assert all(len(r.ids.split(",")) == 50 for r in got)


def test_grid_has_every_pair_once(spark):
    places = spark.createDataFrame([(101,), (102,)], "location_id bigint")
    variants = spark.range(1, 4).withColumnRenamed("id", "variant_id")
    pairs = grid.location_grid(places, variants)
    assert rows(pairs, "location_id", "variant_id") == [(p, v) for p in (101, 102) for v in (1, 2, 3)]
    assert grid.location_grid(places.limit(0), variants).count() == 0
    assert grid.location_grid(places, variants.limit(0)).count() == 0


def test_drift(spark):
    schema = "domain string, {} bigint"
    source = spark.createDataFrame([("a", 1000), ("b", 1000), ("c", 0), ("d", 5)], schema.format("source_count"))
    landed = spark.createDataFrame([("a", 999), ("b", 900), ("c", 0)], schema.format("landed_count"))
    got = {r.domain: (round(r.drift, 6), r.ok) for r in reconcile.count_drift(source, landed).collect()}
    assert got == {"a": (0.001, True), "b": (0.1, False), "c": (0.0, True), "d": (1.0, False)}
    with pytest.raises(ValueError, match="unknown domain"):
        reconcile.table_counts({"nope": source}, "n")


def test_no_side_of_the_grid_is_sent_to_the_driver(spark):
    places = spark.createDataFrame([(101,), (102,)], "location_id bigint")
    variants = spark.range(1, 4).withColumnRenamed("id", "variant_id")
    plan = grid.location_grid(places, variants)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
