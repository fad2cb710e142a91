"""The keyed merge and the table it is stored in."""

from functools import partial

import pytest
from conftest import at, rows
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tradeloom.operators.merge import merge_into, merge_rows, recent_days, since_target
from tradeloom.session import in_parallel
from tradeloom.sources import tables
from tradeloom.sources.tables import ConcurrentWrite, KeyedTable

S = "id bigint, v string"


def t(spark, *items, schema=S):
    return spark.createDataFrame(list(items), schema)


def test_update_insert_and_keep(spark):
    got = merge_rows(t(spark, (1, "a"), (2, "b")), t(spark, (2, "B"), (3, "C")), ["id"])
    assert rows(got, "*") == [(1, "a"), (2, "B"), (3, "C")]


def test_null_keys_never_match(spark):
    got = merge_rows(t(spark, (None, "a")), t(spark, (None, "b"), (None, "b"), (1, "c")), ["id"])
    assert rows(got, "*") == [(1, "c"), (None, "a"), (None, "b"), (None, "b")]


def test_repeated_key_in_the_batch_is_an_error(spark):
    with pytest.raises(PySparkException, match="repeats"):
        merge_rows(t(spark, (1, "a")), t(spark, (2, "x"), (2, "x")), ["id"]).collect()


def test_new_columns_are_appended_or_dropped(spark):
    old, new = t(spark, (1, "a")), t(spark, (2, "b", 7), schema=S + ", n int")
    assert rows(merge_rows(old, new, ["id"], append_new_columns=True), "id", "v", "n") == [(1, "a", None), (2, "b", 7)]
    assert merge_rows(old, new, ["id"]).columns == ["id", "v"]


def test_predicates(spark):
    schema = "id bigint, at timestamp"
    target = t(spark, (1, at("2026-03-31")), schema=schema)
    source = t(spark, (1, at("2026-02-28")), (2, at("2026-03-01")), (3, None), (4, at("2026-04-09")), schema=schema)
    assert rows(since_target(source, "at", target, "at", 30), "id") == [(2,), (4,)]
    assert rows(since_target(source, "at", target.limit(0), "at"), "id") == [(1,), (2,), (4,)]
    days = source.select("id", F.to_date("at").alias("d"))
    assert rows(recent_days(days, "d", F.lit("2026-05-30").cast("date"), 90), "id") == [(2,), (4,)]


def test_table_rewrites_only_touched_partitions(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"], "id div 10")
    merge_into(table, t(spark, *[(i, "old") for i in range(30)]))
    merge_into(table, t(spark, (12, "new"), (31, "new")))
    written = {p.parent.name.partition("-")[0] + "/" + p.name for p in (tmp_path / "t" / "data").glob("*/_part=*")}
    assert written == {"version=1/_part=0", "version=1/_part=1", "version=1/_part=2", "version=2/_part=1", "version=2/_part=3"}
    got = dict(rows(table.read(), "*"))
    assert len(got) == 31 and got[12] == got[31] == "new" and got[13] == "old"


def test_unfinished_version_is_invisible_and_overwritten(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"], "id div 10")
    assert table.read() is None
    table.replace(t(spark, (1, "a"), (11, "b")))
    # What a job leaves that died after writing rows, before its manifest.
    t(spark, (99, "lost")).withColumn("_part", F.lit("9")).write.partitionBy("_part").parquet(str(tmp_path / "t/data/version=2-lost"))
    assert rows(table.read(), "*") == [(1, "a"), (11, "b")]
    merge_into(table, t(spark, (1, "A")))
    assert rows(table.read(), "*") == [(1, "A"), (11, "b")]


def test_stored_table_gains_columns_and_can_be_emptied(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"], "id div 10")
    merge_into(table, t(spark, (1, "a"), (11, "b")))
    merge_into(table, t(spark, (11, "B", 5), schema=S + ", n int"), append_new_columns=True)
    assert rows(table.read(), "id", "v", "n") == [(1, "a", None), (11, "B", 5)]
    table.replace(table.read().limit(0))
    assert table.read().count() == 0 and table.read().columns == ["id", "v", "n"]


def test_superseded_versions_can_be_dropped(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"], "id div 10")
    merge_into(table, t(spark, (1, "a"), (11, "b")))
    merge_into(table, t(spark, (1, "A")))
    table.drop_superseded()
    left = {p.parent.name.partition("-")[0] + "/" + p.name for p in (tmp_path / "t" / "data").glob("*/_part=*")}
    assert left == {"version=1/_part=1", "version=2/_part=0"}
    merge_into(table, t(spark, (2, "c")))
    assert rows(table.read(), "*") == [(1, "A"), (11, "b"), (2, "c")]


def test_failed_merge_changes_nothing(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"])
    merge_into(table, t(spark, (1, "a")))
    with pytest.raises(PySparkException):
        merge_into(table, t(spark, (1, "x"), (1, "y")))
    assert rows(table.read(), "*") == [(1, "a")]


def test_two_writers_lose_nothing(spark, tmp_path):
    def add(n):
        table = KeyedTable(spark, str(tmp_path / "t"), ["id"])
        table.apply(t(spark, (n, "x")), lambda old, new: old.unionByName(new))

    in_parallel(spark, {str(n): partial(add, n) for n in range(4)}, 4)
    assert rows(KeyedTable(spark, str(tmp_path / "t"), ["id"]).read(), "id") == [(n,) for n in range(4)]


def test_claims_of_dead_writers_go_stale(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"])
    table.replace(t(spark, (1, "a")))
    assert table.folder.put("claims/version=2", "dead")
    monkeypatch.setattr(tables, "WAIT_SECONDS", 0)
    with pytest.raises(ConcurrentWrite):
        table.replace(t(spark, (2, "b")))
    monkeypatch.setattr(tables, "WAIT_SECONDS", 10)
    monkeypatch.setattr(tables, "STALE_SECONDS", -10)
    table.replace(t(spark, (2, "b")))
    assert rows(table.read(), "id") == [(2,)]


def test_some_versions_can_be_kept(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"])
    for n in range(5):
        table.replace(t(spark, (n, "a")))
    table.drop_superseded(keep=2)
    assert sorted(p.name.partition("-")[0] for p in (tmp_path / "t/data").iterdir()) == ["version=4", "version=5"]
    assert rows(table.read(), "id") == [(4,)]


def test_only_wanted_partitions_are_opened(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"], "id div 10")
    table.replace(t(spark, (1, "a"), (11, "b"), (21, "c")))
    some = table.read(lambda part: part >= "1")
    assert len({f.rsplit("/", 2)[1] for f in some.inputFiles()}) == 2 and rows(some, "id") == [(11,), (21,)]


def test_held_versions_are_seen_when_published(spark, tmp_path, monkeypatch):
    seen, held = KeyedTable(spark, str(tmp_path / "t"), ["id"]), KeyedTable(spark, str(tmp_path / "t"), ["id"], held=True)
    seen.replace(t(spark, (1, "a")))
    held.replace(t(spark, (2, "b")))
    assert rows(seen.read(), "id") == [(1,)] and rows(held.read_held(), "id") == [(2,)]
    monkeypatch.setattr(tables, "WAIT_SECONDS", 0)
    with pytest.raises(ConcurrentWrite):
        seen.replace(t(spark, (3, "c")))
    held.publish()
    assert rows(seen.read(), "id") == [(2,)]
    held.replace(t(spark, (4, "d")))
    held.discard()
    seen.replace(t(spark, (5, "e")))
    assert rows(seen.read(), "id") == [(5,)]


def test_a_repeated_key_is_an_error_without_a_target_too(spark):
    # Errors of a subquery may reach Python unconverted.
    with pytest.raises((PySparkException, Py4JJavaError), match="repeats"):
        merge_rows(t(spark, (1, "a")).filter("id > 5"), t(spark, (2, "x"), (2, "x")), ["id"]).collect()


def test_only_keys_of_the_batch_are_grouped(spark, tmp_path):
    for name, items in (("old", [(1, "a"), (2, "b")]), ("new", [(2, "B"), (None, "c")])):
        t(spark, *items).write.parquet(str(tmp_path / name))
    got = merge_rows(spark.read.parquet(str(tmp_path / "old")), spark.read.parquet(str(tmp_path / "new")), ["id"])
    assert rows(got, "*") == [(1, "a"), (2, "B"), (None, "c")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "first(" not in plan


def test_a_merge_shuffles_keys_only(spark):
    target, batch = t(spark, (1, "a"), (2, "b"), (None, "c")), t(spark, (2, "B"), (3, "C"), (None, "d"))
    got = merge_rows(target, batch, ["id"])
    assert sorted(map(str, rows(got, "*"))) == sorted(map(str, [(1, "a"), (2, "B"), (3, "C"), (None, "c"), (None, "d")]))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(id" not in plan


def test_many_matched_keys_are_not_sent_whole(spark, monkeypatch):
    monkeypatch.setattr("tradeloom.operators.merge.MOST_SENT", 1)
    target, batch = t(spark, *[(i, "a") for i in range(5)]), t(spark, *[(i, "B") for i in range(3, 7)])
    assert rows(merge_rows(target, batch, ["id"]), "*") == [(0, "a"), (1, "a"), (2, "a"), (3, "B"), (4, "B"), (5, "B"), (6, "B")]
