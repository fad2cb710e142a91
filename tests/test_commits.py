"""Exclusive commits, leases, deltas, the change feed, and commits of several tables."""

import threading
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tradeloom.operators.merge import merge_into, merge_rows
from tradeloom.session import in_parallel
from tradeloom.sources import tables
from tradeloom.sources.commits import Folder, together
from tradeloom.sources.tables import ConcurrentWrite, KeyedTable

S = "id bigint, v string"


def t(spark, *items, schema=S):
    return spark.createDataFrame(list(items), schema)


def folders(path):
    return sorted({p.parent.name for p in (path / "data").glob("*/_part=*")})


def test_a_file_is_put_once(spark, tmp_path):
    folder = Folder(spark, str(tmp_path))
    won = []

    def put(writer):
        mine = Folder(spark, str(tmp_path))
        won.extend((n, writer) for n in range(150) if mine.put(f"claims/{n}", writer))

    writers = [threading.Thread(target=put, args=(w,)) for w in ("a", "b")]
    [w.start() for w in writers]
    [w.join() for w in writers]
    assert sorted(n for n, _ in won) == list(range(150))
    assert all(folder.text(f"claims/{n}") == w for n, w in won)
    assert folder.text("claims/none") is None and not list((tmp_path / "claims").glob(".*"))


def test_an_unknown_file_system_is_an_error(spark, tmp_path, monkeypatch):
    class Odd:
        def getUri(self):
            return self

        def getScheme(self):
            return "odd"

    folder = Folder(spark, str(tmp_path))
    monkeypatch.setattr(folder, "at", lambda name: (None, Odd()))
    with pytest.raises(NotImplementedError, match="odd"):
        folder.put("x", "")


def test_a_held_build_longer_than_the_lease_is_published(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "STALE_SECONDS", 2)
    monkeypatch.setattr(tables, "BEAT_SECONDS", 0.3)
    held = KeyedTable(spark, str(tmp_path / "t"), ["id"], held=True)
    held.replace(t(spark, (1, "a")))
    other = threading.Thread(target=lambda: KeyedTable(spark, str(tmp_path / "t"), ["id"]).apply(t(spark, (2, "b")), lambda old, new: new))
    other.start()
    time.sleep(5)
    held.publish()
    other.join()
    assert rows(KeyedTable(spark, str(tmp_path / "t"), ["id"]).read(), "*") == [(1, "a"), (2, "b")]


def test_a_writer_that_lost_its_turn_does_no_harm(spark, tmp_path):
    slow, fast = (KeyedTable(spark, str(tmp_path / "t"), ["id"], held=h) for h in (True, False))
    slow.replace(t(spark, (1, "slow")))
    fast.folder.delete("claims/version=1")
    fast.replace(t(spark, (2, "fast")))
    with pytest.raises(ConcurrentWrite, match="version 1"):
        slow.publish()
    assert rows(fast.read(), "*") == [(2, "fast")]


def test_a_batch_writes_its_own_rows_only(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"])
    merge_into(table, spark.range(20_000).select("id", F.uuid().alias("v")))
    base = table.folder.size("data")
    for n in range(4):
        merge_into(table, t(spark, (n, "new"), (100_000 + n, "added")))
    assert table.folder.size("data") < 1.2 * base and len(folders(tmp_path / "t")) == 5
    assert table.read().count() == 20_004
    assert rows(table.read().filter("v in ('new', 'added')"), "id") == [(n,) for n in (0, 1, 100_000, 100_001, 100_002, 100_003, 2, 3)]


def test_bytes_written_by_appends_grow_linearly(spark, tmp_path):
    table, sizes = KeyedTable(spark, str(tmp_path / "t"), ["id"]), []
    for n in range(10):
        batch = spark.range(n * 3000, (n + 1) * 3000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
        table.apply(batch, lambda old, new: new.join(old, "id", "left_anti"))
        sizes.append(table.folder.size("data"))
    assert sizes[9] < 3 * 10 * sizes[0]
    assert table.read().count() == 30_000


def test_deltas_are_folded_in_when_there_are_many(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "MOST_DELTAS", 2)
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"])
    merge_into(table, spark.range(5000).select("id", F.uuid().alias("v")))
    for n in range(6):
        merge_into(table, t(spark, (n % 2, str(n)), (None, "none")))
        assert max(len(f) for f in table._content().live.values()) <= 3
    got = table.read().filter("length(v) < 5")
    assert rows(got, "*") == [(0, "4"), (1, "5")] + [(None, "none")] * 6


def test_deleted_keys_stay_away_and_may_come_back(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"])
    table.replace(spark.range(1000).select("id", F.uuid().alias("v")))
    table.apply(t(spark, (1, ""), (2, "")), lambda old, new: old.limit(0), deletes=True)
    assert table.read().count() == 998
    table.apply(t(spark, (2, "back")), lambda old, new: new)
    assert table.read().count() == 999 and rows(table.read().filter("id < 3"), "id") == [(0,), (2,)]


def test_a_column_added_by_a_delta_is_null_before(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"])
    table.replace(spark.range(1000).select("id", F.uuid().alias("v")))
    table.apply(t(spark, (5, "x", 7), schema=S + ", n int"), lambda old, new: merge_rows(old, new, ["id"], True))
    assert rows(table.read().filter("n is not null"), "*") == [(5, "x", 7)] and table.read().count() == 1000


def test_changes_since_a_version(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"], "id div 10")
    assert table.changes(0) is None and table.version() == 0
    table.replace(t(spark, *[(i, "a") for i in range(30)]))
    table.apply(t(spark, (3, "b"), (40, "b")), lambda old, new: new)
    table.apply(t(spark, (3, "c"), (12, "c")), lambda old, new: new)
    assert rows(table.changes(1), "*") == [(12, "c"), (3, "c"), (40, "b")]
    assert rows(table.changes(1, 2), "*") == [(3, "b"), (40, "b")]
    assert rows(table.changes(3), "*") == [] and table.changes(0).count() == 31
    # Rewriting keeps the version of each row, and unchanged folders aren't opened.
    opened = {f.rsplit("/", 2)[1] for f in table.changes(1).inputFiles()}
    assert opened == {"_part=0", "_part=1", "_part=4"}


def test_two_tables_change_at_once(spark, tmp_path):
    a, b = (KeyedTable(spark, str(tmp_path / n), ["id"]) for n in "ab")
    for table in (a, b):
        table.replace(t(spark, (1, "old")))
    with together(spark, str(tmp_path), [b, a]):
        a.apply(t(spark, (2, "new")), lambda old, new: new)
        assert a.read().count() == 1
        b.apply(t(spark, (1, "")), lambda old, new: old.limit(0), deletes=True)
        assert b.read().count() == 1
    assert rows(a.read(), "id") == [(1,), (2,)] and b.read().count() == 0


def test_a_job_that_dies_between_two_tables_leaves_both_as_they_were(spark, tmp_path, monkeypatch):
    a, b = (KeyedTable(spark, str(tmp_path / n), ["id"]) for n in "ab")
    for table in (a, b):
        table.replace(t(spark, (1, "old")))
    with pytest.raises(ZeroDivisionError), together(spark, str(tmp_path), [a, b]):
        a.apply(t(spark, (2, "new")), lambda old, new: new)
        1 / 0
    assert a.read().count() == b.read().count() == 1
    # Killed before the decision: the next writer refuses what was left, once the lease is void.
    block = together(spark, str(tmp_path), [a, b])
    record = block.__enter__()
    a.apply(t(spark, (3, "lost")), lambda old, new: new)
    for table in (a, b):
        table._turn_of[1]._over.set()
        table._turn_of = None
    assert a.read().count() == 1
    monkeypatch.setattr(tables, "STALE_SECONDS", 0.5)
    a.apply(t(spark, (4, "next")), lambda old, new: new)
    assert rows(a.read(), "id") == [(1,), (4,)] and record.decide(True) is False
    assert rows(a.read(), "id") == [(1,), (4,)]


def test_many_writers_lose_nothing(spark, tmp_path):
    def add(n):
        KeyedTable(spark, str(tmp_path / "t"), ["id"], "id div 3").apply(t(spark, (n, "x")), lambda old, new: new)

    in_parallel(spark, {str(n): (lambda n=n: add(n)) for n in range(8)}, 8)
    assert sorted(r[0] for r in rows(KeyedTable(spark, str(tmp_path / "t"), ["id"]).read(), "id")) == list(range(8))
