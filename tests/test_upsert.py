"""Laws of landing writes."""

import random
from datetime import timedelta

import pytest
from conftest import at, rows

from tradeloom.operators.upsert import guarded_upsert, last_arrivals, load_summary
from tradeloom.sources.domains import domain, split_table
from tradeloom.sources.tables import KeyedTable
from tradeloom.streaming.landing import land_rows

SCHEMA = "id bigint, payload string, updated_at timestamp"
BASE = at("2026-03-01")


def table(spark, *items):
    return spark.createDataFrame([(i, p, BASE + timedelta(seconds=s)) for i, p, s in items], SCHEMA)


def content(df):
    return rows(df, "id", "payload")


def test_inserts_all_rows_of_a_large_batch(spark):
    batch = table(spark, *[(i, f"p{i}", 0) for i in range(1500)])
    assert guarded_upsert(table(spark).limit(0), batch).count() == 1500


def test_replays_do_not_change_the_table(spark):
    batch = table(spark, (1, "a", 0), (2, "b", 1))
    once = guarded_upsert(table(spark).limit(0), batch)
    thrice = guarded_upsert(guarded_upsert(once, batch), batch)
    assert content(once) == content(thrice) == [(1, "a"), (2, "b")]


def test_newer_and_equal_replace_older_does_not(spark):
    old = table(spark, (1, "old", 10), (2, "old", 10), (3, "old", 10))
    new = guarded_upsert(old, table(spark, (1, "new", 11), (2, "new", 10), (3, "new", 9)))
    assert content(new) == [(1, "new"), (2, "new"), (3, "old")]


def test_empty_batch(spark):
    old = table(spark, (1, "a", 0))
    assert content(guarded_upsert(old, table(spark).limit(0))) == [(1, "a")]
    assert load_summary(table(spark).limit(0)).first().rows_total == 0


def test_summary_counts_what_was_submitted(spark):
    s = load_summary(table(spark, (1, "a", 0), (1, "b", 5), (1, "c", 3))).first()
    assert s.rows_total == 3
    assert s.max_updated_at.replace(tzinfo=None) == (BASE + timedelta(seconds=5)).replace(tzinfo=None)


def test_last_arrival_wins_ties(spark):
    batch = spark.createDataFrame(
        [(1, "first", BASE, 1, 0), (1, "last", BASE, 2, 0), (1, "middle", BASE, 1, 9)],
        SCHEMA + ", page bigint, position bigint",
    )
    assert content(last_arrivals(batch)) == [(1, "last")]


def test_unknown_key_and_bad_names_are_errors(spark):
    with pytest.raises(ValueError, match="no column"):
        guarded_upsert(table(spark), table(spark), keys=("nope",))
    with pytest.raises(ValueError, match="schema.table"):
        split_table("orders")
    with pytest.raises(ValueError, match="unknown domain"):
        domain("events")


def test_text_key_of_several_parts(spark):
    schema = "id string, payload string, updated_at timestamp"
    old = spark.createDataFrame([("1:2:2026-01-01", "a", BASE)], schema)
    new = spark.createDataFrame([("1:2:2026-01-01", "b", BASE), ("1:2:2026-01-02", "c", BASE)], schema)
    assert content(guarded_upsert(old, new)) == [("1:2:2026-01-01", "b"), ("1:2:2026-01-02", "c")]


def test_any_sequence_equals_applying_rows_one_by_one(spark, tmp_path):
    """One id holds a third of the rows; batches go through a stored table."""
    rng = random.Random(7)
    store = KeyedTable(spark, str(tmp_path / "t"), ["id"], "id div 4")
    expected: dict[int, tuple] = {}
    for batch_no in range(3):
        batch = []
        for pos in range(150):
            key = 1 if rng.random() < 0.33 else rng.randrange(12)
            ts = BASE + timedelta(seconds=rng.randrange(20))
            batch.append((key, f"{batch_no}-{pos}", ts, batch_no, pos))
            if key not in expected or ts >= expected[key][1]:
                expected[key] = (f"{batch_no}-{pos}", ts)
        df = spark.createDataFrame(batch, SCHEMA + ", page bigint, position bigint")
        land_rows(store, df.repartition(5))
    assert content(store.read()) == sorted(((k, v[0]) for k, v in expected.items()), key=str)
