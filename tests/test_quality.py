"""Data tests."""

import hashlib
from functools import reduce

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from tradeloom.operators import quality as q
from tradeloom.operators.quality import Rule


@pytest.fixture(scope="module")
def tables(spark):
    child = spark.createDataFrame(
        [(1, "sale", 5, 10), (2, "odd", -5, 10), (2, None, None, 11), (None, "void", 0, None)],
        "id bigint, kind string, amount int, parent bigint",
    )
    return {"child": child, "parent": spark.createDataFrame([(10,)], "pk bigint")}


RULES = [
    Rule("child", "id", "unique"),
    Rule("child", "id", "not_null"),
    Rule("child", "kind", "accepted_values", ("sale", "void"), "warn"),
    Rule("child", "amount", "expression", ">= 0"),
    Rule("child", "amount", "predicate", "amount IS NULL OR amount < 100"),
    Rule("child", "parent", "relationships", ("parent", "pk")),
    Rule("absent", "x", "unique"),
]


def test_suite(tables):
    got = rows(q.run_suite(tables, RULES), "column_name", "test", "failures", "status")
    got = [(*r[:2], int(r[2]), r[3]) if r[2] not in (None, "None") else r for r in got]
    assert ("x", "unique", None, "skipped") in got
    assert [r for r in got if r[3] != "skipped"] == [
        ("amount", "expression", 1, "fail"), ("amount", "predicate", 0, "pass"), ("id", "not_null", 1, "fail"),
        ("id", "unique", 1, "fail"), ("kind", "accepted_values", 1, "warn"), ("parent", "relationships", 1, "fail"),
    ]


def test_failures_stop_a_job_and_warnings_do_not(tables):
    results = q.run_suite(tables, RULES)
    with pytest.raises(ValueError, match="4 data tests failed.*child.parent relationships"):
        q.require_passed(results)
    with pytest.raises(ValueError, match="could not run.*absent"):
        q.require_passed(results.filter("status <> 'fail'"))
    q.require_passed(results.filter("status <> 'fail'"), optional=["absent"])


def test_null_fraction_as_a_rule(spark):
    tables = {"t": spark.createDataFrame([(None,)] * 96 + [(1,)] * 4, "c int"), "none": spark.createDataFrame([], "c int")}
    rules = [Rule("t", "c", "null_fraction", 0.95), Rule("t", "c", "null_fraction", 0.96), Rule("none", "c", "null_fraction", 0.95)]
    assert [r.status for r in q.run_suite(tables, rules).collect()] == ["fail", "pass", "pass"]


def test_failing_rows(tables):
    child = tables["child"]
    assert rows(q.failing_rows(child, RULES[0]), "*") == [(2, 2)]
    assert rows(q.failing_rows(child, RULES[2]), "id", "kind") == [(2, "odd")]
    assert rows(q.failing_rows(child, RULES[5], tables), "*") == [(11, 1)]
    with pytest.raises(ValueError, match="unknown test"):
        q.failing_rows(child, Rule("child", "id", "nonsense"))


def test_tally_counts_warnings_in_the_total_only(spark):
    results = spark.createDataFrame(
        [("model", "success"), ("model", "error"), ("test", "pass"), ("test", "warn"), ("test", "fail"), ("test", "error")],
        "kind string, status string",
    )
    assert tuple(q.tally(results).first()) == (1, 4, 1, 1, False)


def test_null_fraction(spark):
    df = spark.createDataFrame([(None,)] * 96 + [(1,)] * 4, "c int")
    assert q.null_fraction_exceeded(df, "c").first().null_fraction == 0.96
    assert q.null_fraction_exceeded(df.limit(0), "c").count() == 0
    assert q.null_fraction_exceeded(df.filter("c IS NOT NULL"), "c").count() == 0


def test_freshness_limits(spark):
    loads = spark.createDataFrame(
        [("orders", at("2026-01-01T05:00")), ("orders", at("2026-01-01T00:00")), ("customers", at("2025-12-31T23:00")),
         ("products", at("2025-12-28T00:00")), ("locations", at("2020-01-01")), ("unlisted", at("2025-12-31T00:00"))],
        "source string, ingested_at timestamp",
    )
    got = q.freshness(loads, F.lit("2026-01-01 12:00:00").cast("timestamp"))
    assert rows(got, "source", "status") == [("customers", "warn"), ("orders", "warn"), ("products", "error"), ("unlisted", "warn")]


def test_hash_keys_are_counted_as_bytes_and_stay_apart_from_other_texts(spark):
    key = hashlib.md5(b"1").hexdigest()
    texts = [key, key, key.upper(), bytes.fromhex(key).decode("latin-1"), "h", "", key + " ", key + "\n"]
    packed = spark.createDataFrame([(x,) for x in texts], "k string").select(q._packed(F.col("k")).alias("p"))
    got = [bytes(r.p) for r in packed.collect()]
    assert len(set(got)) == len(set(texts)) and len(got[0]) == 17
    df = spark.createDataFrame([(x,) for x in texts], "k string")
    assert rows(q.run_suite({"t": df}, [Rule("t", "k", "unique")]), "failures") == [(1,)]


def test_a_key_is_yielded_once_for_all_rules_that_count_it(spark, monkeypatch):
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "pk bigint, name string")
    tables = {"p": parent, "c": spark.createDataFrame([(1, "1"), (3, "x"), (None, None)], "fk int, text string")}
    rules = [
        *q.key("p", "pk"), Rule("c", "fk", "relationships", ("p", "pk")), Rule("c", "text", "relationships", ("p", "pk"), "warn"),
        Rule("c", "fk", "relationships", ("p", "pk"), "warn"), Rule("c", "fk", "unique"), Rule("c", "fk", "null_fraction", 0.3),
    ]
    yielded = []
    monkeypatch.setattr(q, "reduce", lambda f, frames: yielded.append([x.count() for x in frames]) or reduce(f, frames))
    got = [(r.test, r.failures, r.status) for r in q.run_suite(tables, rules).collect()]
    assert got == [
        ("unique", 1, "fail"), ("not_null", 1, "fail"), ("relationships", 1, "fail"), ("relationships", 1, "warn"),
        ("relationships", 1, "warn"), ("unique", 0, "pass"), ("null_fraction", 1, "fail"),
    ]
    # Three keys of the parent and the row that has none, with two rows of the child for each of three rules;
    # the child's own two keys, and each of its rows for its NULLs.
    assert sorted(yielded) == [[4, 6], [5]]


def test_whole_numbers_are_counted_as_their_bytes(spark):
    numbers = [0, 1, -1, 15, 16, 255, 256, 2**40, -(2**40), 2**63 - 1, -(2**63)]
    df = spark.createDataFrame([(x,) for x in [*numbers, None, 16]], "n bigint")
    keys = [r.k for r in df.select(q._number_key(F.col("n")).alias("k")).collect()]
    assert len({bytes(k) for k in keys if k is not None}) == len(numbers) and max(len(k) for k in keys if k) == 8
    assert rows(q.run_suite({"t": df}, [Rule("t", "n", "unique")]), "failures") == [(1,)]


def test_no_query_counts_the_keys_of_many_tables(spark, monkeypatch):
    """The shuffle of a suite grows with the largest table and those that refer to it, not with all of them."""
    frames = []
    monkeypatch.setattr(q, "reduce", lambda f, seen: frames.append(len(seen)) or reduce(f, seen))
    tables = {f"t{i}": spark.range(3).select(F.col("id").alias("k"), (F.col("id") + 1).alias("to")) for i in range(4)}
    rules = [*(r for t in tables for r in q.key(t, "k")), Rule("t1", "to", "relationships", ("t0", "k"))]
    got = q.run_suite(tables, rules)
    assert rows(got.filter("failures > 0"), "table_name", "test", "failures") == [("t1", "relationships", 1)]
    assert got.count() == 9 and sorted(frames) == [1, 1, 1, 2]
