from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline as pipeline
from tradeloom.llm import near_copies

from .conftest import DOCS, messy_rows, prose


def jaccard_truth(rows):
    """The smallest id of every row's group, by comparing all pairs."""
    sets = []
    for r in rows:
        words = (r[1] or "").encode().lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))})
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if 9 * len(sets[i] & sets[j]) >= 4 * (len(sets[i]) + len(sets[j])):
                group[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        ids = [x for x in (least.get(find(i)), r[0]) if x is not None]
        least[find(i)] = min(ids, default=None)
    return [(r[0], least[find(i)]) for i, r in enumerate(rows)]


def copies() -> list[tuple]:
    """Texts with copies that differ in more and more words, chains of them, and a line that all hold."""
    rng, rows = random.Random(4), []
    line = prose("en", 12, 1000)
    for base in range(8):
        words = prose("en", 120, 2000 + base).split()
        for step in range(12):
            rows.append((len(rows), line + " " + " ".join(words), "en", "s", 1))
            for _ in range(1 + step % 4 // 2):
                words = [*words]
                words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
            if step % 5 == 4:
                words = prose("en", 120, 2000 + base).split()
    return rows


@pytest.mark.parametrize("many,turns,cut", [(32, 2, 512), (3, 4, 3), (1, 1, 512), (10**6, 0, 3)])
def test_groups_as_by_brute_force(spark, monkeypatch, many, turns, cut):
    monkeypatch.setattr(near_copies, "TOO_MANY", many)
    monkeypatch.setattr(near_copies, "TURNS", turns)
    monkeypatch.setattr(near_copies, "SLICE", cut)
    rows = copies() + [(r[0] if r[0] is None else r[0] + 10_000, *r[1:]) for r in messy_rows()]
    found = near_copies.grouped(spark.createDataFrame(rows, DOCS).repartition(3))
    want = jaccard_truth(rows)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
    assert len({c for _, c in want}) < len(rows) - 60


def test_the_stage_leaves_one_of_each_group(spark):
    rows = copies()
    kept = pipeline.near(spark, spark.createDataFrame(rows, DOCS), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in jaccard_truth(rows)})


def test_one_line_in_a_third_of_all_texts(spark):
    line = prose("en", 60, 77)
    rows = [(i, (line + " " if i % 3 == 0 else "") + prose("en", 70, 5000 + i // 2 * (i % 5 > 0)), "en", "s", 1) for i in range(150)]
    found = near_copies.grouped(spark.createDataFrame(rows, DOCS))
    assert sorted(map(tuple, found.collect())) == sorted(jaccard_truth(rows))


def test_no_fingerprints_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(near_copies._Search, "by_fingerprint", lambda self: self.links)
    rows = copies()
    found = near_copies.grouped(spark.createDataFrame(rows, DOCS))
    assert sorted(map(tuple, found.collect())) == sorted(jaccard_truth(rows))


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 60), max_size=50), st.sets(st.integers(0, 60), max_size=50))
def test_early_shingles_rule_no_similar_pair_out(a, b):
    x, y = (np.array(sorted(s), np.int64) for s in (a, b))
    if 9 * len(a & b) >= 4 * (len(a) + len(b)):
        assert near_copies.may_be_similar(len(a), len(b), near_copies.early(x), near_copies.early(y))


def test_late_shingles_go_last():
    assert near_copies.early(np.arange(10), np.array([0, 2])).tolist() == [1, 3, 4]
