"""Large groups of near copies: what is compared, and what is kept on disk meanwhile."""

from __future__ import annotations

import random
from contextlib import ExitStack

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tradeloom.llm import near_copies
from tradeloom.llm.near_copies import parities_may_be_similar, parity
from tradeloom.session import shuffles_freed

from .conftest import DOCS, prose
from .test_near_copies import copies, jaccard_truth


def near_group(size: int) -> list[tuple]:
    """Copies of one text in which ever other words are changed, up to twelve of 140."""
    rng, base, rows = random.Random(11), prose("en", 140, 42).split(), []
    for i in range(size):
        words = [*base]
        for at in rng.sample(range(len(words)), i % 13):
            words[at] = f"w{rng.randrange(10**9)}"
        rows.append((i, " ".join(words), "en", "s", 1))
    return rows


def test_pairs_of_a_group_of_near_copies_do_not_grow_with_its_square(spark, monkeypatch):
    met = []
    compare = near_copies._Search.compare
    monkeypatch.setattr(near_copies._Search, "compare", lambda self, pairs: (met.append(pairs.distinct().count()), compare(self, pairs)))
    monkeypatch.setattr(near_copies, "TOO_MANY", 8)
    rows = near_group(260)
    found = near_copies.grouped(spark.createDataFrame(rows, DOCS).repartition(3))
    assert sorted(map(tuple, found.collect())) == sorted(jaccard_truth(rows))
    assert sum(met) < 4 * len(rows)


def test_shingles_of_the_same_texts_are_one(spark):
    rows = near_group(2) + [(5, prose("fr", 60, 9), "fr", "s", 1)]
    rows = [*rows, (6, rows[0][1] + " and more", "en", "s", 1)]
    with ExitStack() as held:
        members = near_copies._Search(spark.createDataFrame(rows, DOCS), held).members().collect()
    sets = {}
    for r in members:
        sets.setdefault(r["s"], set()).add(r["key"])
    assert len(sets) == len({frozenset(x) for x in sets.values()}) > 0


def test_shuffles_are_freed_in_the_block_only(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    with shuffles_freed(spark):
        assert spark.conf.get(name) == "true"
        twice = spark.range(100).groupBy("id").count()
        assert len(twice.collect()) == len(twice.collect()) == 100
    assert spark.conf.get(name) == before


shingle_sets = st.tuples(st.integers(0, 2**32), st.integers(0, 400), st.integers(0, 60), st.integers(0, 60))


@settings(max_examples=300, deadline=None)
@given(shingle_sets)
def test_parities_rule_no_similar_pair_out(case):
    seed, both, only_a, only_b = case
    x = np.unique(np.random.default_rng(seed).integers(-(1 << 63), 1 << 63, both + only_a + only_b, np.int64))
    a, b = np.sort(x[: len(x) - only_b]), np.sort(np.concatenate([x[:both], x[len(x) - only_b :]]))
    if 9 * len(np.intersect1d(a, b)) >= 4 * (len(a) + len(b)):
        assert parities_may_be_similar(len(a), len(b), parity(a), parity(b))


def test_parities_rule_other_pairs_out():
    x = np.random.default_rng(5).integers(-(1 << 63), 1 << 63, 300, np.int64)
    a, b, c = np.sort(x[:200]), np.sort(x[60:260]), np.sort(x[:230])
    assert not parities_may_be_similar(200, 200, parity(a), parity(b))
    # Of two lengths: the longer one is folded.
    assert len(parity(c[:120])) < len(parity(c[:140])) and parities_may_be_similar(120, 140, parity(c[:120]), parity(c[:140]))


def test_copies_with_one_turn_of_each_kind(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "TOO_MANY", 2)
    monkeypatch.setattr(near_copies, "TURNS", 3)
    monkeypatch.setattr(near_copies, "LED", 0)
    rows = copies()
    found = near_copies.grouped(spark.createDataFrame(rows, DOCS).repartition(3))
    assert sorted(map(tuple, found.collect())) == sorted(jaccard_truth(rows))
