from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tradeloom.llm import lexical
from tradeloom.llm.lexical import Best, Bucket, Query, search, terms

from .conftest import DOCS, messy_rows, prose

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
ITEMS = "item_id long, text string"


def split(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def truth(docs, items, k=20):
    own = [(r[0], split(r[1])) for r in docs]
    n, length = sum(1 for _, t in own if t), sum(len(t) for _, t in own)
    df = Counter(t for _, ts in own for t in set(ts))
    out = []
    for item, text in items:
        scored = []
        for doc, ts in own:
            tf = Counter(ts)
            m = 75 + 25 * len(ts) * n // length if ts else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m)) for t in split(text) if tf[t])
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return out


def messy_items():
    rows = messy_rows()
    texts = [rows[3][1], rows[0][1] + " " + rows[0][1], None, "", " !? ", "THE of thetheTHE été Été", "no such word at all", "12 345", rows[5][1][:40], rows[3][1]]
    return [*enumerate(texts), (1, "the house"), (None, "été dans une leçon où")]


def same(found, want):
    assert sorted(map(tuple, found.select("item_id", "rank", "doc_id", "score").collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("first,ranges,items,k", [(8192, 65_536, 1024, 20), (6, 5, 1024, 3), (1, 7, 4, 1)])
def test_as_by_brute_force(spark, messy, monkeypatch, first, ranges, items, k):
    for name, value in (("FIRST", first), ("RANGE", ranges), ("ITEMS", items)):
        monkeypatch.setattr(lexical, name, value)
    asked = spark.createDataFrame(messy_items(), ITEMS).selectExpr("*", "1 as rank", "2 as score", "3 as doc_id")
    same(search(messy, asked, k), truth(messy_rows(), messy_items(), k))


def test_many_copies_and_one_common_word(spark):
    rows = [(i, "common " + ("copy of a text" if i % 3 == 0 else prose("en", 20, i)), "en", "s", 1) for i in range(600)]
    items = [(1, "common copy"), (2, "common"), (3, prose("en", 20, 7))]
    same(search(spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS)), truth(rows, items))


def test_no_documents_and_no_items(spark, messy, none):
    items = spark.createDataFrame(messy_items(), ITEMS)
    assert search(none, items).count() == 0
    assert search(messy, items.limit(0)).count() == 0
    assert search(messy.filter("text is null"), items).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=40))
def test_terms_by_pattern(raw):
    text = raw.decode("utf-8", "ignore")
    assert terms(text.encode()) == [t.encode() for t in split(text)]


def test_survivors_hold_every_row_that_reaches_the_bar():
    rng, left = np.random.default_rng(1), 0
    for _ in range(60):
        sizes = rng.integers(1, 9, 200)
        term = np.concatenate([np.sort(rng.choice(12, s, replace=False)) for s in sizes])
        impact = rng.integers(1, 1000, len(term))
        norm = np.sqrt(np.add.reduceat(impact.astype(float) ** 2, np.cumsum(sizes) - sizes))
        bucket = Bucket(np.arange(200), np.zeros(200, bool), norm, sizes, term, impact)
        at = np.sort(rng.choice(12, 3, replace=False))
        weight = rng.integers(1, 2000, 3)
        q = Query(at, weight, math.sqrt(float((weight.astype(float) ** 2).sum())))
        dense = np.zeros(12, np.int64)
        dense[at] = weight
        scores = bucket.scores(np.arange(200), dense)
        bar = int(np.sort(scores)[-5])
        rows = bucket.survivors(q, bar)
        assert set(np.flatnonzero(scores >= bar)) <= set(rows.tolist())
        left += len(rows)
        assert len(bucket.survivors(q, int(q.length * norm.max() * 1.001) + 1)) == 0
    assert left < 60 * 200 * 0.6


def test_best_keeps_ties_by_id():
    best = Best(2, 0)
    best.add(np.array([5, 3, 1]), np.array([False, False, True]), np.array([7, 7, 7]))
    best.add(np.array([4]), np.array([False]), np.array([7]))
    assert best.ids.tolist() == [3, 4] and best.bar == 7
