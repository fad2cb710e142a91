from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tradeloom.llm import substrings
from tradeloom.llm.queries import QUERIES
from tradeloom.llm.substrings import Grams, removed, repeats, sorted_suffixes

from .conftest import DOCS, messy_rows, prose


def truth(rows, window=50):
    first = {}
    split = [(r[0] if r[0] is not None else 2**63 - 1, (r[1] or "").encode().split()) for r in rows]
    for i, words in split:
        for at in range(len(words) - window + 1):
            w = tuple(words[at : at + window])
            first[w] = min(first.get(w, i), i)
    out = []
    for (i, words), r in zip(split, rows, strict=True):
        gone = [False] * len(words)
        for at in range(len(words) - window + 1):
            if first[tuple(words[at : at + window])] < i:
                gone[at : at + window] = [True] * window
        left = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((r[0], len(words), sum(gone), hashlib.sha256(left).hexdigest()))
    return out


def same(found, want):
    assert sorted(map(tuple, found.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str) == sorted(want, key=str)


def passages() -> list[tuple]:
    """Texts with passages of others of 40 to 200 words at either end or inside, near copies, and one text again and again."""
    rng, rows = random.Random(5), []
    shared = [prose("en", n, 700 + n) for n in (40, 49, 50, 51, 90, 200)]
    for i in range(90):
        parts = [prose("en", rng.randrange(0, 60), i), rng.choice(shared), prose("fr", rng.randrange(0, 60), i)]
        rng.shuffle(parts)
        rows.append((1000 - i, "\n ".join(parts), "en", "s", 1))
    base = prose("en", 150, 1).split()
    for i in range(40):
        near = [*base]
        near[rng.randrange(150)] = f"new{i}"
        rows.append((2000 + i, " ".join(near), "en", "s", 1))
    rows += [(3000 + i, "a b " * 400 + "c " * (i % 3), "en", "s", 1) for i in range(6)]
    return rows


@pytest.mark.parametrize("group,words", [(1000, 1 << 18), (2, 300), (0, 1 << 18)])
def test_as_by_brute_force(spark, monkeypatch, group, words):
    monkeypatch.setattr(substrings, "GROUP", group)
    monkeypatch.setattr(substrings, "TREE_WORDS", words)
    rows = passages() + messy_rows()
    same(removed(spark.createDataFrame(rows, DOCS).repartition(4)), truth(rows))


def test_messy_rows_with_clashing_names(spark, messy):
    found = removed(messy.selectExpr("*", "1 as k1", "2 as least", "3 as gram", "4 as words"))
    same(found, truth(messy_rows()))


def test_small_windows(spark):
    rows = passages()[:60]
    same(removed(spark.createDataFrame(rows, DOCS), window=7, gram=3), truth(rows, 7))


@pytest.mark.parametrize("where", ["false", "text is null", "text = ''"])
def test_no_words(spark, messy, where):
    docs = messy.filter(where)
    found = removed(docs).collect()
    assert len(found) == docs.count() and all(r["n_removed"] == r["n_words"] == 0 for r in found)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=9, max_size=60), st.integers(2, 8))
def test_sorted_suffixes_and_their_common_prefixes(ids, depth):
    ids = np.array(ids, np.int64)
    starts = np.arange(len(ids) - depth + 1)
    order, shared = sorted_suffixes(ids, starts, depth)
    cut = [tuple(ids[s : s + depth]) for s in starts[order]]
    assert cut == sorted(cut)
    for a, b, n in zip(cut[:-1], cut[1:], shared[1:], strict=True):
        assert a[:n] == b[:n] and (n == depth or a[n] != b[n])


def test_repeats_name_the_smallest_document():
    lows = repeats([b"a b c d", b"x b c d", b"b c d"], np.array([5, 3, 9]), 3)
    assert [x.tolist() for x in lows] == [[5, 3], [3, 3], [3]]


def test_equal_windows_have_equal_grams():
    a, b = prose("en", 90, 1).encode().split(), prose("fr", 70, 2).encode().split()
    grams = Grams(20, 50)
    inner, alone = b[:11] + a[15:80] + b[30:], a[15:80]
    runs = grams.runs([a, [b"short"], inner, alone])
    of = []
    for words, (gram, lo) in zip([a, [b"short"], inner, alone], runs, strict=True):
        n = max(0, len(words) - 49)
        of.append(np.repeat(gram, np.diff(np.append(lo, n))) if n else gram)
    assert of[0][15:31].tolist() == of[2][11:27].tolist() == of[3].tolist() and len(of[1]) == 0


def test_registered_query_by_brute_force(spark):
    path = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    same(QUERIES["op12_substring_dedup"](spark, path), truth(rows))
