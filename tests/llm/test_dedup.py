from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradeloom.llm import exact_dedup, fuse, simhash
from tradeloom.llm.components import components

from .conftest import messy_rows


@settings(max_examples=30, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=400))
def test_a_fuse_filter_holds_its_keys(keys):
    made = fuse.build(np.array(sorted(keys), np.uint64))
    assert fuse.contains(made, np.array(sorted(keys), np.uint64)).all()


def test_a_fuse_filter_rules_out_most_others():
    rng = np.random.default_rng(0)
    made = fuse.build(np.unique(rng.integers(0, 2**63, 20_000).astype(np.uint64)))
    assert fuse.contains(made, rng.integers(0, 2**63, 50_000).astype(np.uint64)).mean() < 0.01
    assert len(made.cells) < 1.4 * 20_000


def exact_truth(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    out = []
    for r in rows:
        ids = groups[r[1] or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((r[0], keep, len(ids), r[0] == keep, hashlib.sha256((r[1] or "").encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("batches", [1, 3])
def test_exact_groups_as_by_brute_force(messy, batches):
    found = exact_dedup.resolve(messy, batches).select("id", "keep_id", "group_size", "kept", "digest")
    assert sorted(map(tuple, found.collect()), key=str) == exact_truth(messy_rows())


def test_texts_that_share_a_digest_are_told_apart_by_their_bytes(messy):
    found = exact_dedup.resolve(messy, 3, lambda c: F.substring(exact_dedup.sha256(c), 1, 1))
    rows = sorted(map(tuple, found.select("id", "keep_id", "group_size", "kept").collect()), key=str)
    assert rows == sorted((r[:4] for r in exact_truth(messy_rows())), key=str)


def test_exact_dedup_leaves_one_row_a_text(messy):
    kept = exact_dedup.kept(messy)
    assert kept.columns == messy.columns
    rows = kept.collect()
    texts = [r["text"] or "" for r in rows]
    assert len(texts) == len(set(texts)) == len({r[1] or "" for r in messy_rows()})
    assert 2**60 + 1 in {r["doc_id"] for r in rows} and all(r["kept"] == "mine" for r in rows)


def test_no_documents(none):
    assert exact_dedup.resolve(none).count() == 0 and exact_dedup.kept(none).count() == 0
    assert simhash.grouped(none).count() == 0 and simhash.kept(none).count() == 0


def fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_truth(rows):
    prints = [fingerprint(r[1]) for r in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                group[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        ids = [x for x in (least.get(find(i)), r[0]) if x is not None]
        least[find(i)] = min(ids, default=None)
    return [(r[0], prints[i], least[find(i)]) for i, r in enumerate(rows)]


def test_near_groups_as_by_brute_force(messy):
    found = [(r[0], r[1] & (2**64 - 1), r[2]) for r in simhash.grouped(messy).collect()]
    assert sorted(found, key=str) == sorted(near_truth(messy_rows()), key=str)


def test_near_dedup_leaves_the_smallest_id_of_a_group(messy):
    kept = simhash.kept(messy)
    assert kept.columns == messy.columns
    groups = {(c, p if c is None else 0) for _, p, c in near_truth(messy_rows())}
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted((c for c, _ in groups), key=str)


def test_equal_ids_of_different_texts_are_told_apart(spark, messy):
    docs = messy.filter("doc_id = 1").unionByName(messy.filter("doc_id = 3").withColumn("doc_id", F.lit(1).cast("long")))
    assert simhash.kept(docs).count() == exact_dedup.kept(docs).count() == 2


def brute_pairs(keys):
    return {(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if (a ^ b).bit_count() <= 2}


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=30), st.lists(st.tuples(st.integers(0, 29), st.integers(0, 63), st.integers(0, 63)), max_size=60))
def test_trie_traversal_as_all_pairs(base, flips):
    keys = sorted({*base, *(base[i] ^ (1 << a) ^ (1 << b) for i, a, b in flips if i < len(base))})
    a, b = simhash.trie_pairs(np.array(keys, np.uint64), None, 0)
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == brute_pairs(keys) and len(a) == len(brute_pairs(keys))


def test_links_as_all_pairs_with_sliced_nodes(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**64, 60, dtype=np.uint64)
    hot = np.uint64(5) ^ (np.uint64(1) << rng.integers(0, 64, 120).astype(np.uint64))
    near = base ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64))
    keys = np.unique(np.concatenate([base, hot, near]))
    table = spark.createDataFrame([(int(k),) for k in keys.view(np.int64)], "fp long")
    found = simhash.links(table, node=16).collect()
    pairs = [tuple(sorted((r[0] & (2**64 - 1), r[1] & (2**64 - 1)))) for r in found]
    assert set(pairs) == brute_pairs(sorted(keys.tolist())) and len(pairs) == len(set(pairs))


def test_majorities_of_long_texts_do_not_overflow():
    hashes = np.full(1000, 2**64 - 1, np.uint64)
    assert simhash.majorities(hashes, np.array([0, 700, 300])).tolist() == [0, 2**64 - 1, 2**64 - 1]


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(1000, i) for i in range(1001, 1060)]
    links = spark.createDataFrame([*chain, *star, (7, 7), (500, 500), (None, 3), (4, None), (1, 0)], "a long, b long")
    rows = components(links, "a", "b").collect()
    truth = {i: 0 for i in range(41)} | {i: 1000 for i in range(1000, 1060)} | {500: 500}
    assert len(rows) == len(truth) and dict(map(tuple, rows)) == truth
    assert components(links.limit(0), "a", "b").count() == 0
