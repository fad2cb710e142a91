from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradeloom.llm import packing, token_output

from .conftest import DOCS, messy_rows

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def naive_best_fit(items, capacity):
    bins, placed = [], []
    for size, source, cluster in items:
        fits = [(room, i) for i, (room, s, c) in enumerate(bins) if room >= size and (source < 0 or source not in s) and (cluster < 0 or cluster not in c)]
        if not fits:
            bins.append((capacity, set(), set()))
        i = min(fits)[1] if fits else len(bins) - 1
        room, s, c = bins[i]
        bins[i] = (room - size, s | {source}, c | {cluster})
        placed.append(i)
    return placed


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(-1, 3), st.integers(-1, 5)), max_size=60))
def test_best_fit_as_by_trying_every_bin(items):
    items = sorted(items, reverse=True)
    assert packing.best_fit(*map(list, zip(*items, strict=True)), 20) == naive_best_fit(items, 20) if items else True


def check_packed(rows, docs, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r["shard"], r["bin"]].append(r)
    texts, sources = {}, {}
    for d, t, _, s, _ in docs:
        texts[d], sources[d] = t, s
    for members in bins.values():
        members.sort(key=lambda r: (r["offset"], r["tokens"]))
        at = 0
        for r in members:
            assert r["offset"] == at
            at += r["tokens"]
        assert at <= capacity
    return bins


@pytest.mark.parametrize("shard_tokens", [1 << 20, 3000])
def test_packing_of_messy_documents(messy, shard_tokens):
    capacity = 500
    rows = packing.pack(packing.items(messy), capacity, shard_tokens).collect()
    bins = check_packed(rows, messy_rows(), capacity)
    want = defaultdict(list)
    for d, t, *_ in messy_rows():
        want[d].append(len((t or "").split()))
    got = defaultdict(list)
    for r in rows:
        assert r["start"] == r["piece"] * capacity
        got[r["doc_id"]].append(r["tokens"])
    assert {k: sum(v) for k, v in got.items()} == {k: sum(v) for k, v in want.items()}
    by_id = {d: (t, s) for d, t, _, s, _ in messy_rows() if d is not None}
    for members in bins.values():
        named = [r["doc_id"] for r in members if r["doc_id"] is not None]
        sources = [by_id[d][1] for d in named if by_id[d][1] is not None]
        texts = [by_id[d][0] for d in named if (by_id[d][0] or "").strip()]
        assert len(set(sources)) == len(sources) and len(set(texts)) == len(texts)


def test_nothing_to_pack(none, messy):
    assert packing.pack(packing.items(none)).count() == 0
    assert token_output.pack(none, token_output.ranks(RANKS)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 30), max_size=80))
def test_segment_tree_as_by_trying_every_row(sizes):
    sizes = sorted(sizes, reverse=True)
    placed, room = token_output.best_fit_decreasing(sizes, 30), []
    for size, row in zip(sizes, placed, strict=True):
        fits = [r for r in room if r >= size]
        if row == len(room):
            assert not fits
            room.append(30)
        else:
            assert room[row] == min(fits)
        room[row] -= size


def test_tokens_come_back_whole(messy):
    import tiktoken

    vocabulary = token_output.ranks(RANKS)
    coder = tiktoken.Encoding("own", pat_str=token_output.PATTERN, mergeable_ranks=vocabulary, special_tokens={})
    packed = token_output.write(token_output.pack(messy, vocabulary, 300, 4000))
    for r in packed.collect():
        assert len(r["input_ids"]) == 600 and r["cu_seqlens"][-1] <= 300 and r["position_resets"] == r["cu_seqlens"][:-1]
        filled = np.frombuffer(r["input_ids"], "<u2")[r["cu_seqlens"][-1] :]
        assert (filled == 50256).all()
    parts = defaultdict(list)
    for r in token_output.unpacked(packed, 2).collect():
        parts[r["doc_id"]].append((r["piece"], r["ids"]))
    want = defaultdict(list)
    for d, t, *_ in messy_rows():
        want[d].append(t or "")
    for doc, texts in want.items():
        ids = np.frombuffer(b"".join(i for _, i in sorted(parts[doc])), "<u2")
        if len(set(texts)) == 1:
            text = coder.decode([i for i in ids.tolist() if i != 50256])
            assert text == texts[0] * len(texts) and (ids == 50256).sum() == len(texts) or len(ids) > 300
        if len(texts) == 1:
            assert coder.encode_ordinary(texts[0]) + [50256] == ids.tolist()


@pytest.mark.parametrize("text", ["", "foo\n  bar", "a\x1c!\x1cb", "x  y", "  z  \n\n q", "it's 12 o'clock now", "日本 語"])
def test_chunks_are_encoded_like_whole_texts(text):
    import tiktoken

    vocabulary = token_output.ranks(RANKS)
    coder = tiktoken.Encoding("own", pat_str=token_output.PATTERN, mergeable_ranks=vocabulary, special_tokens={})
    ids, counts = token_output.Encoder(vocabulary).tokens([text, "x"])
    assert ids[: counts[0]].tolist() == coder.encode_ordinary(text) and counts.sum() == len(ids)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\t\u00a0ab1'é日."), max_size=30), max_size=8), st.integers(1, 40))
def test_encoder_as_the_library(texts, block):
    import tiktoken

    vocabulary = token_output.ranks(RANKS)
    coder = tiktoken.Encoding("own", pat_str=token_output.PATTERN, mergeable_ranks=vocabulary, special_tokens={})
    encoder = token_output.Encoder(vocabulary)
    encoder.pool.block = block
    for _ in range(2):
        ids, counts = encoder.tokens(texts)
        assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])][: len(texts)] == [coder.encode_ordinary(t) for t in texts]


def test_chunks_whose_hashes_clash_are_told_apart():
    encoder = token_output.Encoder(token_output.ranks(RANKS))
    plain, _ = encoder.tokens(["one two one three"])
    encoder = token_output.Encoder(token_output.ranks(RANKS))
    encoder.pool.base = 1
    clashing, _ = encoder.tokens(["one two one three neo eno"])
    assert clashing[: len(plain)].tolist() == plain.tolist() and clashing[-2:].tolist() != clashing[:2].tolist()


def test_rows_without_an_id_and_rows_listed_often_are_spread(spark):
    rows = [(None if i % 3 else 7, "x" * 9 if i % 3 == 0 else f"text {i} " * 20, "en", "s", 1) for i in range(900)]
    docs = spark.createDataFrame(rows, DOCS)
    vocabulary = token_output.ranks(RANKS)
    dealt = token_output.pack(docs, vocabulary, 300, 2000)
    sizes = [r["count"] for r in dealt.select("shard", F.explode("doc_ids").alias("d")).groupBy("shard").count().collect()]
    assert sum(sizes) == 900 and max(sizes) < 4 * 900 / len(sizes) and len(sizes) > 10
