"""What a task holds besides its rows, and how many Python workers an executor starts."""

from __future__ import annotations

import tracemalloc

import numpy as np
from pyspark.sql import SparkSession

from tradeloom.llm import near_copies, quality

from .conftest import prose


def test_a_batch_is_scored_in_little_memory():
    rng = np.random.default_rng(1)
    texts = [b" ".join(b"w%d" % w for w in rng.integers(0, 300_000, 400)) for _ in range(1200)] + [b""]
    lengths = np.array([len(t) if i % 7 else np.nan for i, t in enumerate(texts)])
    size = quality.WORD_SLOTS + quality.STATISTICS + quality.LENGTH_SLOTS
    model = quality.Machine(0.1, rng.normal(size=size), rng.normal(0, 0.05, (size, 8)), quality.WORD_SLOTS)
    slots = quality._Slots(quality.WORD_SLOTS)
    tracemalloc.start()
    try:
        got = quality.text_scores(model, texts, lengths, slots)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 24 << 20
    assert np.array_equal(got, quality.scores(model, *quality.vectors(texts, lengths, slots)))
    assert len(quality.text_scores(model, [], np.zeros(0), slots)) == 0


def test_near_copies_start_no_workers_for_tables_without_rows(spark, monkeypatch):
    docs = spark.createDataFrame([(i, prose("en", 60, 400 + i // 2)) for i in range(6)], "doc_id long, text string").selectExpr("doc_id", "text", "'a' AS source", "'en' AS lang", "length(text) AS n_chars")

    def refused(*args, **kwargs):
        raise AssertionError("createDataFrame starts Python workers of its own")

    monkeypatch.setattr(SparkSession, "createDataFrame", refused)
    monkeypatch.setattr(type(spark), "createDataFrame", refused)
    assert sorted(map(tuple, near_copies.grouped(docs).collect())) == [(i, i - i % 2) for i in range(6)]
