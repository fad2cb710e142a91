"""Late shingles: found where a text's shingles are made, or joined first if they are too many to be sent."""

from __future__ import annotations

import numpy as np

from tradeloom.llm import near_copies

from .conftest import DOCS, prose
from .test_near_copies import copies, jaccard_truth


def test_late_shingles_of_a_text_are_found_in_its_task(spark):
    texts = [prose("en", n, 300 + n).encode() for n in (3, 40, 200)] + [b""]
    held = [near_copies.shingles(t) for t in texts]
    all_late = np.unique(np.concatenate([h[::3] for h in held]))
    rows = spark.createDataFrame([(i, t, [int(x) for x in h[::3]]) for i, (t, h) in enumerate(zip(texts, held, strict=True))], "i int, text binary, known array<long>")
    late = spark.createDataFrame([(int(x),) for x in all_late], "s long")
    want = [(near_copies.early(h, h[::3]).tolist(), h[::3].tolist()) for h in held]
    for moved in (near_copies._after(late), near_copies._after(None)):
        got = rows.select("i", moved("text", "known").alias("m")).orderBy("i").select("m.*").collect()
        assert [(r["early"], r["late"]) for r in got] == want


def test_no_late_shingles():
    assert near_copies._among(np.array([1, 2]), np.zeros(0, np.int64)).tolist() == [False, False]
    assert near_copies._among(np.array([1, 5, 9]), np.array([5, 8])).tolist() == [False, True, False]


def test_too_many_late_shingles_to_be_sent(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "TOO_MANY", 3)
    monkeypatch.setattr(near_copies, "BROADCAST_BYTES", 0)
    rows = copies()
    rows += [(1000 + r[0], *r[1:]) for r in rows[:5]]
    found = near_copies.grouped(spark.createDataFrame(rows, DOCS).repartition(3))
    assert sorted(map(tuple, found.collect())) == sorted(jaccard_truth(rows))
