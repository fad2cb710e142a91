from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradeloom.llm import language_id, quality
from tradeloom.llm.common import id_bucket

from .conftest import messy_rows, prose


@pytest.fixture(scope="module")
def net(messy):
    return language_id.fit(messy, F.lit(True))


@pytest.fixture(scope="module")
def machine(messy, labels):
    return quality.fit(messy, labels)


def test_languages_of_messy_documents(messy, net):
    found = language_id.identify(messy, net)
    assert set(messy.columns) <= set(found.columns) and found.count() == messy.count()
    for r in found.collect():
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in net.labels and 0 < r["score"] <= 1
    sure = [r for r in found.collect() if r["doc_id"] is not None and 0 <= r["doc_id"] < 24]
    assert all(r["lang_pred"] == r["lang"] for r in sure)


def test_equal_texts_get_equal_languages(messy, net):
    scores = {}
    for r in language_id.identify(messy, net).collect():
        assert scores.setdefault(r["text"], r["score"]) == pytest.approx(r["score"], abs=1e-6)


def test_rejected_languages(messy, net):
    kept = language_id.recognised(messy, net)
    assert kept.columns == messy.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert ids.isdisjoint({102, 103, 104, 105}) and set(range(24)) <= ids


def test_batches_give_what_one_window_at_a_time_gives(net):
    texts = [prose("fr", 90, 1).encode(), b"", b"a", prose("en", 400, 2).encode()]
    together = language_id.document_probabilities(net, texts)
    for text, found in zip(texts, together, strict=True):
        whole = np.zeros(len(net.labels))
        for at in range(0, len(text), language_id.WINDOW):
            grid, used, _ = language_id.windows([text[at : at + language_id.WINDOW]], language_id.WINDOW)
            whole += sum(p.sum(axis=(0, 2)) for _, _, p in language_id.position_probabilities(net, grid, used))
        assert np.allclose(found, whole / max(len(text), 1), atol=1e-5)


def test_every_position_has_a_label(net):
    text = (prose("en", 40, 5) + " " + prose("fr", 40, 6)).encode()
    found = language_id.label_positions(net, text)
    assert len(found) == len(text)
    assert net.labels[np.bincount(found[:150]).argmax()] == "en" and net.labels[np.bincount(found[-150:]).argmax()] == "fr"


def test_backpropagation_agrees_with_differences():
    rng = np.random.default_rng(0)
    h = language_id.HIDDEN
    d = {k: rng.normal(0, 0.5, (256, h)) for k in ("ez", "er", "en")} | {k: rng.normal(0, 0.5, (h, h)) for k in ("uz", "ur", "un")} | {"bn": rng.normal(0, 0.5, h)}
    x, keep, goal = rng.integers(0, 5, (7, 3)), np.ones((7, 3, 1)), rng.normal(0, 1, (7, 3, h))
    keep[5:, 1] = 0

    def loss():
        return float((language_id._forward(d, x, keep)[0] * goal).sum())

    _, saved = language_id._forward(d, x, keep)
    grads = language_id._backward(d, x, keep, saved, goal.astype(np.float64))
    for k, place in (("ez", (2, 1)), ("er", (3, 0)), ("en", (1, 4)), ("uz", (0, 2)), ("ur", (3, 3)), ("un", (5, 1)), ("bn", (2,))):
        old = d[k][place]
        d[k][place] = old + 1e-3
        up = loss()
        d[k][place] = old - 1e-3
        down = loss()
        d[k][place] = old
        assert grads[k][place] == pytest.approx((up - down) / 2e-3, rel=0.05, abs=2e-3)


def test_nothing_to_learn_from(none, messy):
    net = language_id.fit(none, F.lit(True))
    assert {tuple(r) for r in language_id.identify(messy, net).select("lang_pred", "score").collect()} == {("und", 0.0)}
    assert language_id.recognised(messy, net).count() == 0


def test_held_out_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    net = language_id.fit(docs, id_bucket("doc_id", 4) != 2)
    found = language_id.identify(docs, net).filter(id_bucket("doc_id", 4) == 2).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert found >= 0.9


def test_scores_of_messy_documents(messy, machine):
    found = quality.score(messy, machine).collect()
    assert len(found) == len(messy_rows()) and all(0 <= r["score"] <= 1 and r["label"] == "mine" for r in found)
    same = {}
    for r in found:
        assert same.setdefault((r["text"] or "", r["n_chars"]), r["score"]) == r["score"]


def test_quality_keeps_columns_and_rows_over_the_threshold(messy, machine):
    scores = quality.score(messy, machine, "s")
    assert quality.good(messy, machine, 0.5).columns == messy.columns
    assert quality.good(messy, machine, 0.5).count() == scores.filter("s >= 0.5").count()
    assert quality.good(messy, machine, 0.0).count() == messy.count()


def test_the_linear_time_sum_is_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    ids, x = np.array([1, 4, 9, 2, 3]), rng.normal(size=5)
    m = quality.Machine(0.3, rng.normal(size=12), rng.normal(size=(12, 4)), 8)
    got = quality.scores(m, ids, x, np.array([0, 3]))
    for (a, b), g in zip(((0, 3), (3, 5)), got, strict=True):
        logit = m.bias + sum(m.linear[ids[i]] * x[i] for i in range(a, b))
        logit += sum(m.factors[ids[i]] @ m.factors[ids[j]] * x[i] * x[j] for i in range(a, b) for j in range(a, i))
        assert g == pytest.approx(1 / (1 + np.exp(-logit)))


def test_no_labels_and_one_class(messy, labels, none):
    assert {round(r[0], 9) for r in quality.score(messy, quality.fit(messy, labels.limit(0)), "s").select("s").collect()} == {0.5}
    one = quality.fit(messy, labels.filter("quality = 1"))
    assert len({r[0] for r in quality.score(messy, one, "s").select("s").collect()}) == 1
    assert quality.score(none, one).count() == 0


def test_held_out_quality(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.score(docs, quality.fit(docs, labels)).join(labels, "doc_id").filter(id_bucket("doc_id", 5) == 0)
    assert scored.agg(F.avg(((F.col("score") >= 0.3).cast("int") == F.col("quality")).cast("double"))).first()[0] >= 0.9
