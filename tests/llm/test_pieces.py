from __future__ import annotations

import dataclasses
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tradeloom.llm import sentencepiece_match as match

from .conftest import messy_rows

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ODD = ["", "a", " a  b\n c\t", "\n\n", "日本語 😀", "a\x00b", "   ", "<s> <0x41> <unk>", "A" * 60, "é́ ﬁ", "    x = 1\n        y"]


@pytest.fixture(scope="module")
def pieces():
    return match.load(MODEL)


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def split(ids, counts):
    return [a.tolist() for a in np.split(ids, np.cumsum(counts)[:-1])]


def test_ids_and_texts_as_the_library(pieces, library):
    encoder = match.Encoder(pieces)
    texts = ODD + [r[1] for r in messy_rows() if r[1] and len(r[1]) < 5000]
    found = split(*encoder.encode(texts))
    assert found == library.encode(texts)
    assert [encoder.decode(np.array(f, np.int64)) for f in found] == texts


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("ab the\né中▁", max_size=30), min_size=1, max_size=4))
def test_any_text_as_the_library(pieces, library, texts):
    assert split(*match.Encoder(pieces).encode(texts)) == library.encode(texts)


def test_occurrences_as_by_looking_everywhere(pieces):
    encoder = match.Encoder(pieces)
    segments = ["▁the", "re", "▁▁x", "ttttt"]
    text = "".join(segments)
    table = encoder._edges(np.frombuffer(text.encode("utf-32-le"), np.uint32), np.array([len(s) for s in segments]))
    number = {t: i for i, t in enumerate(pieces.texts) if t}
    at = 0
    for s in segments:
        for i in range(len(s)):
            for width in range(1, encoder.widest + 1):
                want = number.get(s[i : i + width], -1) if i + width <= len(s) else -1
                assert table[at + i, width - 1] == want
        at += len(s)


def test_best_paths_of_a_unigram_model(pieces):
    scores = np.where([bool(t) for t in pieces.texts], [-3.0 - (i % 97) / 10 for i in range(len(pieces.texts))], 0.0)
    model = dataclasses.replace(pieces, scores=scores, kind="unigram")
    number, lost = {t: i for i, t in enumerate(model.texts) if t}, scores.min() - 10
    for text in ("there is a thing", "aaaa bbbb", "中x国"):
        whole = match.SPACE + text.replace(" ", match.SPACE)
        best = [0.0] + [-np.inf] * len(whole)
        for end in range(1, len(whole) + 1):
            for start in range(max(0, end - 16), end):
                piece = whole[start:end]
                gain = scores[number[piece]] if piece in number else lost if end - start == 1 else -np.inf
                best[end] = max(best[end], best[start] + gain)
        encoder = match.Encoder(model)
        ids, _ = encoder.encode([text])
        byte_ids = set(model.byte_ids)
        total = sum(scores[i] for i in ids if i not in byte_ids) + lost * sum(c not in number for c in whole)
        assert total == pytest.approx(best[-1]) and encoder.decode(ids) == text


def test_a_small_index_gives_the_same_ids(pieces, monkeypatch):
    texts = [r[1] for r in messy_rows()[:6]]
    whole = split(*match.Encoder(pieces).encode(texts))
    monkeypatch.setattr(match, "INDEXED", 16)
    encoder = match.Encoder(pieces)
    encoder.pool.most = 5
    assert [split(*encoder.encode([t]))[0] for t in texts] == whole


def test_messy_documents(messy, none, pieces, library):
    found = match.decode(match.encode(messy, pieces), pieces)
    assert found.count() == messy.count()
    for r in found.collect():
        assert r["decoded"] == r["text"]
        assert r["ids"] is None if r["text"] is None else np.frombuffer(r["ids"], "<i4").tolist() == library.encode(r["text"])
    assert match.decode(match.encode(none, pieces), pieces).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text("abther▁é中", min_size=1, max_size=120))
def test_long_segments_as_short_ones(pieces, text):
    encoder = match.Encoder(pieces)
    table = encoder._edges(np.frombuffer(text.encode("utf-32-le"), np.uint32), np.array([len(text)]))
    whole = match._merged(table, pieces.scores.tolist())
    abreast = match.ABREAST
    try:
        match.ABREAST = 1000
        side = match._relax_merges(table, np.array([len(text)]), pieces.scores)
    finally:
        match.ABREAST = abreast
    assert whole[0].tolist() == side[0].tolist() and whole[1].tolist() == side[1].tolist()


def test_a_hundred_thousand_letters_without_a_blank(pieces, library):
    rng = np.random.default_rng(3)
    text = "".join(rng.choice(list("etaoinshrdlu"), 100_000))
    encoder = match.Encoder(pieces)
    start = time.process_time()
    ids, _ = encoder.encode([text])
    assert time.process_time() - start < 5
    assert ids.tolist() == library.encode(text) and encoder.decode(ids.astype(np.int64)) == text
