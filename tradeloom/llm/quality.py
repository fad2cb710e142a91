"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

Every document becomes one sparse vector: its words hashed into ``word_slots`` slots
(damped counts, unit length), a block of structure statistics and a block of metadata
(the declared length). The score is

    sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2))

so that all pairwise interactions cost time linear in the number of slots in use.

NULL and empty texts have no words and are scored from the other blocks; a NULL declared
length has a slot of its own. Without labelled rows the score is 0.5 everywhere, with one
class it is the smoothed share of that class. Rows with equal text and length score the same.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import bounded_batches, by_bytes, free, id_bucket, raw_text, sample

WORD_SLOTS = 1 << 13
#: Labelled rows that the model is fitted to, at most; dealt by a hash of the id.
FIT_ROWS = 4000
FACTORS, STEPS, BATCH, RATE, DECAY = 8, 600, 64, 0.05, 1e-5
STATISTICS = 12
LENGTH_SLOTS = 24
#: Words whose slots a task remembers, and bytes of text that are scored at once: a vector takes many times the room of its text.
_CACHED, SLICE = 1 << 15, 1 << 18


@dataclass(frozen=True)
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    word_slots: int


class _Slots(dict):
    """Word to slot; remembers what it has hashed."""

    def __init__(self, n: int):
        super().__init__()
        self.n = n

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED:
            self.clear()
        slot = self[word] = crc32(word) % self.n
        return slot


def _kinds() -> np.ndarray:
    """For every byte value: letter, capital, digit, white space, line end, other ASCII sign, non-ASCII."""
    kinds = np.zeros((256, 7), np.float64)
    for b in range(256):
        c = chr(b)
        kinds[b] = [b < 128 and c.isalpha(), "A" <= c <= "Z", b < 128 and c.isdigit(), c in " \t\r\f\v", b == 10, b < 128 and c.isprintable() and not c.isalnum() and c != " ", b > 127]
    return kinds


_KINDS = _kinds()


def _structure(text: bytes, words: list[bytes], distinct: int) -> list[float]:
    n, m = len(text), len(words)
    if not n:
        return [1.0] + [0.0] * (STATISTICS - 1)
    share = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _KINDS / n
    repeats = sum(map(bytes.__eq__, words, words[1:])) / max(m - 1, 1)
    return [0.0, *share, distinct / max(m, 1), repeats, min((n - m) / max(m, 1) / 10, 3.0), np.log1p(m) / 10]


def vectors(texts: list[bytes], lengths: np.ndarray, slots: _Slots) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots, values and where each document starts, for one batch."""
    ids: list[np.ndarray] = []
    values: list[np.ndarray] = []
    starts = np.zeros(len(texts), np.int64)
    at, block = 0, np.arange(STATISTICS) + slots.n
    for k, text in enumerate(texts):
        words = text.split()
        counts = Counter(words)
        own = np.fromiter(map(slots.__getitem__, counts), np.int64, len(counts))
        damped = np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))
        if len(damped):
            damped /= np.sqrt(damped @ damped)
        bucket = 0 if np.isnan(lengths[k]) else 1 + int(min(LENGTH_SLOTS - 2, np.log2(1 + max(lengths[k], 0))))
        ids += [own, block, np.array([slots.n + STATISTICS + bucket])]
        values += [damped, np.array(_structure(text, words, len(counts))), np.ones(1)]
        starts[k] = at
        at += len(own) + STATISTICS + 1
    return np.concatenate(ids), np.concatenate(values), starts


def scores(model: Machine, ids: np.ndarray, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    vx = model.factors[ids] * values[:, None]
    sums, squares = np.add.reduceat(vx, starts), np.add.reduceat(vx * vx, starts)
    linear = np.add.reduceat(model.linear[ids] * values, starts)
    logit = model.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1)
    return 1 / (1 + np.exp(-np.clip(logit, -35, 35)))


def text_scores(model: Machine, texts: list[bytes], lengths: np.ndarray, slots: _Slots) -> np.ndarray:
    """The score of each text; only the vectors of a slice are held at once."""
    parts = [scores(model, *vectors(texts[a:b], lengths[a:b], slots)) for a, b in by_bytes(texts, SLICE)]
    return np.concatenate([np.zeros(0), *parts])


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], word_slots: int = WORD_SLOTS, seed: int = 7) -> Machine:
    """Mini-batch AdaGrad on the log loss; rows are (label, slots, values). The number of steps is fixed."""
    size = word_slots + STATISTICS + LENGTH_SLOTS
    rng = np.random.default_rng(seed)
    w, v = np.zeros(size), rng.normal(0, 0.05, (size, FACTORS))
    labels = np.array([r[0] for r in rows], np.float64)
    share = (labels.sum() + 1) / (len(rows) + 2)
    b = float(np.log(share / (1 - share)))
    if len(set(labels)) < 2:
        return Machine(b, w, np.zeros_like(v), word_slots)
    gw, gv, gb = np.full(size, 1e-2), np.full((size, FACTORS), 1e-2), 1e-2
    for _ in range(STEPS):
        picked = rng.integers(0, len(rows), BATCH)
        ids, x = np.concatenate([rows[i][1] for i in picked]), np.concatenate([rows[i][2] for i in picked])
        lengths = np.array([len(rows[i][1]) for i in picked])
        starts = np.cumsum(lengths) - lengths
        owner = np.repeat(np.arange(BATCH), lengths)
        vx = v[ids] * x[:, None]
        sums = np.add.reduceat(vx, starts)
        logit = b + np.add.reduceat(w[ids] * x, starts) + 0.5 * (sums * sums - np.add.reduceat(vx * vx, starts)).sum(axis=1)
        error = (1 / (1 + np.exp(-np.clip(logit, -35, 35))) - labels[picked]) / BATCH
        ex = error[owner] * x
        used, where = np.unique(ids, return_inverse=True)
        dw = np.bincount(where, ex, len(used)) + DECAY * w[used]
        each = ex[:, None] * (sums[owner] - vx)
        dv = np.stack([np.bincount(where, each[:, f], len(used)) for f in range(FACTORS)], axis=1) + DECAY * v[used]
        gw[used] += dw * dw
        gv[used] += dv * dv
        gb += error.sum() ** 2
        w[used] -= RATE * dw / np.sqrt(gw[used])
        v[used] -= RATE * dv / np.sqrt(gv[used])
        b -= RATE * error.sum() / np.sqrt(gb)
    return Machine(b, w, v, word_slots)


def fit(docs: DataFrame, labels: DataFrame, held_out_of: int = 5, fit_rows: int = FIT_ROWS) -> Machine:
    """Fit on at most ``fit_rows`` labelled rows outside the held-out part.

    The rows are those with the smallest hash of the id, so a rerun fits the same model. Only
    their vectors, each at most as long as there are slots, reach the driver.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    known = labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("_label")).filter(F.col("_label").isin(0, 1) & (id_bucket("_id", held_out_of) != 0))
    picked = sample(known, fit_rows, known.count(), ["_id"], ["_id", "_label"])
    inputs = docs.select(F.col("doc_id").alias("_id"), raw_text("text").alias("text"), F.col("n_chars").cast("double").alias("n"))

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slots = _Slots(WORD_SLOTS)
        for pdf in batches:
            if len(pdf):
                ids, x, starts = vectors(list(pdf["text"]), pdf["n"].to_numpy(np.float64), slots)
                cut = starts[1:]
                yield pd.DataFrame({"id": pdf["_id"], "label": pdf["_label"], "ids": np.split(ids.astype(np.int32), cut), "x": np.split(x.astype(np.float32), cut)})

    rows = inputs.join(F.broadcast(picked), "_id").mapInPandas(featurise, "id long, label int, ids array<int>, x array<float>").toPandas()
    rows = rows.sort_values(["id", "label"], kind="stable")
    return train([(int(y), np.asarray(i, np.int64), np.asarray(x, np.float64)) for y, i, x in zip(rows["label"], rows["ids"], rows["x"], strict=True)])


def score(docs: DataFrame, model: Machine, into: str = "score") -> DataFrame:
    """``docs`` with a column of scores; a column of that name is replaced, all others stay."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        machine = shared.value
        slots = _Slots(machine.word_slots)
        for texts, lengths in batches:
            yield pd.Series(text_scores(machine, list(texts), lengths.to_numpy(np.float64), slots))

    return docs.withColumn(into, scored(raw_text("text"), F.col("n_chars").cast("double")))


def good(docs: DataFrame, model: Machine, threshold: float = 0.3) -> DataFrame:
    """The documents whose score reaches the threshold, with their own columns."""
    own = free(docs, "_quality")
    return score(docs, model, own).filter(F.col(own) >= threshold).drop(own)
