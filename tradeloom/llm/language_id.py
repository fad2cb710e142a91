"""Language ID: a bidirectional gated recurrent network over the bytes of a text.

A text is cut into windows of ``window`` bytes that cover all of it. One network reads a
window forwards, one backwards, each from an empty state; both states at a byte give the
label probabilities of that position, and a document's probabilities are the mean over all
its positions. Training is backpropagation through time in numpy on a bounded sample of
windows, spread over whole texts.

NULL texts and texts without a letter get ``und`` with score 0; so does every text if no
labelled row was there to learn from. Equal texts get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import bounded_batches, by_bytes, free, raw_text, sample, spans

WINDOW, HIDDEN = 96, 6
#: Labelled documents and windows of each that the network is fitted to, at most.
FIT_DOCS, FIT_WINDOWS = 2500, 4
STEPS, BATCH, RATE = 260, 160, 0.02
#: Windows that are read side by side.
LANES = 2048
UNKNOWN = "und"


@dataclass(frozen=True)
class Network:
    labels: list[str]
    #: Per direction: byte inputs, recurrent weights and candidate offsets of the three gates.
    directions: list[dict[str, np.ndarray]]
    out: np.ndarray
    offset: np.ndarray


def windows(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts: bytes (padded with 0), bytes in use, number of the text."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    counts = -(-lengths // size)
    owner = np.repeat(np.arange(len(texts)), counts)
    joined = np.frombuffer(b"".join(texts) + bytes(size), np.uint8)
    first = np.repeat(np.cumsum(lengths) - lengths, counts)
    nth = spans(np.zeros(len(texts), np.int64), counts)
    used = np.minimum(size, np.repeat(lengths, counts) - nth * size)
    grid = joined[(first + nth * size)[:, None] + np.arange(size)]
    return np.where(np.arange(size) < used[:, None], grid, 0), used, owner


def _steps(d: dict[str, np.ndarray], bytes_at: np.ndarray, keep: np.ndarray | None, reverse: bool) -> np.ndarray:
    """States of one direction, (window, hidden, lanes). ``keep`` empties the state where a window has no byte."""
    size, lanes = bytes_at.shape
    hidden, half = d["uz"].shape[0], np.float32(0.5)
    # sigmoid(a) = (tanh(a / 2) + 1) / 2: the halves go into the weights.
    inputs = np.concatenate([d["ez"] * half, d["er"] * half, d["en"]], axis=1)
    recurrent = np.ascontiguousarray(np.concatenate([d["uz"], d["ur"], d["un"]], axis=1).T * half)
    offset = (d["bn"] * half)[:, None]
    states = np.empty((size, hidden, lanes), np.float32)
    gates, rows = np.empty((3 * hidden, lanes), np.float32), np.empty((lanes, 3 * hidden), np.float32)
    z, r, n, zr = gates[:hidden], gates[hidden : 2 * hidden], gates[2 * hidden :], gates[: 2 * hidden]
    h = np.zeros((hidden, lanes), np.float32)
    for t in range(size - 1, -1, -1) if reverse else range(size):
        np.take(inputs, bytes_at[t], axis=0, out=rows, mode="clip")
        np.matmul(recurrent, h, out=gates)
        zr += rows.T[: 2 * hidden]
        np.tanh(zr, out=zr)
        zr += 1
        n += offset
        n *= r
        n += rows.T[2 * hidden :]
        np.tanh(n, out=n)
        z *= half
        out = states[t]
        np.subtract(h, n, out=out)
        out *= z
        out += n
        if keep is not None:
            out *= keep[t]
        h = out
    return states


def position_probabilities(net: Network, grid: np.ndarray, used: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """Label probabilities (window, labels, lanes) of every position, for runs of lanes; zero where a window has no byte."""
    hidden = net.directions[0]["uz"].shape[0]
    ahead_out, back_out = (np.ascontiguousarray(w.T) for w in (net.out[:hidden], net.out[hidden:]))
    for lo in range(0, len(grid), LANES):
        part, live = np.ascontiguousarray(grid[lo : lo + LANES].T).astype(np.intp), used[lo : lo + LANES]
        keep = (np.arange(len(part))[:, None] < live).astype(np.float32)
        p = np.matmul(ahead_out, _steps(net.directions[0], part, None, False))
        p += np.matmul(back_out, _steps(net.directions[1], part, keep, True))
        p += net.offset[:, None]
        np.exp(np.minimum(p, 60, out=p), out=p)
        p *= (keep / p.sum(axis=1))[:, None]
        yield lo, lo + part.shape[1], p


def document_probabilities(net: Network, texts: list[bytes]) -> np.ndarray:
    """Mean label probabilities of each text; zeros for an empty one."""
    out = np.zeros((len(texts), len(net.labels)))
    for a, b in by_bytes(texts, 4 * LANES * WINDOW):
        grid, used, owner = windows(texts[a:b], WINDOW)
        for lo, hi, p in position_probabilities(net, grid, used):
            per_window = p.sum(axis=0)
            for c in range(len(net.labels)):
                out[a:b, c] += np.bincount(owner[lo:hi], per_window[c], b - a)
    return out / np.maximum([len(t) for t in texts], 1)[:, None]


def label_positions(net: Network, text: bytes) -> np.ndarray:
    """The label number of every byte of one text."""
    found = np.zeros(len(text), np.int64)
    grid, used, _ = windows([text], WINDOW)
    for lo, hi, p in position_probabilities(net, grid, used):
        best = p.argmax(axis=1).T.reshape(-1)[: int(used[lo:hi].sum())]
        found[lo * WINDOW : lo * WINDOW + len(best)] = best
    return found


def _forward(d: dict[str, np.ndarray], x: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, list]:
    h, saved, states = np.zeros((x.shape[1], HIDDEN), np.float32), [], np.empty((len(x), x.shape[1], HIDDEN), np.float32)
    for t in range(len(x)):
        z = 1 / (1 + np.exp(-(h @ d["uz"] + d["ez"][x[t]])))
        r = 1 / (1 + np.exp(-(h @ d["ur"] + d["er"][x[t]])))
        g = h @ d["un"] + d["bn"]
        n = np.tanh(r * g + d["en"][x[t]])
        saved.append((h, z, r, g, n))
        h = states[t] = (n + z * (h - n)) * keep[t]
    return states, saved


def _backward(d: dict[str, np.ndarray], x: np.ndarray, keep: np.ndarray, saved: list, dstates: np.ndarray) -> dict[str, np.ndarray]:
    grads = {k: np.zeros_like(v) for k, v in d.items()}
    inputs = {k: np.empty_like(dstates) for k in ("ez", "er", "en")}
    dh = np.zeros_like(dstates[0])
    for t in range(len(x) - 1, -1, -1):
        h, z, r, g, n = saved[t]
        dh = (dh + dstates[t]) * keep[t]
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (h - n) * z * (1 - z)
        dr = dn * g * r * (1 - r)
        dg = dn * r
        inputs["ez"][t], inputs["er"][t], inputs["en"][t] = dz, dr, dn
        grads["uz"] += h.T @ dz
        grads["ur"] += h.T @ dr
        grads["un"] += h.T @ dg
        grads["bn"] += dg.sum(axis=0)
        dh = dh * z + dz @ d["uz"].T + dr @ d["ur"].T + dg @ d["un"].T
    flat = x.reshape(-1)
    for k, v in inputs.items():
        for j in range(HIDDEN):
            grads[k][:, j] = np.bincount(flat, v[:, :, j].reshape(-1), 256)
    return grads


def train(labels: list[str], grid: np.ndarray, used: np.ndarray, wanted: np.ndarray, seed: int = 11) -> Network:
    """Backpropagation through time with Adam; the number of steps is fixed."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
    one = lambda: {k: draw(256, HIDDEN, scale=0.3) for k in ("ez", "er", "en")} | {k: draw(HIDDEN, HIDDEN, scale=0.3) for k in ("uz", "ur", "un")} | {"bn": np.zeros(HIDDEN, np.float32)}
    both = [one(), one()]
    net = Network(labels, both, draw(2 * HIDDEN, len(labels), scale=0.2), np.zeros(len(labels), np.float32))
    if len(labels) < 2:
        return net
    weights = [*both[0].values(), *both[1].values(), net.out, net.offset]
    m, v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    size = grid.shape[1]
    for step in range(1, STEPS + 1):
        picked = rng.integers(0, len(grid), BATCH)
        x = grid[picked].T.astype(np.intp)
        keep = (np.arange(size)[:, None] < used[picked]).astype(np.float32)[:, :, None]
        ahead, kept_a = _forward(both[0], x, keep)
        back, kept_b = _forward(both[1], x[::-1], keep[::-1])
        states = np.concatenate([ahead, back[::-1]], axis=2)
        logits = states @ net.out + net.offset
        p = np.exp(logits - logits.max(axis=2, keepdims=True))
        p /= p.sum(axis=2, keepdims=True)
        p[:, np.arange(BATCH), wanted[picked]] -= 1
        error = p * keep / keep.sum()
        dout = states.reshape(-1, 2 * HIDDEN).T @ error.reshape(-1, len(labels))
        dstates = error @ net.out.T
        ga = _backward(both[0], x, keep, kept_a, np.ascontiguousarray(dstates[:, :, :HIDDEN]))
        gb = _backward(both[1], x[::-1], keep[::-1], kept_b, np.ascontiguousarray(dstates[::-1, :, HIDDEN:]))
        grads = [*ga.values(), *gb.values(), dout, error.sum(axis=(0, 1))]
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for i, (w, g) in enumerate(zip(weights, grads, strict=True)):
            g = g / max(1.0, norm)
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
            w -= (rate * m[i] / (1 - 0.9**step) / (np.sqrt(v[i] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def fit(docs: DataFrame, usable: Column, fit_docs: int = FIT_DOCS) -> Network:
    """Fit on at most ``fit_docs`` rows with text and lang for which ``usable`` holds.

    Rows and windows are dealt by hashes, so a rerun fits the same network. At most
    ``FIT_WINDOWS`` windows a row, from anywhere in its text, reach the driver.
    """
    known = docs.filter(usable & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    known = known.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"), F.octet_length("text").alias("_n"), raw_text("text").alias("_bytes"))
    seen = dict(known.groupBy("_lang").count().collect())
    labels = sorted(seen)
    last = F.greatest(F.col("_n") - WINDOW, F.lit(0)) + 1
    cuts = [F.substring(F.col("_bytes"), (F.pmod(F.xxhash64("_id", F.lit(k)), last) + 1).cast("int"), F.lit(WINDOW)) for k in range(FIT_WINDOWS)]
    rows = sample(known.select("_id", "_lang", F.array(*cuts).alias("cuts")), fit_docs, sum(seen.values()), ["_id"], ["_id", "_lang", "cuts"]).collect()
    rows.sort(key=lambda r: (str(r[0]), r[1], r[2]))
    number = {v: i for i, v in enumerate(labels)}
    texts = [bytes(c) for r in rows for c in r[2] if c]
    wanted = np.array([number[r[1]] for r in rows for c in r[2] if c], np.int64)
    if not texts:
        return Network([], [], np.zeros((0, 0)), np.zeros(0))
    grid, used, owner = windows(texts, WINDOW)
    return train(labels, grid, used, wanted[owner])


def identify(docs: DataFrame, net: Network, into: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with predicted label and its probability; columns of these names are replaced, all others stay."""
    spark = docs.sparkSession
    bounded_batches(spark)
    label, score = into
    if not net.labels:
        return docs.withColumns({label: F.lit(UNKNOWN), score: F.lit(0.0)})
    shared = spark.sparkContext.broadcast(net)

    @F.pandas_udf("label string, score double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for texts in batches:
            p = document_probabilities(model, list(texts))
            best = p.argmax(axis=1)
            yield pd.DataFrame({"label": np.array(model.labels, object)[best], "score": np.minimum(p[np.arange(len(p)), best], 1.0)})

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    own = free(docs, "_found")
    found = docs.withColumn(own, predicted(F.when(lettered, raw_text("text")).otherwise(F.lit(b""))))
    return found.withColumns({label: F.when(lettered, F.col(f"{own}.label")).otherwise(UNKNOWN), score: F.when(lettered, F.col(f"{own}.score")).otherwise(0.0)}).drop(own)


def recognised(docs: DataFrame, net: Network, least: float = 0.35) -> DataFrame:
    """The documents in a known language with at least this probability, with their own columns."""
    label, score = free(docs, "_lang_pred"), free(docs, "_lang_score")
    found = identify(docs, net, (label, score))
    return found.filter((F.col(label) != UNKNOWN) & (F.col(score) >= least)).drop(label, score)
