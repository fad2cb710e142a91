"""Whitening of embeddings; the components come from QDWH spectral divide and conquer.

Sums and the centred covariance are gathered by Spark from all vectors; what the driver gets is one
sum per dimension and one number per pair of dimensions. There the covariance is taken apart: the
orthogonal polar factor of the covariance less a shift has an eigenvalue of 1 for every component
above the shift and -1 for every one below, so half of its sum with the identity projects on an
invariant subspace. Subspace and complement are split in the same way until single components are
left. The first of them are broadcast and whiten all vectors.

Vectors that are NULL or hold NULL or non-finite entries are dropped. Entries are cut to a size of
2**30. Shorter vectors count as filled up with zeros. Repeated and NULL ids are rows as any other.
Components without variance can't be scaled to one and are left out, so that vectors which are all
the same, no vectors, or vectors without entries give no rows. Deviations beyond a long are the
largest long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import bounded_batches
from tradeloom.session import written

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Largest size of an entry, and variances, as a share of all, that count as none.
LARGEST, NONE = float(1 << 30), 1e-12
LONG = (1 << 63) - 1
#: Smallest singular value, as a share of the norm, that the polar iteration lifts to one.
_LEAST = 1e-17


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by dynamically weighted Halley steps on QR factors."""
    n = len(a)
    norm = np.abs(a).sum(axis=0).max()
    if norm == 0:
        return np.eye(n)
    x, low = a / norm, _LEAST
    for _ in range(20):
        square = low * low
        d = np.cbrt(4 * (1 - square) / square**2)
        h = np.sqrt(1 + d) + np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * np.sqrt(1 + d))) / 2
        b = (h - 1) ** 2 / 4
        c = h + b - 1
        q = np.linalg.qr(np.concatenate([np.sqrt(c) * x, np.eye(n)]))[0]
        last, x = x, b / c * x + (h - b / c) / np.sqrt(c) * (q[:n] @ q[n:].T)
        x = (x + x.T) / 2
        low = min(1.0, low * (h + b * square) / (1 + c * square))
        if 1 - low < 1e-15 and np.abs(x - last).max() < 1e-12:
            break
    return x


def _subspaces(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of two complementary invariant subspaces, the one with larger values first."""
    n = len(a)
    own, rng = np.diag(a), np.random.default_rng(n)
    low, high = own.min(), own.max()
    best = None
    # Around the mean there are values on both sides, unless all are the same.
    for shift in [np.median(own), own.mean(), *(own.mean() + (high - low) * rng.uniform(-0.5, 0.5, 8))]:
        projector = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2
        k = round(float(np.trace(projector)))
        if not 0 < k < n:
            continue
        first = np.linalg.qr(projector @ rng.standard_normal((n, k)))[0]
        basis = np.linalg.qr(projector @ first, mode="complete")[0]
        left = np.abs(basis[:, k:].T @ a @ basis[:, :k]).max()
        if best is None or left < best[0]:
            best = left, basis[:, :k], basis[:, k:]
        if left <= 4 * n * np.finfo(float).eps * np.abs(a).max():
            break
    return best and best[1:]


def spectrum(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a symmetric matrix, falling, and their unit vectors in columns."""
    values, vectors, parts = [np.zeros(0)], [np.zeros((len(a), 0))], [np.eye(len(a))]
    small = np.finfo(float).eps * np.abs(a).max(initial=0)
    while parts:
        basis = parts.pop()
        part = basis.T @ a @ basis
        part = (part + part.T) / 2
        rest = np.abs(part - np.diag(np.diag(part))).max(initial=0)
        split = _subspaces(part) if rest > small else None
        if split is None:
            values.append(np.diag(part))
            vectors.append(basis)
        else:
            parts += [basis @ s for s in split]
    values, vectors = np.concatenate(values), np.concatenate(vectors, axis=1)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def _grid(column: pa.Array, wide: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers of a batch, one vector a row, shorter ones filled up, and their lengths."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    wide = lengths.max(initial=0) if wide is None else wide
    grid = np.full((len(lengths), wide), SHIFT, np.int64)
    grid[np.arange(wide) < lengths[:, None]] = flat
    return grid, lengths


def _sums(sound: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and the sum of every dimension."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grid, lengths = _grid(batch.column(0))
            at = np.arange(grid.shape[1])
            held = (at < lengths[:, None]).sum(axis=0)
            sums = [pa.array(x, pa.int64()) for x in (at, held, grid.sum(axis=0) - (len(grid) - held) * SHIFT)]
            yield pa.RecordBatch.from_arrays(sums, names=["at", "held", "sum"])

    per = sound.select("x").mapInArrow(summed, "at long, held long, sum long")
    rows = per.groupBy("at").agg(F.sum("held").alias("held"), F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum")).orderBy("at").collect()
    n = sound.count()
    return n, [int(r["sum"]) + (n - r["held"]) * SHIFT for r in rows]


def _covariance(sound: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    wide, mean = len(sums), np.array([s / n for s in sums])

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((wide, wide))
        for batch in batches:
            centred = _grid(batch.column(0), wide)[0] - mean
            total += centred.T @ centred
        a, b = np.triu_indices(wide)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(total[a, b])], names=["a", "b", "v"])

    rows = sound.select("x").mapInArrow(products, "a long, b long, v double").groupBy("a", "b").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((wide, wide))
    for r in rows:
        out[r["a"], r["b"]] = out[r["b"], r["a"]] = r["v"] / n
    return out


def _identity_error(z: DataFrame, n: int, k: int) -> float:
    """The largest entry of the covariance of ``z`` less the identity."""
    means = z.agg(*[F.avg(F.col("z")[i]) for i in range(k)]).first()
    apart = [F.col("z")[i] - F.lit(means[i]) for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = z.agg(*[F.sum(apart[i] * apart[j]) for i, j in pairs]).first()
    return max(abs(found[at] / n - (i == j)) for at, (i, j) in enumerate(pairs))


def _entries(name: str) -> Column:
    cut = lambda c: F.greatest(F.least(c.cast("double"), F.lit(LARGEST)), F.lit(-LARGEST))
    return F.transform(name, lambda c: F.floor(cut(c) * SCALE) + SHIFT)


def whiten(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` of each sound vector and component."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    sound = vectors.select("vec_id", "embedding").filter(F.col("embedding").isNotNull() & finite).select("vec_id", _entries("embedding").alias("x"))
    none = spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    n, sums = _sums(sound)
    if not n or not sums:
        return none
    covariance = _covariance(sound, n, sums)
    values, axes = spectrum(covariance)
    trace = float(np.trace(covariance))
    k = min(most, int((values > NONE * max(trace, 1e-300)).sum())) if trace > 0 else 0
    if not k:
        return none
    wide, mean = len(sums), np.array([s / n for s in sums])
    shared = spark.sparkContext.broadcast(axes[:, :k] / np.sqrt(values[:k]))

    @F.pandas_udf("deviation long, z array<double>")
    def projected(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for xs in batches:
            grid = np.full((len(xs), wide), SHIFT, np.int64)
            for row, x in zip(grid, xs, strict=True):
                row[: len(x)] = x
            most_apart = max((max(abs(n * int(hi) - s), abs(n * int(lo) - s)) for hi, lo, s in zip(grid.max(axis=0), grid.min(axis=0), sums, strict=True)), default=0)
            kind = np.int64 if wide * most_apart**2 <= LONG else object
            apart = grid.astype(kind) * n - np.array(sums, kind)
            deviation = np.minimum((apart * apart).sum(axis=1), LONG).astype(np.int64)
            yield pd.DataFrame({"deviation": deviation, "z": list((grid - mean) @ shared.value)})

    z = written(sound.select("vec_id", projected("x").alias("w")).select("vec_id", "w.*"), "whitened")
    error = _identity_error(z, n, k)
    explained = F.array(*[F.lit(float(v / trace)) for v in values[:k]])
    return z.select("vec_id", "deviation", F.posexplode("z").alias("nth", "whitened")).select(
        "vec_id",
        (F.col("nth") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained[F.col("nth")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )
