"""Exact top-k by inner product with the no-random-access algorithm.

Vectors are dealt to blocks. In a block every component has its own list of vectors, sorted by
that component. A query reads each list from the end that its sign prefers, a stretch of every
list at a time and each list in order. What it has read gives every vector a lower and an upper
bound of its score. Components not yet read are at most the last value read in their list and at
least the list's other end; and their share of the score is at most the length of the query's
unread part times the vector's, which is known from the vector's whole length (kept beside the
lists) and what was read of it. Vectors whose upper bound is below the k-th lower bound are
outsiders and are not looked at again. A query stops reading when few candidates are left; their
scores are resolved. One that reads its lists to the end has the scores as the sums of what it read.

Vectors that are NULL or hold NULL or non-finite components take no part; shorter vectors count
as padded with zeros. Rows are told apart by a number of their own: of rows with one id each is a
candidate, also for the others, and each asks if its id does. Rows without an id are candidates;
of equal scores the smaller id is first and rows without one are last. Scores beyond 64 bits are
cut to the largest or smallest long.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.common import bounded_batches
from tradeloom.session import written

#: Vectors of a block, queries that a block meets in one task, and queries that read side by side.
ROWS, QUERIES, ABREAST = 4096, 16_384, 256
#: Shares of the lists after which bounds are compared; candidates, as a multiple of k, that are resolved.
DEPTHS, FEW = (0.6, 0.7, 0.8, 0.9, 1.0), 8
LONG = (1 << 63) - 1
#: Room that rounding gets in bounds that are not whole numbers.
SLACK = 1e-9


class Lists:
    """A block's vectors as one sorted list per component."""

    def __init__(self, vectors: np.ndarray):
        self.x = vectors
        self.n, dims = vectors.shape
        order = np.argsort(-vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(vectors, order, axis=0)
        self.place = np.empty(order.shape, np.int32)
        np.put_along_axis(self.place, order, np.arange(self.n, dtype=np.int32)[:, None], axis=0)
        self.square = (vectors * vectors).sum(axis=1)
        #: Queries by the depth at which they stopped.
        self.stops: dict[float, int] = {}

    def _ends(self, to: int) -> tuple[np.ndarray, np.ndarray]:
        return self.sorted[to - 1], self.sorted[self.n - to]

    def first(self, queries: np.ndarray, to: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of all vectors for many queries after ``to`` entries of each list."""
        p, m = np.maximum(queries, 0).T, np.minimum(queries, 0).T
        top, end = (self.place < to).astype(float), (self.place >= self.n - to).astype(float)
        read_top, read_end = top * self.x, end * self.x
        known = read_top @ p + read_end @ m
        query_left = (queries * queries).sum(axis=1) - top @ (p * p) - end @ (m * m)
        vector_left = self.square[:, None] - (read_top * read_top) @ (p > 0) - (read_end * read_end) @ (m < 0)
        apart = _apart(query_left, vector_left, known)
        last_top, last_end = self._ends(to)
        high, low = self.sorted[0], self.sorted[-1]
        upper = known + (last_top @ p + last_end @ m) - (top * last_top) @ p - (end * last_end) @ m
        lower = known + (low @ p + high @ m) - (top * low) @ p - (end * high) @ m
        return np.maximum(lower, known - apart), np.minimum(upper, known + apart)

    def further(self, rows: np.ndarray, query: np.ndarray, to: int) -> tuple[np.ndarray, np.ndarray]:
        """The same for one query and the candidates that it has left."""
        prefers_top, x = query >= 0, self.x[rows]
        place = np.where(prefers_top, self.place[rows], self.n - 1 - self.place[rows])
        read = place < to
        seen = np.where(read, x, 0)
        known = seen @ query
        apart = _apart(~read @ (query * query), self.square[rows] - (seen * seen).sum(axis=1), known)
        last_top, last_end = self._ends(to)
        most, least = np.where(prefers_top, last_top, last_end) * query, np.where(prefers_top, self.sorted[-1], self.sorted[0]) * query
        return np.maximum(known + ~read @ least, known - apart), np.minimum(known + ~read @ most, known + apart)

    def candidates(self, query: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
        """What is left of ``rows`` when reading stops."""
        stop = DEPTHS[0]
        for depth in DEPTHS[1:]:
            if len(rows) <= FEW * k:
                break
            stop = depth
            lower, upper = self.further(rows, query, int(self.n * depth))
            rows = rows[upper >= np.partition(lower, len(lower) - k)[len(lower) - k]]
        self.stops[stop] = self.stops.get(stop, 0) + 1
        return rows


def _apart(query_left: np.ndarray, vector_left: np.ndarray, known: np.ndarray) -> np.ndarray:
    """How far a score may be from what is known of it, by the lengths of the unread parts."""
    return np.sqrt(np.maximum(query_left, 0) * np.maximum(vector_left, 0)) * (1 + SLACK) + SLACK * (1 + np.abs(known))


def nra(vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int, lists: Lists | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the places and scores of its k best vectors; the row that it is (``own``) takes no part."""
    n, found = len(vectors), []
    if not n:
        return [(np.zeros(0, np.int64), np.zeros(0)) for _ in own]
    lists = lists or Lists(vectors)
    for at in range(0, len(queries), ABREAST):
        asked, selves = queries[at : at + ABREAST], own[at : at + ABREAST]
        other = rows[:, None] != selves[None, :]
        if n > FEW * k:
            lower, upper = lists.first(asked, int(n * DEPTHS[0]))
            may = other & (upper >= np.partition(np.where(other, lower, -np.inf), n - k, axis=0)[n - k])
        else:
            may = other
        for column, query in enumerate(asked):
            left = lists.candidates(query, np.flatnonzero(may[:, column]), k)
            scores = vectors[left] @ query
            best = np.lexsort((ids[left], -scores))[:k]
            found.append((left[best], scores[best]))
    return found


def _matrix(values: pd.Series) -> np.ndarray:
    """The whole numbers floor(256 x), one vector a row, shorter ones filled up with zeros."""
    rows = [np.floor(256 * np.asarray(v, np.float64)) for v in values]
    wide = max(map(len, rows), default=0)
    grid = np.zeros((len(rows), wide))
    for i, r in enumerate(rows):
        grid[i, : len(r)] = r
    return grid


def _padded(a: np.ndarray, wide: int) -> np.ndarray:
    return np.pad(a, ((0, 0), (0, wide - a.shape[1])))


def search(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` of each query's k best vectors among all others."""
    bounded_batches(vectors.sparkSession)
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    clean = vectors.select("vec_id", "embedding").filter(F.col("embedding").isNotNull() & sound)
    # Long numbers with NULLs among them would be rounded in pandas.
    named = [F.coalesce(F.col("vec_id").cast("long"), F.lit(LONG)).alias("id"), F.col("vec_id").isNull().alias("nameless")]
    clean = clean.select(*named, "embedding", F.coalesce(is_query, F.lit(False)).alias("asks"), F.monotonically_increasing_id().alias("row"))
    clean = written(clean, "vectors")
    count, asked = clean.agg(F.count("*"), F.count_if("asks")).first()
    blocks, runs = max(1, -(-count // ROWS)), max(1, -(-asked // QUERIES))
    block, run = F.pmod(F.xxhash64("row"), F.lit(blocks)), F.pmod(F.xxhash64("row", F.lit(1)), F.lit(runs))
    columns = ["id", "nameless", "row", "embedding"]
    held = clean.select(*columns, F.lit(False).alias("asks"), block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run"))
    asking = clean.filter("asks").select(*columns, "asks", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), run.alias("run"))

    def best(pdf: pd.DataFrame) -> pd.DataFrame:
        asks = pdf["asks"].to_numpy(bool)
        ids, rows, nameless = (pdf[c].to_numpy() for c in ("id", "row", "nameless"))
        x, q = _matrix(pdf["embedding"][~asks]), _matrix(pdf["embedding"][asks])
        wide = max(x.shape[1], q.shape[1])
        x, q = _padded(x, wide), _padded(q, wide)
        if wide * np.abs(x).max(initial=0) * np.abs(q).max(initial=0) >= 2.0**52:
            found = _exact(x, ids[~asks], rows[~asks], q, rows[asks], k)
        else:
            found = nra(x, ids[~asks], rows[~asks], q, rows[asks], k)
        places = np.concatenate([np.zeros(0, np.int64), *(f[0] for f in found)])
        times = [len(f[0]) for f in found]
        return pd.DataFrame(
            {
                "query": np.repeat(rows[asks], times),
                "query_id": np.repeat(ids[asks], times),
                "id": ids[~asks][places],
                "nameless": nameless[~asks][places],
                "score": np.concatenate([np.zeros(0, np.int64), *(f[1] for f in found)]).astype(np.int64),
            }
        )

    near = held.unionByName(asking).groupBy("block", "run").applyInPandas(best, "query long, query_id long, id long, nameless boolean, score long")
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "nameless", "id")))
    named = F.when(~F.col("nameless"), F.col("id")).alias("vec_id")
    return ranked.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), named, "score")


def _exact(x: np.ndarray, ids: np.ndarray, rows: np.ndarray, q: np.ndarray, own: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """With numbers too large for exact floats: whole sums in Python integers, one query at a time."""
    values = [[int(v) for v in r] for r in x]
    found = []
    for asked, self_ in zip(q, own, strict=True):
        asked = [int(v) for v in asked]
        scored = [(-max(-LONG - 1, min(LONG, sum(a * b for a, b in zip(v, asked, strict=True)))), i, at) for at, (v, i) in enumerate(zip(values, ids.tolist(), strict=True)) if rows[at] != self_]
        best = sorted(scored)[:k]
        found.append((np.array([at for _, _, at in best], np.int64), np.array([-s for s, _, _ in best], np.int64)))
    return found
