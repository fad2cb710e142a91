"""Ranked lexical search as an exact inner-product search in buckets of vectors of like length.

A document is a sparse vector of impacts, one for every query term that it holds; an item is one of
weights. The vectors are put in order of length and written; a task reads them in buckets, longest
first. An item skips a bucket if its own length times the bucket's cannot reach the score of its
k-th best so far (Cauchy-Schwarz). In a bucket that it does not skip, a document must lie near
enough to the item's direction, which bounds each of its coordinates from both sides: the
item's heaviest terms are looked up in the bucket's lists and what lies outside the bounds is
left out. Survivors are scored in whole numbers. The longest vectors are searched first, and
the scores that they reach are where all other tasks begin.

Items are searched in blocks, every block against all documents. Documents without a term of any
item never come up. NULL and empty texts have no terms. Of equal scores the smaller id is first,
rows without an id come last; rows listed twice are ranked twice, and so are items.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import batched

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.common import bounded_batches, raw_text, spans
from tradeloom.session import stored, written

#: Items searched side by side, results of each, documents in a range of lengths, documents searched first (about).
ITEMS, BEST, RANGE, FIRST = 1024, 20, 16_384, 8192
#: Heaviest terms of an item whose coordinates are held against bounds; slack of bounds in floating point.
FOCUS, SLACK = 3, 1e-9
#: What separates terms is blanked, A-Z are lower-cased, all else stays, bytes beyond ASCII too.
_TERMS = bytes(b + 32 if chr(b) in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TERMS).split()


@dataclass(frozen=True)
class Query:
    """An item's weights: places in the vocabulary, whole numbers, and their length."""

    at: np.ndarray
    weight: np.ndarray
    length: float


def counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, number of terms, and which of the vocabulary's terms occur how often."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("n long, term array<int>, tf array<int>")
    def made(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        place = shared.value.get
        for texts in batches:
            n, term, tf = [], [], []
            for text in texts:
                own = terms(text)
                held = np.array([p for p in map(place, own) if p is not None], np.int32)
                which, often = np.unique(held, return_counts=True)
                n.append(len(own))
                term.append(which)
                tf.append(often.astype(np.int32))
            yield pd.DataFrame({"n": n, "term": term, "tf": tf})

    return docs.select("doc_id", made(raw_text("text")).alias("c")).select("doc_id", "c.*")


def vectors(rows: DataFrame, documents: int, length: int) -> DataFrame:
    """Impacts of the documents that hold a term, and the length of each vector."""
    m = f"(75 + (25 * cast(n as decimal(19,0)) * {documents}BD) div {length}BD)"
    held = rows.filter(F.size("term") > 0).withColumn("m", F.expr(m))
    impact = F.transform("tf", lambda t: F.call_function("div", F.lit(1_000_000_000) * t.cast("long"), F.lit(1000) * t.cast("long") + F.lit(12) * F.col("m")))
    squares = F.aggregate("impact", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return held.select("doc_id", "term", impact.alias("impact")).withColumn("norm", F.sqrt(squares))


class Bucket:
    """Vectors of like length, by row and by term."""

    def __init__(self, ids: np.ndarray, nameless: np.ndarray, norm: np.ndarray, sizes: np.ndarray, term: np.ndarray, impact: np.ndarray):
        self.ids, self.nameless, self.norm, self.sizes, self.term, self.impact = ids, nameless, norm, sizes, term, impact
        self.starts = np.cumsum(sizes) - sizes
        self.longest = norm.max(initial=0.0)
        by_term = np.argsort(term, kind="stable")
        self.listed, self.rows = by_term, np.repeat(np.arange(len(sizes)), sizes)[by_term]
        self.lists = term[by_term]

    def _list(self, term: int) -> slice:
        return slice(*np.searchsorted(self.lists, [term, term + 1]))

    def survivors(self, q: Query, bar: int) -> np.ndarray:
        """Rows whose score may be ``bar`` or more."""
        if bar > q.length * self.longest * (1 + SLACK):
            return np.zeros(0, np.int64)
        left = None
        cosine = min(1.0, max(0.0, bar) / (q.length * self.longest)) if self.longest else 0.0
        for nth in np.argsort(-q.weight, kind="stable")[:FOCUS]:
            own = q.weight[nth] / q.length
            apart = math.sqrt((1 - cosine * cosine) * max(0.0, 1 - own * own))
            least = own * cosine - apart - SLACK
            # The axis itself is near enough if the item leans to it that much.
            most = 1 + SLACK if own >= cosine else own * cosine + apart + SLACK
            if least <= 0:
                continue
            span = self._list(q.at[nth])
            rows = self.rows[span]
            coordinate = self.impact[self.listed[span]] / self.norm[rows]
            rows = rows[(coordinate >= least) & (coordinate <= most)]
            left = rows if left is None else np.intersect1d(left, rows, assume_unique=True)
        if left is None:
            return np.unique(np.concatenate([self.rows[self._list(t)] for t in q.at]))
        return left

    def scores(self, rows: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Exact scores of these rows; ``dense`` holds the item's weights by term."""
        sizes = self.sizes[rows]
        entries = spans(self.starts[rows], sizes)
        return np.add.reduceat(dense[self.term[entries]] * self.impact[entries], np.cumsum(sizes) - sizes) if len(rows) else np.zeros(0, np.int64)


class Best:
    """The k best of an item so far."""

    def __init__(self, k: int, bar: int):
        self.k, self.bar = k, max(1, bar)
        self.ids, self.nameless, self.scores = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, nameless: np.ndarray, scores: np.ndarray) -> None:
        ids, nameless, scores = np.concatenate([self.ids, ids]), np.concatenate([self.nameless, nameless]), np.concatenate([self.scores, scores])
        first = np.lexsort((ids, nameless, -scores))[: self.k]
        self.ids, self.nameless, self.scores = ids[first], nameless[first], scores[first]
        if len(first) == self.k:
            self.bar = max(self.bar, int(self.scores[-1]))


def _search(rows: DataFrame, queries: list[Query], bars: dict[int, int], wide: int, k: int) -> DataFrame:
    """``(item, doc_id, nameless, score)``: each task's best for every item, as far as they reach the item's bar."""
    shared = rows.sparkSession.sparkContext.broadcast((queries, bars))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, bars = shared.value
        best = [Best(k, bars.get(i, 1)) for i in range(len(queries))]
        dense = np.zeros(wide, np.int64)
        for batch in batches:
            ids, nameless, norm, term, impact = batch.columns
            bucket = Bucket(ids.to_numpy(), nameless.to_numpy(zero_copy_only=False), norm.to_numpy(), np.diff(term.offsets.to_numpy()).astype(np.int64), term.flatten().to_numpy(), impact.flatten().to_numpy())
            for q, found in zip(queries, best, strict=True):
                if not len(q.at):
                    continue
                rows = bucket.survivors(q, found.bar)
                if len(rows):
                    dense[q.at] = q.weight
                    scores = bucket.scores(rows, dense)
                    dense[q.at] = 0
                    good = scores >= found.bar
                    found.add(bucket.ids[rows[good]], bucket.nameless[rows[good]], scores[good])
        item = np.repeat(np.arange(len(best)), [len(b.ids) for b in best])
        columns = [np.concatenate([getattr(b, name) for b in best] or [np.zeros(0)]) for name in ("ids", "nameless", "scores")]
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.bool_()), pa.array(columns[2], pa.int64())], names=["item", "doc_id", "nameless", "score"])

    plain = rows.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("nameless"), "norm", "term", "impact")
    return plain.mapInArrow(searched, "item int, doc_id long, nameless boolean, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    by_item = Window.partitionBy("item").orderBy(F.desc("score"), "nameless", "doc_id")
    return found.withColumn("rank", F.row_number().over(by_item)).filter(F.col("rank") <= k)


def _block(docs: DataFrame, items: list[tuple[int | None, bytes]], k: int) -> DataFrame:
    """The ranked documents of one block of items: (item, rank, doc_id, nameless, score)."""
    spark = docs.sparkSession
    wanted = [Counter(terms(text)) for _, text in items]
    vocabulary = {t: at for at, t in enumerate(sorted(set().union(*wanted)))}
    with stored(counted(docs, vocabulary), "terms") as rows:
        documents, length = rows.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        held = rows.select(F.explode("term").alias("t")).groupBy("t").count().collect() if length else []
        weight = {r["t"]: math.floor(1000 * math.log((2 * documents + 2) / (2 * r["count"] + 1))) for r in held}
        queries = []
        for own in wanted:
            at = np.array(sorted(vocabulary[t] for t in own if weight.get(vocabulary[t])), np.int64)
            often = {vocabulary[t]: n for t, n in own.items()}
            w = np.array([weight[t] * often[t] for t in at.tolist()], np.int64)
            queries.append(Query(at, w, math.sqrt(float((w.astype(float) ** 2).sum()))))
        if not any(len(q.at) for q in queries):
            return spark.createDataFrame([], "item int, rank int, doc_id long, nameless boolean, score long")
        ranges = max(1, -(-documents // RANGE))
        # Equal lengths go on by a hash of the id, so that many copies don't meet in one range.
        order = [F.desc("norm"), F.xxhash64("doc_id")]
        by_length = vectors(rows, documents, length).repartitionByRange(ranges, *order).sortWithinPartitions(*order)
        with stored(by_length, "vectors") as held:
            share = min(1.0, FIRST / max(1, documents))
            cut = held.agg(F.percentile_approx("norm", 1 - share, 10_000)).first()[0]
            long = F.col("norm") >= F.lit(cut)
            first = written(_ranked(_search(held.filter(long), queries, {}, len(vocabulary), k), k), "first")
            bars = {r["item"]: r["bar"] for r in first.groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("bar")).filter(F.col("n") == k).collect()}
            # Vectors too short for every item aren't read at all.
            reach = min((bars.get(i, 0) / q.length for i, q in enumerate(queries) if len(q.at)), default=0.0) * (1 - SLACK)
            rest = _search(held.filter(~long & (F.col("norm") >= F.lit(reach))), queries, bars, len(vocabulary), k)
            return written(_ranked(first.drop("rank").unionByName(rest), k), "ranked")


def search(docs: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """``(item_id, rank, doc_id, score)`` of every item's k best documents with a score above 0."""
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = ((r["item_id"], bytes(r["text"])) for r in items.select("item_id", raw_text("text").alias("text")).toLocalIterator())
    found = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in batched(texts, ITEMS):
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], "item int, item_id long")
        ranked = _block(docs, list(block), k).join(F.broadcast(names), "item")
        doc = F.when(~F.col("nameless"), F.col("doc_id")).alias("doc_id")
        found = found.unionByName(ranked.select("item_id", "rank", doc, "score"))
    return found
