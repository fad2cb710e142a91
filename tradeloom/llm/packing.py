"""Conflict-constrained best-fit packing of documents into sequences.

Documents are dealt by a hash to shards of a bounded number of tokens. In a shard they are
placed longest first. Open bins are ordered by residual room and carry two bitmaps, of sources
and of duplicate clusters in the bin. From the tightest bin with room the search goes on to its
successors until one has neither the document's source nor its cluster; if there is none, a new
bin is opened.

A document longer than a bin is cut into pieces without loss: whole bins of its own first, then
a rest that is packed like a document. Documents without tokens (NULL or blank text) take no
room and get a bin like the others. A NULL source or cluster is in conflict with nothing. Ties
go to the smaller id, then piece; a row that is listed twice is packed twice, never in one bin.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import bounded_batches
from tradeloom.session import written

CAPACITY = 2048
#: Tokens of a shard, about; a shard is packed by one task.
SHARD_TOKENS = 1 << 20


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int) -> list[int]:
    """Bin of each item, in the given order. Sources and clusters are small numbers, -1 for none."""
    residuals: list[tuple[int, int]] = []
    source_bits: list[int] = []
    cluster_bits: list[int] = []
    placed = []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        s, c = (1 << source if source >= 0 else 0), (1 << cluster if cluster >= 0 else 0)
        at = bisect_left(residuals, (size, -1))
        while at < len(residuals) and (source_bits[residuals[at][1]] & s or cluster_bits[residuals[at][1]] & c):
            at += 1
        if at < len(residuals):
            room, chosen = residuals.pop(at)
        else:
            room, chosen = capacity, len(source_bits)
            source_bits.append(0)
            cluster_bits.append(0)
        source_bits[chosen] |= s
        cluster_bits[chosen] |= c
        insort(residuals, (room - size, chosen))
        placed.append(chosen)
    return placed


def _numbers(values: pd.Series, repeated_only: bool = False) -> list[int]:
    """Small numbers for the values; -1 for NULL and, if asked, for values that occur once."""
    codes, found = pd.factorize(values)
    if repeated_only and len(found):
        often = np.bincount(codes[codes >= 0], minlength=len(found)) > 1
        codes = np.where((codes >= 0) & often[codes], (np.cumsum(often) - 1)[codes], -1)
    return codes.tolist()


def items(docs: DataFrame) -> DataFrame:
    """Rows to pack from a table of documents: a token is a word, a cluster is a set of equal texts."""
    blank = F.length(F.trim(F.coalesce("text", F.lit("")))) == 0
    return docs.select("doc_id", "source", F.when(~blank, F.xxhash64("text")).alias("cluster"), F.coalesce(F.regexp_count("text", F.lit(r"\S+")), F.lit(0)).alias("tokens"))


def pack(rows: DataFrame, capacity: int = CAPACITY, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per piece: doc_id, piece, start, tokens, shard, bin, offset.

    ``rows`` has doc_id, source, cluster and tokens. ``start`` counts from the document's first
    token, ``offset`` from the bin's first place.
    """
    bounded_batches(rows.sparkSession)
    rows = written(rows.select("doc_id", "source", "cluster", F.col("tokens").cast("long").alias("tokens")), "items")
    total, count = rows.agg(F.sum("tokens"), F.count("*")).first()
    # Documents without tokens count as well, so that no shard gets too many of them.
    shards = max(1, -(-((total or 0) + 16 * count) // shard_tokens))
    last = F.greatest(F.ceil(F.col("tokens") / capacity).cast("long"), F.lit(1)) - 1
    pieces = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    start = F.col("piece") * capacity
    pieces = pieces.select("doc_id", "source", F.when(F.col("tokens") > capacity, F.coalesce("cluster", F.xxhash64("doc_id"))).otherwise(F.col("cluster")).alias("cluster"), "piece", start.alias("start"), F.least(F.col("tokens") - start, F.lit(capacity).cast("long")).alias("tokens"))
    shard = F.pmod(F.xxhash64("doc_id", "piece", "cluster"), F.lit(shards)).alias("shard")
    # Long numbers with NULLs among them would be rounded in pandas.
    plain = [F.coalesce("doc_id", F.lit(0)).cast("long").alias("doc_id"), F.col("doc_id").isNull().alias("nameless"), F.col("cluster").cast("string").alias("cluster")]
    dealt = pieces.select(*plain, "source", "piece", "start", "tokens", shard)

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["tokens", "nameless", "doc_id", "piece", "cluster", "source"], ascending=[False, False, True, True, True, True], kind="stable", na_position="first")
        bins = np.array(best_fit(pdf["tokens"].tolist(), _numbers(pdf["source"]), _numbers(pdf["cluster"], True), capacity), np.int64)
        sizes = pdf["tokens"].to_numpy(np.int64)
        order = np.argsort(bins, kind="stable")
        ends = np.cumsum(sizes[order])
        starts = np.flatnonzero(np.diff(bins[order], prepend=-1))
        before = np.repeat((ends - sizes[order])[starts], np.diff(starts, append=len(order)))
        offset = np.empty(len(pdf), np.int64)
        offset[order] = ends - sizes[order] - before
        return pdf.assign(bin=bins, offset=offset)[["doc_id", "nameless", "piece", "start", "tokens", "shard", "bin", "offset"]]

    placed = dealt.groupBy("shard").applyInPandas(packed, "doc_id long, nameless boolean, piece long, start long, tokens long, shard long, bin long, offset long")
    return placed.withColumn("doc_id", F.when(~F.col("nameless"), F.col("doc_id"))).drop("nameless")
