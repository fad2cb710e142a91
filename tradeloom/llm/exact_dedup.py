"""Exact dedup against immutable snapshots, screened by static binary fuse filters.

Rows arrive in batches. A batch is first grouped by digest on its own, so copies within it
meet before anything is looked up. Its distinct digests are screened by the filters of each
earlier snapshot, one filter per bucket of digests; only the positives are joined with that
snapshot's exact buckets, and rows whose digests meet are grouped by digest and bytes. Then
the batch is the next snapshot.

Of equal texts the row with the largest id stays; NULL text counts as empty. NULL ids lose
against any other; if a group has no other, ``keep_id`` is NULL and its rows count as kept. A
row that is listed again with the same id and text has the same mark; :func:`kept` leaves one.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm import fuse
from tradeloom.llm.common import bounded_batches, free, one_of_each, raw_text, sized
from tradeloom.session import written

#: Distinct digests in a filter, about.
BUCKET = 2048


def sha256(column: str) -> Column:
    return F.sha2(raw_text(column), 256)


def arrival(docs: DataFrame, batches: int) -> Column:
    """The batch of a row by its id: equal ranges in order of arrival; NULL ids come first."""
    low, high = docs.agg(F.min("doc_id").cast("double"), F.max("doc_id").cast("double")).first()
    if low is None or batches < 2:
        return F.lit(0)
    nth = F.floor((F.col("doc_id").cast("double") - low) * batches / max(high - low, 1.0))
    return F.coalesce(F.least(nth, F.lit(batches - 1)), F.lit(0)).cast("int")


def batch_groups(keyed: DataFrame) -> DataFrame:
    """One row per batch and digest: rows and largest id, combined before every shuffle."""
    return keyed.groupBy("batch", "digest").agg(F.count("*").alias("n"), F.max("id").alias("top"))


def build_filters(groups: DataFrame) -> DataFrame:
    """A filter per snapshot and bucket; ``groups`` has batch, bucket, key."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        made = fuse.build(np.unique(pdf["key"].to_numpy(np.int64)).view(np.uint64))
        return pd.DataFrame({"batch": [pdf["batch"].iloc[0]], "bucket": [pdf["bucket"].iloc[0]], "seed": [made.seed], "segment": [made.segment], "cells": [made.cells.tobytes()]})

    return groups.select("batch", "bucket", "key").groupBy("batch", "bucket").applyInPandas(build, "batch int, bucket long, seed int, segment int, cells binary")


def screen(incoming: DataFrame, filters: DataFrame) -> DataFrame:
    """Digests that a snapshot's filter can't rule out; ``incoming`` has snapshot, bucket, key, digest."""

    def held(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if right.empty or left.empty:
            return left[["snapshot", "digest"]].iloc[:0]
        row = right.iloc[0]
        made = fuse.Fuse(int(row["seed"]), int(row["segment"]), np.frombuffer(row["cells"], np.uint8))
        return left.loc[fuse.contains(made, left["key"].to_numpy(np.int64).view(np.uint64)), ["snapshot", "digest"]]

    snapshots = filters.withColumnRenamed("batch", "snapshot")
    return incoming.groupBy("snapshot", "bucket").cogroup(snapshots.groupBy("snapshot", "bucket")).applyInPandas(held, "snapshot int, digest string")


def repeated_digests(keyed: DataFrame, batches: int) -> DataFrame:
    """Digests of more than one row: groups of one batch, and positives found in a snapshot."""
    groups = batch_groups(keyed)
    total = keyed.select(F.approx_count_distinct("digest")).first()[0]
    buckets = max(1, -(-total // (BUCKET * batches)))
    groups = written(groups.withColumns({"key": F.xxhash64("digest"), "bucket": F.pmod(F.xxhash64("digest", F.lit(1)), F.lit(buckets))}), "groups")
    filters = written(build_filters(groups.filter(F.col("batch") < batches - 1)), "filters")
    incoming = groups.filter("batch > 0").select(F.explode(F.sequence(F.lit(0), F.col("batch") - 1)).alias("snapshot"), "bucket", "key", "digest")
    positive = screen(incoming, filters)
    exact = groups.select(F.col("batch").alias("snapshot"), "digest")
    confirmed = positive.join(exact, ["snapshot", "digest"]).select("digest")
    return written(confirmed.unionByName(groups.filter("n > 1").select("digest")).distinct(), "repeated")


def resolve(docs: DataFrame, batches: int = 3, digest: Callable[[str], Column] = sha256) -> DataFrame:
    """One row per row of ``docs``: id, digest, keep_id, group_size, kept."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").alias("id"), digest("text").alias("digest"), arrival(docs, batches).alias("batch"))
    keyed = written(rows, "digests")
    repeated = repeated_digests(keyed, batches)
    texts = docs.select(F.col("doc_id").alias("id"), digest("text").alias("digest"), raw_text("text").alias("bytes"))
    met = texts.join(sized(repeated, repeated.count(), 160), "digest", "left_semi")
    equal = written(met.groupBy("digest", "bytes").agg(F.count("*").alias("n"), F.max("id").alias("top")), "equal")
    # A digest with more than one text is split by the bytes themselves.
    split = equal.groupBy("digest").agg(F.count("*").alias("texts"), F.max("n").alias("n"), F.max("top").alias("top"))
    groups = written(split, "kept")
    whole, count = groups.filter("texts = 1").drop("texts"), groups.count()
    found = keyed.drop("batch").join(sized(whole, count, 160), "digest", "left")
    torn = groups.filter("texts > 1").select("digest")
    if clashes := torn.count():
        side = sized(torn, clashes, 160)
        found = found.join(side, "digest", "left_anti")
        own = texts.join(side, "digest", "left_semi").join(equal, ["digest", "bytes"]).drop("bytes")
        found = found.unionByName(own)
    alone = F.col("n").isNull()
    found = found.withColumns({"keep_id": F.when(alone, F.col("id")).otherwise(F.col("top")), "group_size": F.coalesce("n", F.lit(1))})
    return found.select("id", "digest", "keep_id", F.col("group_size").cast("long").alias("group_size"), F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"))


def kept(docs: DataFrame, batches: int = 3) -> DataFrame:
    """``docs`` with one row of every group of equal texts and all its columns."""
    marks = written(resolve(docs, batches), "marks")
    own, gone_id, gone_digest = (free(docs, n) for n in ("_digest", "_gone_id", "_gone_digest"))
    gone = marks.filter(~F.col("kept")).select(F.col("id").alias(gone_id), F.col("digest").alias(gone_digest)).distinct()
    gone = written(gone, "gone")
    same = [F.col("doc_id").eqNullSafe(F.col(gone_id)), F.col(own) == F.col(gone_digest)]
    stay = docs.withColumn(own, sha256("text")).join(sized(gone, gone.count(), 200), same, "left_anti")
    return one_of_each(stay, ["doc_id", own]).drop(own)
