"""What several operators share: bounded batches, checked broadcasts, stable buckets, spans."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only if its counted rows take no more than this.
BROADCAST_BYTES = 16 << 20
#: Arrow batches to Python workers: at most so many bytes and rows.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Limit Arrow batches by bytes, so that very long texts don't meet in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def sized(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df`` marked for broadcast if ``rows`` of ``row_bytes`` fit the limit, else as it is."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def id_bucket(column: str, n: int) -> Column:
    """crc32 of an id written as text, modulo ``n``; NULL ids give NULL."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def free(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def sample(df: DataFrame, rows: int, known: int, keys: list[str], ties: list[str]) -> DataFrame:
    """The ``rows`` rows of ``df`` with the smallest hashes of ``keys``; ``known`` is its number of rows.

    A bound on the hash keeps out all but about four times as many rows before anything is
    sorted, so what reaches the driver does not grow with the table.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*keys))
    if known > 4 * rows:
        hashed = hashed.filter(F.col("_hash") <= -(1 << 63) + int((1 << 64) * (4 * rows / known)))
    return hashed.orderBy("_hash", *ties).limit(rows).drop("_hash")


def raw_text(column: str) -> Column:
    """UTF-8 bytes; NULL counts as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def by_bytes(texts: Sequence[bytes], limit: int) -> Iterator[tuple[int, int]]:
    """Slices of ``texts`` of about ``limit`` bytes, one text at least."""
    start = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= limit:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of every span, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def one_of_each(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with one row for every value of ``keys`` (NULL is a value).

    Only the keys are grouped; whole rows move only for keys that do occur more than once.
    """
    names = {k: free(df, f"_{k}_again") for k in keys}
    counts = df.groupBy(*[F.col(k).alias(r) for k, r in names.items()]).agg(F.count("*").alias(free(df, "_rows")))
    repeated = counts.filter(F.col(counts.columns[-1]) > 1).drop(counts.columns[-1])
    n = repeated.count()
    if not n:
        return df
    same = [F.col(k).eqNullSafe(F.col(r)) for k, r in names.items()]
    side = sized(repeated, n, 128)
    return df.join(side, same, "left_anti").unionByName(df.join(side, same, "left_semi").dropDuplicates(keys))
