"""Landing writes: keyed, guarded by a timestamp, safe to replay."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.operators.pick import latest_by

ARRIVAL = ("file_time", "page", "position")


def _check_columns(df: DataFrame, columns: Sequence[str], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} has no column {missing}")


def last_arrivals(
    batch: DataFrame, keys: Sequence[str] = ("id",), ts: str = "updated_at", arrival: Sequence[str] = ARRIVAL
) -> DataFrame:
    """One row per key: the newest, and of equally new ones the last to arrive.

    Arrival columns the batch lacks are skipped.
    """
    _check_columns(batch, [*keys, ts], "batch")
    order = [F.col(ts), *[F.col(c) for c in arrival if c in batch.columns]]
    keep = [c for c in batch.columns if c not in arrival]
    return latest_by(batch, list(keys), order, keep=keep).select(*keep)


def guarded_upsert(
    existing: DataFrame,
    batch: DataFrame,
    keys: Sequence[str] = ("id",),
    ts: str = "updated_at",
    arrival: Sequence[str] = ARRIVAL,
    taken_only: bool = False,
) -> DataFrame:
    """Insert new keys; replace a stored row unless it is newer than the batch's.

    ``taken_only`` leaves out the rows that stay as they are. Both sides have one row per key when they meet, so no key is hot.
    """
    _check_columns(existing, [*keys, ts], "table")
    incoming = last_arrivals(batch, keys, ts, arrival)
    columns = existing.columns
    old = existing.select(*keys, F.struct(*columns).alias("_old"))
    new = incoming.select(*keys, F.struct(*columns).alias("_new"))
    takes_new = F.col("_new").isNotNull() & (
        F.col("_old").isNull() | (F.col(f"_new.{ts}") >= F.col(f"_old.{ts}"))
    )
    row = F.when(takes_new, F.col("_new")).otherwise(F.col("_old"))
    met = old.join(new, list(keys), "full_outer")
    return (
        (met.filter(takes_new) if taken_only else met)
        .select(row.alias("_row"))
        .select(*[F.col(f"_row.{c}").alias(c) for c in columns])
    )


def load_summary(batch: DataFrame, ts: str = "updated_at") -> DataFrame:
    """Rows submitted (not rows written) and the newest timestamp among them."""
    return batch.agg(F.count("*").alias("rows_total"), F.max(ts).alias("max_updated_at"))
