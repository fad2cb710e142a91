"""Keep one row per key.

Written as ``max_by`` aggregations, not ranked windows: each task first reduces
its own rows to one per key, so a key that holds a third of the table sends one
row per task through the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nulls_win(c: str) -> list[Column]:
    """Order part for "newest first, NULLs before all"."""
    return [F.col(c).isNull(), F.col(c)]


def nulls_lose(c: str) -> list[Column]:
    """Order part for "newest first, NULLs after all"."""
    return [F.col(c).isNotNull(), F.col(c)]


def latest_by(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], keep: Sequence[str] | None = None
) -> DataFrame:
    """The row with the greatest ``order`` for each value of ``keys``.

    NULL keys form one group, like in a partitioned window.
    """
    rest = [c for c in (keep or df.columns) if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    picked = df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    )
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def first_source(df: DataFrame, keys: Sequence[str], priority: str) -> DataFrame:
    """The row from the source with the lowest priority number."""
    return latest_by(df, keys, [-F.col(priority)])
