"""Compare the size of a feed at its source with what was landed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.sources.domains import domain

# Fixed value: accepted relative difference.
TOLERANCE = 0.001


def table_counts(tables: Mapping[str, DataFrame], name: str) -> DataFrame:
    """One counted row per feed; an unknown feed is an error."""
    counts = None
    for feed, rows in tables.items():
        one = rows.agg(F.count("*").alias(name)).select(F.lit(domain(feed).name).alias("domain"), name)
        counts = one if counts is None else counts.unionByName(one)
    if counts is None:
        raise ValueError("no feeds to count")
    return counts


def count_drift(source: DataFrame, landed: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """``source(domain, source_count)`` against ``landed(domain, landed_count)``."""
    have = F.coalesce("landed_count", F.lit(0))
    ratio = F.abs(F.col("source_count") - have) / F.greatest(F.col("source_count"), F.lit(1))
    return source.join(landed, "domain", "left").select(
        "domain", "source_count", have.alias("landed_count"), ratio.alias("drift"),
        (ratio <= F.lit(tolerance)).alias("ok"),
    )
