"""Incremental read windows, watermarks and high ids.

The state table has one row per feed, so it is rewritten as a whole.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.values import days_before

#: State of this many feeds at most is broadcast.
FEEDS_AT_MOST = 1000

# How far below the watermark an incremental read starts, the
# shop's time zone, and the columns of the state table.
READ_BUFFER_DAYS = 7
SHOP_TIME_ZONE = "Asia/Ho_Chi_Minh"
STATE_SCHEMA = (
    "domain string, last_updated_at timestamp, last_run_id string, updated_at timestamp, last_high_id bigint"
)


def shop_time(c: Column, zone: str = SHOP_TIME_ZONE) -> Column:
    """A wall-clock time of the shop as an instant."""
    return F.to_utc_timestamp(c, zone)


def window_floor(watermark: Column | None, since: Column | None, mode: str, incremental: bool = True) -> Column | None:
    """Start of a read: an explicit ``since`` as is, else watermark minus the buffer, else none."""
    if mode not in ("full", "incremental"):
        raise ValueError(f"unknown mode: {mode!r}")
    if since is not None:
        return since
    if mode == "full" or not incremental or watermark is None:
        return None
    return days_before(watermark, READ_BUFFER_DAYS)


def read_window(
    df: DataFrame,
    watermark: Column | None = None,
    since: Column | None = None,
    until: Column | None = None,
    mode: str = "incremental",
    incremental: bool = True,
    column: str = "updated_at",
) -> DataFrame:
    """Rows of the window, both ends included. A NULL watermark sets no floor."""
    floor = window_floor(watermark, since, mode, incremental)
    if floor is not None:
        df = df.filter(floor.isNull() | (F.col(column) >= floor))
    if until is not None:
        df = df.filter(F.col(column) <= until)
    return df


def _per_feed(marks: DataFrame) -> DataFrame:
    """Marks to be joined to rows: broadcast if there are as few as there are feeds.

    Spark takes a table that was aggregated from a large source for a large one, and
    would send all rows to as many tasks as there are feeds.
    """
    few = marks.limit(FEEDS_AT_MOST + 1).count() <= FEEDS_AT_MOST
    return F.broadcast(marks) if few else marks


def read_window_by_state(df: DataFrame, state: DataFrame, column: str = "updated_at") -> DataFrame:
    """Incremental window of several feeds at once, each from its own watermark."""
    marks = _per_feed(state.select("domain", F.col("last_updated_at").alias("_mark")))
    joined = df.join(marks, "domain", "left")
    return read_window(joined, watermark=F.col("_mark"), column=column).drop("_mark")


def advance_watermarks(state: DataFrame, loads: DataFrame, now: Column) -> DataFrame:
    """``loads(domain, max_updated_at, run_id)`` folded in; watermarks never go back.

    Loads without rows have no timestamp and change nothing.
    """
    seen = loads.filter("max_updated_at IS NOT NULL")
    touched = F.col("max_updated_at").isNotNull()
    return state.join(seen, "domain", "full_outer").select(
        "domain",
        F.greatest("last_updated_at", "max_updated_at").alias("last_updated_at"),
        F.when(touched, F.col("run_id")).otherwise(F.col("last_run_id")).alias("last_run_id"),
        F.when(touched, now).otherwise(F.col("updated_at")).alias("updated_at"),
        "last_high_id",
    )


def advance_high_ids(state: DataFrame, loads: DataFrame, now: Column) -> DataFrame:
    """``loads(domain, max_id, run_id)`` folded in; a missing high id counts as 0.

    A feed that is new to the table gets ``now`` as its timestamp.
    """
    touched = F.col("max_id").isNotNull()
    high = F.greatest(F.coalesce("last_high_id", F.lit(0)), F.col("max_id"))
    return state.join(loads.filter("max_id IS NOT NULL"), "domain", "full_outer").select(
        "domain",
        F.when(touched, F.coalesce("last_updated_at", now)).otherwise(F.col("last_updated_at")).alias("last_updated_at"),
        F.when(touched, F.col("run_id")).otherwise(F.col("last_run_id")).alias("last_run_id"),
        F.when(touched, now).otherwise(F.col("updated_at")).alias("updated_at"),
        F.when(touched, high).otherwise(F.col("last_high_id")).alias("last_high_id"),
    )


def above_high_id(df: DataFrame, state: DataFrame, id: str = "id") -> DataFrame:
    """Rows of append-only feeds that are above the feed's high id."""
    marks = _per_feed(state.select("domain", F.coalesce("last_high_id", F.lit(0)).alias("_high")))
    joined = df.join(marks, "domain", "left")
    return joined.filter(F.col(id) > F.coalesce("_high", F.lit(0))).drop("_high")


def as_shop_instant(value: datetime | None, zone: str = SHOP_TIME_ZONE) -> Column | None:
    """A user's bound: naive times are shop time, aware ones are taken as they are."""
    if value is None:
        return None
    if value.tzinfo is not None:
        return F.lit(value.isoformat()).cast("timestamp")
    return F.to_timestamp(F.lit(f"{value.isoformat(sep=' ')} {zone}"))
