"""Items to rows of the raw tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.functions.values import blank_to_null, iso_timestamp

# The envelope columns of a raw table and of the snapshot table.
RAW_SCHEMA = "id bigint, payload string, updated_at timestamp, ingested_at timestamp, source_run_id string"
SNAPSHOT_SCHEMA = (
    "id string, location_id bigint, variant_id bigint, snapshot_date date, payload string, "
    "updated_at timestamp, ingested_at timestamp, source_run_id string"
)
RAW_COLUMNS = ["id", "payload", "updated_at", "ingested_at", "source_run_id"]
SNAPSHOT_COLUMNS = [
    "id", "location_id", "variant_id", "snapshot_date", "payload", "updated_at", "ingested_at", "source_run_id",
]


def scan(spark: SparkSession, path: str, schema: str = RAW_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def required(c: Column, what: str) -> Column:
    """The value, or an error where it is missing."""
    return F.when(c.isNull(), F.raise_error(F.lit(f"item without {what}"))).otherwise(c)


def raw_rows(
    items: DataFrame,
    run_id: str,
    ingested_at: Column | None = None,
    ts_fields: Sequence[str] = ("updated_at",),
    as_of: Column | None = None,
) -> DataFrame:
    """Shape items into raw rows; other columns (arrival order) are kept.

    ``updated_at`` is the first non-blank of ``ts_fields``, then ``as_of`` if
    given; an item without any of them is an error.
    """
    rest = [c for c in items.columns if c != "item"]
    schema = ", ".join(["id string", *[f"`{f}` string" for f in ts_fields]])
    head = F.from_json("item", schema, {"mode": "FAILFAST"})
    candidates = [iso_timestamp(blank_to_null(F.col(f"head.{f}"))) for f in ts_fields]
    stamp = F.coalesce(*candidates, *([as_of.cast("timestamp")] if as_of is not None else []))
    return items.select("*", head.alias("head")).select(
        required(F.col("head.id").cast("bigint"), "id").alias("id"),
        F.col("item").alias("payload"),
        required(stamp, "timestamp").alias("updated_at"),
        (ingested_at if ingested_at is not None else F.current_timestamp()).alias("ingested_at"),
        F.lit(run_id).alias("source_run_id"),
        *rest,
    )


def location_rows(items: DataFrame, run_id: str, as_of: Column, ingested_at: Column | None = None) -> DataFrame:
    """Locations may carry ``modified_on`` in place of ``updated_at``, or neither."""
    return raw_rows(items, run_id, ingested_at, ("updated_at", "modified_on"), as_of)


def snapshot_rows(
    items: DataFrame, run_id: str, snapshot_date: Column, updated_at: Column, ingested_at: Column | None = None
) -> DataFrame:
    """Inventory levels keyed ``location:variant:date``; the day is fixed per run."""
    rest = [c for c in items.columns if c != "item"]
    head = F.from_json("item", "loc_id string, variant_id string", {"mode": "FAILFAST"})
    location = required(F.col("head.loc_id").cast("bigint"), "location")
    variant = required(F.col("head.variant_id").cast("bigint"), "variant")
    day = snapshot_date.cast("date")
    return items.select("*", head.alias("head")).select(
        F.concat_ws(":", location, variant, day).alias("id"),
        location.alias("location_id"),
        variant.alias("variant_id"),
        day.alias("snapshot_date"),
        F.col("item").alias("payload"),
        updated_at.cast("timestamp").alias("updated_at"),
        (ingested_at if ingested_at is not None else F.current_timestamp()).alias("ingested_at"),
        F.lit(run_id).alias("source_run_id"),
        *rest,
    )
