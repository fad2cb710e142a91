"""Run log, its archive, and the status of the feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.values import days_before

# Columns of the run log, length of a stored error, archive age.
RUN_LOG_SCHEMA = (
    "run_id string, domain string, mode string, started_at timestamp, ended_at timestamp, "
    "rows_ingested bigint, status string, error_message string, triggered_by string"
)
MAX_ERROR_CHARS = 1000
ARCHIVE_AFTER_DAYS = 90
_LATEST = ["status", "mode", "started_at", "ended_at", "rows_ingested", "error_message"]


def start_runs(starts: DataFrame, now: Column) -> DataFrame:
    """``starts(run_id, domain, mode, triggered_by)`` as running log rows."""
    return starts.select(
        "run_id", "domain", "mode", now.alias("started_at"), F.lit(None).cast("timestamp").alias("ended_at"),
        F.lit(None).cast("bigint").alias("rows_ingested"), F.lit("running").alias("status"),
        F.lit(None).cast("string").alias("error_message"), "triggered_by",
    )


def close_runs(log: DataFrame, ends: DataFrame, now: Column | None = None) -> DataFrame:
    """Apply ``ends(run_id, rows, outcome, error[, at])``; unknown runs are ignored.

    An empty error is stored as none, a long one is cut.
    """
    at = F.col("at") if "at" in ends.columns else now
    closing = ends.select(
        "run_id",
        F.struct(
            at.alias("at"), "rows", "outcome", F.left(F.nullif("error", F.lit("")), F.lit(MAX_ERROR_CHARS)).alias("error")
        ).alias("end"),
    )
    closed = F.col("end").isNotNull()

    def updated(column: str, field: str) -> Column:
        return F.when(closed, F.col(f"end.{field}")).otherwise(F.col(column)).alias(column)

    return log.join(closing, "run_id", "left").select(
        "run_id", "domain", "mode", "started_at",
        updated("ended_at", "at"), updated("rows_ingested", "rows"), updated("status", "outcome"),
        updated("error_message", "error"), "triggered_by",
    )


def latest_runs(log: DataFrame, n: int = 10, order: Sequence[str] = ("run_id",)) -> DataFrame:
    """The newest ``n`` runs; ``order`` breaks ties."""
    return log.orderBy(F.col("started_at").desc_nulls_first(), *order).limit(n)


def run_durations(log: DataFrame, n: int = 12) -> DataFrame:
    """Seconds taken by the newest runs; NULL while a run has not ended."""
    took = F.timestamp_diff("MICROSECOND", F.col("started_at"), F.col("ended_at")) / F.lit(1e6)
    return latest_runs(log, n).select("run_id", "domain", "started_at", took.alias("seconds"))


def status(state: DataFrame, log: DataFrame) -> DataFrame:
    """Watermark and newest run of every feed that has a watermark."""
    order = F.struct(F.col("started_at").isNull(), "started_at", "run_id")
    newest = log.groupBy("domain").agg(F.max_by(F.struct(*_LATEST), order).alias("run"))
    return (
        state.join(newest, "domain", "left")
        .select("domain", "last_updated_at", *[F.col(f"run.{c}").alias(c) for c in _LATEST])
        .orderBy("domain")
    )


def history(log: DataFrame, archive: DataFrame) -> DataFrame:
    return log.unionByName(archive)


def archive_split(
    log: DataFrame, archive: DataFrame, as_of: Column, days: int = ARCHIVE_AFTER_DAYS
) -> tuple[DataFrame, DataFrame]:
    """Hot log and archive after moving old runs; runs without a start stay hot."""
    old = F.coalesce(F.col("started_at") < days_before(as_of, days), F.lit(False))
    return log.filter(~old), archive.unionByName(log.filter(old))


def kind_histogram(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), F.col(column).asc_nulls_first())
