"""Append-only feeds as a stream: ids are written once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradeloom.operators.pick import latest_by
from tradeloom.operators.upsert import ARRIVAL
from tradeloom.sources.tables import KeyedTable
from tradeloom.streaming.landing import log_load, observed


def append_new(table: KeyedTable, batch: DataFrame) -> None:
    """Add the ids the table does not have; the first row of an id stays.

    The table is partitioned by id range, so only the keys of ranges that the
    batch reaches are read, and only new rows are written.
    """
    arrival = [c for c in ARRIVAL if c in batch.columns]
    kept = [c for c in batch.columns if c not in arrival]
    if arrival:
        rows = latest_by(batch, table.keys, [-F.col(c) for c in arrival], keep=kept).select(*kept)
    else:
        rows = batch.dropDuplicates(table.keys)

    def resolve(old: DataFrame, new: DataFrame) -> DataFrame:
        return new.join(old.select(*table.keys), table.keys, "left_anti").select(*old.columns)

    table.apply(rows, resolve)


def stream_append(
    rows: DataFrame, table: KeyedTable, checkpoint: str, run_id: str | None = None, loads: str | None = None
) -> StreamingQuery:
    """Append a stream of rows; a batch delivered twice adds nothing.

    Ids that earlier batches and runs landed are met in the table, so no state
    grows with the stream. ``loads`` is a folder for the load summary of each
    batch (the rows have ``updated_at`` then), under the batch's number.
    """

    def write(batch: DataFrame, number: int) -> None:
        seen = Observation()
        append_new(table, observed(batch, seen) if loads else batch)
        if loads:
            log_load(rows.sparkSession, seen, run_id, f"{loads}/batch={number}")

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
