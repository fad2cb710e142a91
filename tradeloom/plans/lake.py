"""Jobs a user runs: land feeds, check them, build the star schema.

A lake is a folder: ``raw/<feed>`` tables, ``meta/sync_state`` and
``meta/run_log`` (with an archive), and ``star/`` with what is built from them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import UTC, date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.functions.values import days_before
from tradeloom.operators import quality, reconcile, runlog, state
from tradeloom.operators.grid import id_batches, location_grid, nested_ids
from tradeloom.operators.upsert import load_summary
from tradeloom.plans.star import SNAPSHOT_LOOKBACK_DAYS, StarBuild, build
from tradeloom.session import folder_exists, stored
from tradeloom.sources.domains import DOMAINS, Domain, domain, split_table
from tradeloom.sources.pages import ingest
from tradeloom.sources.raw import RAW_SCHEMA, location_rows, raw_rows, snapshot_rows
from tradeloom.sources.commits import together
from tradeloom.sources.tables import KeyedTable
from tradeloom.streaming.landing import LOADS_SCHEMA, land_rows, stream_landing

SNAPSHOT_FEED = "inventory_locations"
#: The feed name of whole jobs in the run log, and the feeds a build can't do without.
WHOLE_JOB = "all"
CORE_FEEDS = ("orders", "customers", "products", "locations", "inventory_adjustments", "inventory_locations")


@dataclass
class Run:
    """One logged run; the snapshot day is fixed when it starts, in UTC."""

    id: str
    day: date
    rows: int = 0


class Lake:
    def __init__(self, spark: SparkSession, root: str, id_bucket: int = 10_000_000, keep_versions: int = 3):
        """``id_bucket``: ids per partition of a raw table or fact; ``keep_versions``: versions of a table that readers may still use."""
        self.spark = spark
        self.keep_versions = keep_versions
        self.root = root.rstrip("/")
        self.id_bucket = id_bucket

    # -- tables -----------------------------------------------------------

    def raw(self, feed: str) -> KeyedTable:
        schema, name = split_table(domain(feed).raw_table)
        partition = "snapshot_date" if feed == SNAPSHOT_FEED else f"id div {self.id_bucket}"
        return KeyedTable(self.spark, f"{self.root}/{schema}/{name}", ["id"], partition)

    def _meta(self, name: str, key: str) -> KeyedTable:
        return KeyedTable(self.spark, f"{self.root}/meta/{name}", [key])

    def _rows(self, table: KeyedTable, schema: str) -> DataFrame:
        rows = table.read()
        return self.spark.createDataFrame([], schema) if rows is None else rows

    def sync_state(self) -> DataFrame:
        return self._rows(self._meta("sync_state", "domain"), state.STATE_SCHEMA)

    def run_log(self) -> DataFrame:
        return self._rows(self._meta("run_log", "run_id"), runlog.RUN_LOG_SCHEMA)

    def run_log_archive(self) -> DataFrame:
        return self._rows(self._meta("run_log_archive", "run_id"), runlog.RUN_LOG_SCHEMA)

    # -- landing ----------------------------------------------------------

    def land(
        self,
        feed: str,
        pages: str,
        mode: str = "incremental",
        since: datetime | None = None,
        until: datetime | None = None,
        dry_run: bool = False,
        triggered_by: str = "manual",
        whole_files: bool = False,
    ) -> int:
        """Land saved pages of one feed; returns the number of rows submitted.

        Rows are written before the watermark moves, so a run that dies between
        the two is repaired by the next one: it reads the same rows again and
        the upsert finds them in place. A dry run writes rows but leaves the
        watermark alone.
        """
        spec = domain(feed)
        with self._logged(feed, mode, triggered_by) as run:
            shaped = self._shaped(spec, ingest(self.spark, pages, spec, whole_files), run)
            wanted = self._window(spec, shaped, mode, since, until)
            # Stored once: the upsert and the summary both read it, and the pages are parsed once.
            with stored(wanted, f"landing-{feed}") as rows:
                land_rows(self.raw(feed), rows)
                summary = load_summary(rows).first()
            if spec.incremental and not dry_run and summary["rows_total"]:
                self._advance(feed, summary["max_updated_at"], run.id)
            run.rows = summary["rows_total"]
        self.raw(feed).drop_superseded(self.keep_versions)
        return run.rows

    def land_all(self, pages: Mapping[str, str], **options) -> dict[str, int]:
        """Land several feeds, dimension feeds first; the first error stops."""
        for feed in pages:
            domain(feed)
        return {feed: self.land(feed, pages[feed], **options) for feed in DOMAINS if feed in pages}

    def stream(self, feed: str, pages: str, files_per_batch: int = 1000, whole_files: bool = False) -> None:
        """Land the page files not seen yet as a stream, then move the watermark.

        The stream's checkpoint lies in the lake. All documents of new files are
        landed, however late.
        """
        spec = domain(feed)
        loads = f"{self.root}/meta/streams/{feed}-loads"
        with self._logged(feed, "incremental", "stream") as run:
            job = stream_landing(
                self.spark, pages, self.raw(feed), spec, f"{self.root}/meta/streams/{feed}", run.id,
                shape=lambda items: self._shaped(spec, items, run),
                files_per_batch=files_per_batch, whole_files=whole_files, loads=loads,
            )
            job.awaitTermination()
            if not folder_exists(self.spark, loads):
                return
            # A run that died after its batches left summaries behind, which this run reports.
            done = self.run_log().filter("status = 'success'").select("run_id")
            mine = self.spark.read.schema(LOADS_SCHEMA).parquet(loads)
            if folder_exists(self.spark, f"{loads}-reported"):
                done = done.unionByName(self.spark.read.parquet(f"{loads}-reported"))
            mine = mine.join(done, "run_id", "left_anti")
            landed = mine.agg(F.sum("rows_total").alias("n"), F.max("max_updated_at").alias("newest")).first()
            run.rows = landed["n"] or 0
            if spec.incremental and run.rows:
                self._advance(feed, landed["newest"], run.id)
            others = mine.select("run_id").distinct().filter(F.col("run_id") != run.id)
            others.coalesce(1).write.mode("append").parquet(f"{loads}-reported")
        self.raw(feed).drop_superseded(self.keep_versions)

    def _shaped(self, spec: Domain, items: DataFrame, run: Run) -> DataFrame:
        now = F.current_timestamp()
        if spec.name == "locations":
            return location_rows(items, run.id, now)
        if spec.name == SNAPSHOT_FEED:
            return snapshot_rows(items, run.id, F.lit(run.day), now)
        return raw_rows(items, run.id)

    def _window(
        self, spec: Domain, rows: DataFrame, mode: str, since: datetime | None, until: datetime | None
    ) -> DataFrame:
        mark = self.sync_state().filter(F.col("domain") == spec.name).agg(F.max("last_updated_at").alias("mark"))
        return state.read_window(
            rows, mark.scalar(), state.as_shop_instant(since), state.as_shop_instant(until), mode, spec.incremental
        )

    def _advance(self, feed: str, newest: datetime, run_id: str) -> None:
        loads = self.spark.createDataFrame([(feed, newest, run_id)], "domain string, max_updated_at timestamp, run_id string")
        table = self._meta("sync_state", "domain")
        table.apply(loads, lambda old, new: state.advance_watermarks(old, new, F.current_timestamp()), state.STATE_SCHEMA)
        table.drop_superseded(self.keep_versions)

    @contextmanager
    def _logged(self, feed: str, mode: str, triggered_by: str) -> Iterator[Run]:
        """A run with its start and its end in the log. Each is one keyed change, so runs side by side lose no rows."""
        run, log = Run(str(uuid.uuid4()), datetime.now(UTC).date()), self._meta("run_log", "run_id")
        start = self.spark.createDataFrame(
            [(run.id, feed, mode, triggered_by)], "run_id string, domain string, mode string, triggered_by string"
        )
        log.apply(runlog.start_runs(start, F.current_timestamp()), lambda old, new: old.unionByName(new))
        try:
            yield run
        except Exception as error:
            self._end_run(log, run.id, 0, "failed", str(error))
            raise
        self._end_run(log, run.id, run.rows, "success", None)

    def _end_run(self, log: KeyedTable, run_id: str, rows: int, outcome: str, error: str | None) -> None:
        end = self.spark.createDataFrame(
            [(run_id, rows, outcome, error)], "run_id string, rows bigint, outcome string, error string"
        )
        log.apply(end, lambda old, new: runlog.close_runs(old, new, F.current_timestamp()))
        log.drop_superseded(self.keep_versions)

    # -- looking after it ---------------------------------------------------

    def status(self) -> DataFrame:
        return runlog.status(self.sync_state(), self.run_log())

    def archive_runs(self, as_of: Column) -> None:
        """Move old runs to the archive. Both tables change at once; runs that start meanwhile wait their turn."""
        log, archive = self._meta("run_log", "run_id"), self._meta("run_log_archive", "run_id")
        with together(self.spark, f"{self.root}/meta", [log, archive]):
            _, old = runlog.archive_split(self.run_log(), self.run_log_archive().limit(0), as_of)
            archive.apply(old, lambda known, moved: moved)
            log.apply(old.select("run_id"), lambda known, moved: known.limit(0), runlog.RUN_LOG_SCHEMA, deletes=True)

    def validate(self, source_counts: Mapping[str, int], tolerance: float = reconcile.TOLERANCE) -> DataFrame:
        """Compare counts reported by the source with the raw tables."""
        source = self.spark.createDataFrame(
            [(domain(feed).name, n) for feed, n in source_counts.items()], "domain string, source_count bigint"
        )
        nothing = self.spark.createDataFrame([], RAW_SCHEMA)
        tables = {domain(feed).name: self.raw(feed).read() for feed in source_counts}
        landed = reconcile.table_counts({f: nothing if t is None else t for f, t in tables.items()}, "landed_count")
        return reconcile.count_drift(source, landed, tolerance)

    def freshness(self, as_of: Column) -> DataFrame:
        """Age of the newest row of every feed against its limits; a feed that was never landed is an error."""
        never = self.spark.createDataFrame([(feed, None) for feed in DOMAINS], "source string, ingested_at timestamp")
        ages = never
        for feed in DOMAINS:
            rows = self.raw(feed).read()
            if rows is not None:
                one = rows.agg(F.max("ingested_at").alias("ingested_at"))
                ages = ages.unionByName(one.select(F.lit(feed).alias("source"), "ingested_at"))
        return quality.freshness(ages, as_of)

    def inventory_requests(self) -> DataFrame:
        """What to ask the stock feed for: each location with each batch of variant ids."""
        locations = self.raw("locations").read().select(F.col("id").alias("location_id"))
        ids = nested_ids(self.raw("products").read(), "variants", "variant_id")
        return location_grid(locations, id_batches(ids, "variant_id"))

    # -- building -----------------------------------------------------------

    def build_star(self, bounds: DataFrame, as_of: Column, holidays: DataFrame, **options) -> StarBuild:
        """Build or update the star schema from the raw tables."""
        # All is read as of one version of each table, which the build notes.
        snapshots = {feed: self.raw(feed).snapshot() for feed in DOMAINS}
        snapshots = {feed: held for feed, held in snapshots.items() if held is not None}
        landed = {feed: held.read() for feed, held in snapshots.items()}
        options["snapshots"] = {feed: snapshots[feed] for feed in ("orders", "inventory_adjustments") if feed in snapshots}
        if missing := [feed for feed in CORE_FEEDS if feed not in landed]:
            raise ValueError(f"feeds not landed yet: {missing}")
        root = f"{self.root}/star"
        if not options.get("full_refresh") and folder_exists(self.spark, f"{root}/fct_inventory_snapshot/manifests"):
            options["recent_levels"] = self._recent_levels(as_of)
        star = build(self.spark, landed, root, bounds, as_of, holidays, id_bucket=self.id_bucket, **options)
        star.drop_superseded(self.keep_versions)
        return star

    def _recent_levels(self, as_of: Column) -> DataFrame:
        """Stock levels of the days that a merge takes; older days' folders are not opened."""
        day = self.spark.range(1).select(days_before(as_of, SNAPSHOT_LOOKBACK_DAYS).cast("date").cast("string")).first()[0]
        return self.raw(SNAPSHOT_FEED).read(lambda part: part >= day)

    def run_all(
        self, pages: Mapping[str, str], bounds: DataFrame, as_of: Column, holidays: DataFrame,
        mode: str = "incremental", triggered_by: str = "cron", optional: Sequence[str] = (), **options,
    ) -> StarBuild:
        """The daily job: land the feeds in order, build, test, publish; one outcome row in the run log.

        Fails as a whole: a feed that can't be landed, a build error and a failed
        test of severity ``error`` all end the run as failed and are raised. What
        was built is published only after its tests, so a bad batch stays out of
        sight. ``optional`` names raw and staging tables of feeds the shop lacks.
        """
        with self._logged(WHOLE_JOB, mode, triggered_by) as run:
            run.rows = sum(self.land_all(pages, mode=mode, triggered_by=triggered_by).values())
            star = self.build_star(bounds, as_of, holidays, held=True, **options)
            try:
                quality.require_passed(star.check(), optional)
            except BaseException:
                star.discard()
                raise
            star.publish()
            star.drop_superseded(self.keep_versions)
        return star
