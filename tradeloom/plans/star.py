"""The whole build: raw tables to dimensions, facts and test results."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.operators import dimensions, facts, intermediate, quality, staging
from tradeloom.operators.intermediate import Mentions
from tradeloom.operators.merge import merge_into, overlay, recent_days, since_target
from tradeloom.session import in_parallel, shuffles_freed
from tradeloom.sources.tables import KeyedTable, Snapshot

# Per table: its rows, and what stores them.
Writes = Mapping[str, tuple[DataFrame, Callable[[str, DataFrame], DataFrame]]]

SNAPSHOT_LOOKBACK_DAYS = 90
ORDER_LOOKBACK_DAYS = 30


@dataclass(frozen=True)
class FactSpec:
    """How a fact is merged: key, storage partition, and the rows a later run takes.

    ``like_orders``: made from the staged orders by narrow steps, and partitioned
    as they are.
    """

    keys: tuple[str, ...]
    partition: str
    column: str
    target_column: str
    lookback_days: int = 0
    append_new_columns: bool = True
    like_orders: bool = False


def fact_specs(bucket: int, order_bucket: int | None = None) -> dict[str, FactSpec]:
    """Ids grow over time, so a run's rows fall into few id ranges of ``bucket`` ids, order ids of ``order_bucket``."""
    orders = order_bucket or bucket
    return {
        "fct_orders": FactSpec(
            ("order_id",), f"order_id div {orders}", "order_updated_at", "order_updated_at", ORDER_LOOKBACK_DAYS,
            like_orders=True,
        ),
        # A line key belongs to one order, so the order id may partition it.
        "fct_order_lines": FactSpec(
            ("line_key",), f"order_id div {orders}", "created_at", "created_at", like_orders=True
        ),
        "fct_transactions": FactSpec(("transaction_id",), f"transaction_id div {bucket}", "created_at", "created_at"),
        "fct_refunds": FactSpec(("refund_id",), f"refund_id div {bucket}", "created_at", "created_at"),
        "fct_inventory_adjustments": FactSpec(
            ("adjustment_id",), f"adjustment_id div {bucket}", "adjusted_at", "adjusted_at", append_new_columns=False
        ),
        "fct_inventory_snapshot": FactSpec(
            ("location_id", "variant_id", "snapshot_date"), "snapshot_date", "snapshot_date", "snapshot_date",
            append_new_columns=False,
        ),
    }


@dataclass
class StarBuild:
    """One build into ``out_dir``; running it again merges into what is there.

    ``full_refresh`` starts over: all documents are parsed, all facts rebuilt.
    ``held`` keeps what is built out of sight until :meth:`publish`, so that it can
    be tested first; :meth:`discard` leaves the tables as they were.
    """

    spark: SparkSession
    raw: Mapping[str, DataFrame]
    out_dir: str
    bounds: DataFrame
    as_of: Column
    holidays: DataFrame
    id_bucket: int = 10_000_000
    threads: int = 4
    full_refresh: bool = False
    held: bool = False
    #: Stock levels of the days a later run takes; all of them if not given.
    recent_levels: DataFrame | None = None
    #: Ids per partition of what is partitioned by order, if these ids are spread in another way.
    order_bucket: int | None = None
    #: The raw tables ``orders`` and ``inventory_adjustments`` as they were read, which tell what is new.
    #: Without them stamps do for orders, and adjustments are staged in full.
    snapshots: Mapping[str, Snapshot] = field(default_factory=dict)
    #: Versions of a table that stay once it is stored anew, where nobody reads older ones; all if not given.
    keep_versions: int | None = None
    tables: dict[str, DataFrame] = field(default_factory=dict)
    _stored: dict[str, KeyedTable] = field(default_factory=dict)

    def run(self) -> None:
        """Stage, then dimensions and facts, which need only staging tables."""
        self._stage()
        transactions = staging.order_transactions(self.tables["stg_orders"])
        writes = {"stg_order_transactions": (transactions, self._kept)}
        writes.update({name: (rows, self._kept) for name, rows in self._dimensions().items()})
        writes.update({name: (rows, partial(self._merge_fact, make)) for name, (rows, make) in self._facts().items()})
        self.tables.update(self._each(writes))
        transactions = self.tables["stg_order_transactions"]
        methods = dimensions.dim_payment_methods(transactions)
        writes = {
            "dim_payment_methods": (methods, self._kept),
            "fct_transactions": (transactions, partial(self._merge_fact, facts.fct_transactions)),
        }
        self.tables.update(self._each(writes))

    # Orders are read by nine tables. They are parsed once and kept as nested
    # parquet, from which every reader takes only its columns. The other kept
    # staging tables have several readers too.
    def _stage(self) -> None:
        raw, t = self.raw, self.tables
        t.update(
            self._each(
                {
                    "stg_orders": (raw["orders"], self._parsed_orders),
                    "stg_inventory_adjustments": (raw["inventory_adjustments"], self._adjustments),
                }
            )
        )
        t["stg_order_refunds"] = staging.order_refunds(t["stg_orders"])
        t["stg_customers"] = staging.customers(raw["customers"])
        t["stg_products"] = staging.products(raw["products"])
        t["stg_variants"] = staging.variants(
            staging.products(raw["products"], keep=["product_id", "variants_json"])
        )
        t["stg_locations"] = staging.locations(raw["locations"])
        t["stg_inventory_locations"] = staging.inventory_levels(raw["inventory_locations"])
        for name, stage in (
            ("custom_collections", staging.collections),
            ("smart_collections", staging.collections),
            ("discounts", staging.discounts),
            ("promotions", staging.promotions),
        ):
            if name in raw:
                t[f"stg_{name}"] = stage(raw[name])

    def _parsed_orders(self, name: str, rows: DataFrame) -> DataFrame:
        """Parse the documents committed since the version that the last build read.

        The version is noted with what was parsed from it. Documents are replaced
        whole. The raw table is partitioned by the same ids, so a first build
        needs no shuffle.
        """
        table = self._table(name, ["order_id"], f"order_id div {self.order_bucket or self.id_bucket}")
        known = None if self.full_refresh else table.snapshot()
        source = self.snapshots.get("orders")
        read = known.notes.get("orders") if known and source else None
        if read is not None and read == source.version:
            return known.read()
        if read is not None:
            rows = source.changes(read)
        elif known:
            rows = rows.filter(F.col("ingested_at") >= known.read().agg(F.max("ingested_at").alias("newest")).scalar())
        parsed = staging.orders(rows, keep=[f.name for f in staging.ORDERS])
        notes = {"orders": source.version} if source else {}
        if known is None:
            table.replace(parsed, spread=source is None, notes=notes)
        else:
            table.apply(parsed, lambda old, new: overlay(old, new, table.keys), notes=notes)
        return self._settled(table)

    def _adjustments(self, name: str, rows: DataFrame) -> DataFrame:
        """Stage the stock corrections of the id ranges that changed since the last build."""
        source = self.snapshots.get("inventory_adjustments")
        if source is None:
            return self._kept(name, staging.inventory_adjustments(rows))
        part = F.expr(f"parent_adjustment_id div {self.id_bucket}")
        return self._by_range(name, source, staging.inventory_adjustments, part).drop("range")

    def _by_range(self, name: str, source: Snapshot, make: Callable[[DataFrame], DataFrame], part: Column | None = None) -> DataFrame:
        """``make`` of every partition of ``source`` apart; only of those that changed it is made anew.

        A partition is made anew as a whole, so what vanished from it is gone from
        the result too. ``part`` names a row's partition; ``make`` may give it as
        ``range`` itself. The version that was read is noted with the result.
        """
        table = self._table(name, ["range"], "range")
        known = None if self.full_refresh else table.snapshot()
        since = known.notes["source"] if known else 0
        stale = source.touched(since) | ((known.parts if known else set()) - source.parts)
        if known and not stale:
            return known.read()
        rows = make(source.read(sorted(source.touched(since))))
        if part is not None:
            rows = rows.withColumn("range", F.coalesce(part.cast("string"), F.lit("none")))
        if known:
            table.replace_parts(rows, sorted(stale), {"source": source.version})
        else:
            table.replace(rows, notes={"source": source.version})
        return self._settled(table)

    def _newest(self, name: str, mentions: Mentions, part: Column | None = None) -> DataFrame:
        """The mention that counts of every product or variant in a staging table, from picks that are kept by id range."""

        def picks(rows: DataFrame) -> DataFrame:
            seen = mentions.seen(rows)
            if part is not None:
                seen = seen.withColumn("range", F.coalesce(part.cast("string"), F.lit("none")))
            return mentions.newest(seen, ["range"])

        kept = self._by_range(f"seen_{mentions.key}_{name}", self._stored[name].snapshot(), picks)
        return mentions.result(mentions.newest(kept.drop("range")))

    def _seen(self) -> dict[str, DataFrame]:
        """Products and variants seen in orders and in stock corrections."""
        order_range = F.expr(f"order_id div {self.order_bucket or self.id_bucket}")
        jobs = {
            "ordered_products": partial(self._newest, "stg_orders", intermediate.ORDERED_PRODUCTS, order_range),
            "ordered_variants": partial(self._newest, "stg_orders", intermediate.ORDERED_VARIANTS, order_range),
        }
        adjustments = self.tables["stg_inventory_adjustments"]
        if "inventory_adjustments" in self.snapshots:
            jobs["adjusted_products"] = partial(self._newest, "stg_inventory_adjustments", intermediate.ADJUSTED_PRODUCTS)
            jobs["adjusted_variants"] = partial(self._newest, "stg_inventory_adjustments", intermediate.ADJUSTED_VARIANTS)
        found = in_parallel(self.spark, jobs, self.threads)
        plain = {
            "adjusted_products": intermediate.products_in_adjustments(adjustments),
            "adjusted_variants": intermediate.variants_in_adjustments(adjustments),
        }
        return plain | found

    def _dimensions(self) -> dict[str, DataFrame]:
        t = self.tables
        seen = self._seen()
        return {
            "dim_customers": dimensions.dim_customers(t["stg_customers"]),
            "dim_locations": dimensions.dim_locations(t["stg_locations"]),
            "dim_products": dimensions.dim_products(t["stg_products"], seen["ordered_products"], seen["adjusted_products"]),
            "dim_variants": dimensions.dim_variants(t["stg_variants"], seen["ordered_variants"], seen["adjusted_variants"]),
            "dim_date": dimensions.dim_date(self.bounds, self.holidays),
        }

    def _facts(self) -> dict[str, tuple[DataFrame, Callable[[DataFrame], DataFrame]]]:
        """The rows of each fact, and what makes the fact from them by narrow steps."""
        t = self.tables
        return {
            "fct_orders": (intermediate.order_net_revenue_in_document(t["stg_orders"]), facts.fct_orders),
            "fct_order_lines": (intermediate.order_lines(t["stg_orders"]), facts.fct_order_lines),
            "fct_refunds": (t["stg_order_refunds"], facts.fct_refunds),
            "fct_inventory_adjustments": (t["stg_inventory_adjustments"], facts.fct_inventory_adjustments),
            "fct_inventory_snapshot": (
                t["stg_inventory_locations"] if self.recent_levels is None else staging.inventory_levels(self.recent_levels),
                facts.fct_inventory_snapshot,
            ),
        }

    def _kept(self, name: str, rows: DataFrame) -> DataFrame:
        """Rebuild a table."""
        table = self._table(name, [])
        table.replace(rows)
        return self._settled(table)

    def _merge_fact(self, make: Callable[[DataFrame], DataFrame], name: str, staged: DataFrame) -> DataFrame:
        spec = fact_specs(self.id_bucket, self.order_bucket)[name]
        table = self._table(name, spec.keys, spec.partition)
        current = None if self.full_refresh else table.read()
        if current is None:
            # Hash keys don't compress and take most of a fact's room, so rows are dealt out before they get them.
            dealt = staged if spec.like_orders else table.dealt(staged)
            table.replace(make(dealt), spread=False)
        else:
            rows = incremental_rows(name, make(staged), current, spec, self.as_of)
            merge_into(table, rows, spec.append_new_columns)
        return self._settled(table)

    def _settled(self, table: KeyedTable) -> DataFrame:
        """What a build reads of a table that it has stored."""
        if self.keep_versions:
            table.drop_superseded(self.keep_versions)
        return table.read_held()

    def _table(self, name: str, keys: Sequence[str], partition: str | None = None) -> KeyedTable:
        table = self._stored[name] = KeyedTable(self.spark, f"{self.out_dir}/{name}", keys, partition, self.held)
        return table

    def publish(self) -> None:
        """Make a held build visible, dimensions before the facts that refer to them."""
        for name in sorted(self._stored):
            self._stored[name].publish()

    def discard(self) -> None:
        for table in self._stored.values():
            table.discard()

    def _each(self, writes: Writes) -> dict[str, DataFrame]:
        """Independent tables are submitted side by side; the first error stops the build."""
        return in_parallel(
            self.spark, {name: partial(write, name, rows) for name, (rows, write) in writes.items()}, self.threads
        )

    def drop_superseded(self, keep: int) -> None:
        """Free what the last ``keep`` versions of the stored tables don't show."""
        for table in self._stored.values():
            table.drop_superseded(keep)

    def check(self) -> DataFrame:
        """Results of all tests on the raw tables and on what was built."""
        checked = {**{f"raw_{n}": df for n, df in self.raw.items()}, **self.tables, "holidays": self.holidays}
        with shuffles_freed(self.spark):
            return quality.run_suite(checked, quality.RULES)


def incremental_rows(name: str, rows: DataFrame, current: DataFrame, spec: FactSpec, as_of: Column) -> DataFrame:
    if name == "fct_inventory_snapshot":
        return recent_days(rows, spec.column, as_of, SNAPSHOT_LOOKBACK_DAYS)
    return since_target(rows, spec.column, current, spec.target_column, spec.lookback_days)


def build(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    out_dir: str,
    bounds: DataFrame,
    as_of: Column,
    holidays: DataFrame,
    **options: int | bool,
) -> StarBuild:
    """Build or update the star schema below ``out_dir``."""
    star = StarBuild(spark, raw, out_dir, bounds, as_of, holidays, **options)
    try:
        star.run()
    except BaseException:
        star.discard()
        raise
    return star


def results_of(models: Iterable[str], suite: DataFrame) -> DataFrame:
    """Suite results plus one ``success`` row per built model, for :func:`quality.tally`."""
    spark = suite.sparkSession
    built = spark.createDataFrame([(name, "model", "success") for name in models], "name string, kind string, status string")
    name = F.concat_ws(".", "table_name", "column_name", "test")
    tests = suite.select(name.alias("name"), F.lit("test").alias("kind"), "status")
    return built.unionByName(tests)
