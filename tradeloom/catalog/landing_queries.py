"""Queries on ingest, landing writes and incremental state."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.catalog.feeds import (
    AS_OF,
    RUN_ID,
    as_of,
    customer_items,
    inventory_items,
    location_items,
    raw,
    run_log,
    sync_state,
    table,
)
from tradeloom.catalog.flat import sql
from tradeloom.catalog.registry import query
from tradeloom.operators import grid, reconcile, runlog, state
from tradeloom.operators.upsert import guarded_upsert, last_arrivals, load_summary
from tradeloom.session import scratch
from tradeloom.sources.domains import domain
from tradeloom.sources.pages import ingest
from tradeloom.sources.raw import location_rows, raw_rows, snapshot_rows
from tradeloom.sources.seeds import read_holidays
from tradeloom.sources.tables import KeyedTable
from tradeloom.streaming.append import stream_append
from tradeloom.streaming.landing import LOADS_SCHEMA, stream_landing

PAGE_SIZE = 50


def save_pages(items: DataFrame, envelope: str, page: str, order: str, path: str) -> None:
    """Write items as page envelopes, one per line, ``PAGE_SIZE`` items at most in each.

    ``page`` is a column that numbers the pages, ``order`` one that orders a page.
    """
    listed = items.groupBy(page).agg(F.sort_array(F.collect_list(F.struct(order, "item"))).alias("items"))
    body = F.array_join(F.transform("items", lambda i: i["item"]), ",")
    line = F.concat(F.lit('{"page":'), F.col(page).cast("string"), F.lit(f',"{envelope}":['), body, F.lit("]}"))
    listed.select(line.alias("value")).write.text(path)


def saved_customer_pages(spark: SparkSession, sf: str) -> str:
    items = customer_items(spark, sf).withColumn("n", F.get_json_object("item", "$.id").cast("bigint"))
    # An unquoted amount of 18 digits, which no double can hold.
    cents = F.lpad((F.col("n") % 100).cast("string"), 2, "0")
    amount = F.concat((F.col("n") + 10**15).cast("string"), F.lit("."), cents)
    items = items.withColumn("item", F.concat(F.expr("left(item, length(item) - 1)"), F.lit(',"balance":'), amount, F.lit("}")))
    path = scratch(spark, "pages")
    save_pages(items.withColumn("page_no", F.floor(F.col("n") / PAGE_SIZE)), "customers", "page_no", "n", path)
    return path


BALANCE_SQL = "(c_custkey + 1000000000000000) || '.' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0')"


def _balance(payload: str) -> Column:
    """The exact amount as the staging tables read it."""
    return F.variant_get(F.parse_json(F.col(payload)), "$.balance", "decimal(18,2)").cast("string")


@query(
    "ingest_pages",
    f"""SELECT c_custkey // {PAGE_SIZE} AS page, CAST(c_custkey % {PAGE_SIZE} AS INTEGER) AS position, c_custkey AS id, c_name AS last_name,
c_acctbal < 0 AS disabled, {BALANCE_SQL} AS balance, {BALANCE_SQL} AS balance_text FROM customer""",
)
def _(spark, sf):
    items = ingest(spark, saved_customer_pages(spark, sf), domain("customers"))
    return items.select(
        "page", "position",
        F.get_json_object("item", "$.id").cast("bigint").alias("id"),
        F.get_json_object("item", "$.last_name").alias("last_name"),
        (F.get_json_object("item", "$.state") == "disabled").alias("disabled"),
        _balance("item").alias("balance"),
        F.regexp_extract("item", '"balance":([0-9.]+)}$', 1).alias("balance_text"),
    )


@query(
    "raw_rows",
    f"""SELECT o_orderkey AS id, o_orderdate + CAST(o_orderkey % 40 AS INTEGER) * INTERVAL 1 DAY + INTERVAL 123 MILLISECOND AS updated_at,
'{RUN_ID}' AS source_run_id, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS total FROM orders""",
)
def _(spark, sf):
    """Timestamps with a fraction and the shop's offset, seven hours ahead of UTC."""
    o = table(spark, sf, "orders")
    day = F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 40).cast("int")).cast("string")
    doc = F.struct(
        F.col("o_orderkey").alias("id"),
        F.concat(day, F.lit("T07:00:00.123+07:00")).alias("updated_at"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("total"),
    )
    rows = raw_rows(o.select(F.to_json(doc).alias("item")), RUN_ID, as_of())
    total = F.get_json_object("payload", "$.total").cast("decimal(18,2)").alias("total")
    return rows.select("id", "updated_at", "source_run_id", total)


@query(
    "raw_rows_ts_fallback",
    f"""SELECT CAST(n_nationkey AS BIGINT) AS id, CASE WHEN n_nationkey % 5 = 0 THEN TIMESTAMP '{AS_OF}'
ELSE CAST(DATE '2023-01-01' + n_nationkey AS TIMESTAMP) END AS updated_at FROM nation""",
)
def _(spark, sf):
    return location_rows(location_items(spark, sf), RUN_ID, as_of(), as_of()).select("id", "updated_at")


@query(
    "snapshot_rows",
    """SELECT (user_id % 25) || ':' || ((event_id % 200) * 10) || ':' || strftime(ts, '%Y-%m-%d') AS id,
user_id % 25 AS location_id, (event_id % 200) * 10 AS variant_id, CAST(ts AS DATE) AS snapshot_date, ts AS updated_at,
event_id AS position FROM events""",
)
def _(spark, sf):
    rows = snapshot_rows(inventory_items(spark, sf), RUN_ID, F.col("day"), F.col("seen_at"), as_of())
    return rows.select("id", "location_id", "variant_id", "snapshot_date", "updated_at", "position")


@query(
    "seed_holidays",
    sql("""SELECT date_actual AS date, any_value(holiday_name) AS holiday_name, any_value(is_public_holiday) AS is_public_holiday,
count(o_orderkey) AS orders, CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS revenue
FROM holiday_list LEFT JOIN orders ON CAST(o_orderdate AS DATE) = date_actual GROUP BY date_actual"""),
)
def _(spark, sf):
    """Orders taken on each day of the holiday seed."""
    o = table(spark, sf, "orders")
    per_day = o.groupBy(F.to_date("o_orderdate").alias("date")).agg(
        F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total")
    )
    return read_holidays(spark).join(per_day, "date", "left").select(
        "date", "holiday_name", "is_public_holiday", F.coalesce("n", F.lit(0)).alias("orders"),
        F.coalesce("total", F.lit(0)).cast("double").alias("revenue"),
    )


# Upserts: clicks and views are what is stored (the newest per user), the other
# events are the batch. So batches hold older and newer rows, and many per key.

STORED_KINDS = ("click", "view")
STORED_SQL = "event_type IN ('click', 'view')"


def event_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("user_id").alias("id"), F.col("props").alias("payload"), F.col("ts").cast("timestamp").alias("updated_at"),
        as_of().alias("ingested_at"), F.lit(RUN_ID).alias("source_run_id"),
        F.floor(F.col("event_id") / PAGE_SIZE).alias("page"), (F.col("event_id") % PAGE_SIZE).alias("position"), "event_type",
    )


def stored_and_batch(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = event_rows(spark, sf)
    stored = F.col("event_type").isin(*STORED_KINDS)
    return last_arrivals(rows.filter(stored)).drop("event_type"), rows.filter(~stored).drop("event_type")


def _newest_sql(where: str, order: str = "ts DESC, event_id DESC") -> str:
    return f"""SELECT id, payload, updated_at FROM (SELECT user_id AS id, props AS payload, ts AS updated_at,
row_number() OVER (PARTITION BY user_id ORDER BY {order}) AS rn FROM events WHERE {where}) WHERE rn = 1"""


@query("guarded_upsert", _newest_sql("true", f"ts DESC, {STORED_SQL}, event_id DESC"))
def _(spark, sf):
    stored, batch = stored_and_batch(spark, sf)
    return guarded_upsert(stored, batch).select("id", "payload", "updated_at")


@query("batch_dedupe", _newest_sql("true", "date_trunc('day', ts) DESC, event_id DESC"))
def _(spark, sf):
    """Timestamps cut to the day tie often; then the last arrival wins."""
    rows = event_rows(spark, sf).withColumn("day", F.date_trunc("day", "updated_at"))
    return last_arrivals(rows, ts="day").select("id", "payload", "updated_at")


@query(
    "snapshot_upsert",
    sql("""SELECT location_id || ':' || variant_id || ':' || strftime(snapshot_date, '%Y-%m-%d') AS id, location_id, variant_id,
snapshot_date, available_quantity AS available FROM levels"""),
)
def _(spark, sf):
    """Errors are stored, then all other events arrive; the key is a text of three parts."""
    rows = snapshot_rows(
        inventory_items(spark, sf).withColumn("late", F.get_json_object("item", "$.committed") == ""),
        RUN_ID, F.col("day"), F.col("seen_at"), as_of(),
    ).drop("day", "seen_at")
    stored = last_arrivals(rows.filter("late")).drop("late")
    merged = guarded_upsert(stored, rows.filter("NOT late").drop("late"), keys=("id",))
    available = F.get_json_object("payload", "$.available").cast("int").alias("available")
    return merged.select("id", "location_id", "variant_id", "snapshot_date", available)


@query("load_summary", f"SELECT count(*) AS rows_total, max(ts) AS max_updated_at FROM events WHERE NOT {STORED_SQL}")
def _(spark, sf):
    return load_summary(stored_and_batch(spark, sf)[1])


def event_feed(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_type").alias("domain"), F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("updated_at")
    )


@query(
    "incremental_window",
    sql("""SELECT event_type AS domain, event_id AS id, ts AS updated_at FROM events LEFT JOIN state ON event_type = domain
WHERE last_updated_at IS NULL OR ts >= last_updated_at - INTERVAL 7 DAY"""),
)
def _(spark, sf):
    return state.read_window_by_state(event_feed(spark, sf), sync_state(spark, sf))


@query(
    "window_shop_tz",
    """SELECT event_id AS id, ts AS updated_at FROM events
WHERE ts >= TIMESTAMP '2024-01-09 17:00:00' AND ts <= TIMESTAMP '2024-01-20 05:30:00'""",
)
def _(spark, sf):
    """Bounds typed as shop wall-clock times: 10 January 00:00 and 20 January 12:30."""
    since = state.as_shop_instant(datetime(2024, 1, 10))
    until = state.as_shop_instant(datetime(2024, 1, 20, 12, 30))
    return state.read_window(event_feed(spark, sf), since=since, until=until).select("id", "updated_at")


@query(
    "watermark_advance",
    sql("""SELECT coalesce(s.domain, l.event_type) AS domain, greatest(last_updated_at, newest) AS last_updated_at,
CASE WHEN newest IS NOT NULL THEN 'run-now' ELSE last_run_id END AS last_run_id,
CASE WHEN newest IS NOT NULL THEN TIMESTAMP '2024-02-01' ELSE updated_at END AS updated_at, last_high_id
FROM state s FULL JOIN (SELECT event_type, CASE WHEN event_type <> 'click' THEN
  CASE WHEN event_type = 'view' THEN min(ts) ELSE max(ts) END END AS newest FROM events GROUP BY event_type) l
ON s.domain = l.event_type"""),
)
def _(spark, sf):
    """Views deliver old rows only, clicks none, signups are new to the state."""
    kind = F.col("event_type")
    loads = table(spark, sf, "events").groupBy("event_type").agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    newest = F.when(kind == "view", F.col("first")).when(kind != "click", F.col("last")).cast("timestamp")
    loads = loads.select(kind.alias("domain"), newest.alias("max_updated_at"), F.lit("run-now").alias("run_id"))
    return state.advance_watermarks(sync_state(spark, sf), loads, as_of())


@query(
    "high_id_append",
    sql("""SELECT event_type AS domain, count(*) AS fresh, CAST(min(event_id) AS BIGINT) AS first_id,
greatest(coalesce(any_value(last_high_id), 0), max(event_id)) AS last_high_id
FROM events LEFT JOIN state ON event_type = domain WHERE event_id > coalesce(last_high_id, 0) GROUP BY event_type"""),
)
def _(spark, sf):
    """Rows above each feed's high id, and the high id after reading them."""
    before = sync_state(spark, sf)
    fresh = state.above_high_id(event_feed(spark, sf), before)
    loads = fresh.groupBy("domain").agg(
        F.count("*").alias("fresh"), F.min("id").alias("first_id"), F.max("id").alias("max_id")
    ).withColumn("run_id", F.lit("run-now"))
    after = state.advance_high_ids(before, loads.select("domain", "max_id", "run_id"), as_of())
    return loads.join(after, "domain").select("domain", "fresh", "first_id", "last_high_id")


@query(
    "run_log_close",
    sql("""SELECT run_id, domain, mode, started_at, started_at + INTERVAL 90 SECOND AS ended_at, CAST(v AS BIGINT) AS rows_ingested,
CASE WHEN failed THEN 'failed' ELSE 'success' END AS status, CASE WHEN failed THEN nullif(left(error_message, 1000), '') END AS error_message,
'manual' AS triggered_by
FROM (SELECT *, domain = 'error' AS failed FROM runs) JOIN (SELECT 'run-' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS rid,
  floor(value) AS v FROM events) ON rid = run_id"""),
)
def _(spark, sf):
    """Start a run per event, then close all of them 90 seconds later."""
    log = run_log(spark, sf)
    starts = log.select("run_id", "domain", "mode", F.lit("manual").alias("triggered_by"), F.col("started_at").alias("begun"))
    running = runlog.start_runs(starts, F.col("begun"))
    e = table(spark, sf, "events")
    failed = F.col("event_type") == "error"
    ends = e.select(
        F.format_string("run-%012d", "event_id").alias("run_id"),
        F.floor("value").cast("bigint").alias("rows"),
        F.when(failed, "failed").otherwise("success").alias("outcome"),
        F.when(failed, F.repeat(F.lit("boom "), (F.col("event_id") % 400).cast("int"))).alias("error"),
        (F.col("ts").cast("timestamp") + F.expr("INTERVAL 90 SECONDS")).alias("at"),
    )
    return runlog.close_runs(running, ends)


@query("distinct_nested_ids", sql("SELECT variant_id FROM variants ORDER BY variant_id"))
def _(spark, sf):
    return grid.nested_ids(raw(spark, sf, "products"), "variants", "variant_id").orderBy("variant_id")


@query("inventory_grid", sql("SELECT location_id, variant_id FROM locations CROSS JOIN variants"))
def _(spark, sf):
    places = raw(spark, sf, "locations").select(F.col("id").alias("location_id"))
    return grid.location_grid(places, grid.nested_ids(raw(spark, sf, "products"), "variants", "variant_id"))


@query(
    "id_batches",
    sql("""SELECT batch, string_agg(CAST(variant_id AS VARCHAR), ',' ORDER BY variant_id) AS ids
FROM (SELECT variant_id, (row_number() OVER (ORDER BY variant_id) - 1) // 50 AS batch FROM variants) GROUP BY batch"""),
)
def _(spark, sf):
    return grid.id_batches(grid.nested_ids(raw(spark, sf, "products"), "variants", "variant_id"), "variant_id")


@query(
    "count_drift",
    sql("""SELECT domain, source_count, landed_count, abs(source_count - landed_count) / greatest(source_count, 1) AS drift,
abs(source_count - landed_count) / greatest(source_count, 1) <= 0.001 AS ok FROM (
SELECT 'orders' AS domain, (SELECT count(*) FROM orders) AS source_count, (SELECT count(*) FROM headers) AS landed_count
UNION ALL SELECT 'customers', (SELECT count(*) FROM customer), (SELECT count(*) FROM customer)
UNION ALL SELECT 'products', (SELECT count(*) FROM part), (SELECT count(*) FROM products)
UNION ALL SELECT 'locations', (SELECT count(*) FROM nation), (SELECT count(*) FROM nation)
UNION ALL SELECT 'promotions', (SELECT count(*) FROM supplier), (SELECT count(*) FROM supplier)
UNION ALL SELECT 'discounts', (SELECT count(*) FROM part), (SELECT count(*) FROM part))"""),
)
def _(spark, sf):
    """An order that lands as several documents counts more often than at the source."""
    at_source = {
        "orders": "orders", "customers": "customer", "products": "part", "locations": "nation", "promotions": "supplier",
        "discounts": "part",
    }
    source = reconcile.table_counts({d: table(spark, sf, t) for d, t in at_source.items()}, "source_count")
    landed = reconcile.table_counts({d: raw(spark, sf, d) for d in at_source}, "landed_count")
    return reconcile.count_drift(source, landed)


@query(
    "stream_landing",
    f"""SELECT c_custkey AS id, c_name AS last_name, {BALANCE_SQL} AS balance,
CAST(DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS TIMESTAMP) AS updated_at FROM customer""",
)
def _(spark, sf):
    """Land the customer pages through a stream, twice; the second run must change nothing."""
    pages = saved_customer_pages(spark, sf)
    store = KeyedTable(spark, scratch(spark, "raw-customers"), ["id"], "id div 100000000")
    for attempt in ("first", "replayed"):
        job = stream_landing(
            spark, pages, store, domain("customers"), scratch(spark, f"stream-{attempt}"), RUN_ID, as_of()
        )
        job.awaitTermination()
    landed = store.read()
    return landed.select("id", F.get_json_object("payload", "$.last_name").alias("last_name"), "updated_at", _balance("payload").alias("balance"))


def _appended(spark: SparkSession, sf: str) -> tuple[KeyedTable, DataFrame]:
    """The events as a stream into a table, in three runs over a source that grows between them.

    Every run is delivered rows whose ids the table has, from the runs before and
    from the growing source itself. Also returned: what each run submitted.
    """
    source, checkpoint, loads = (scratch(spark, n) for n in ("events", "stream-append", "loads"))
    events = table(spark, sf, "events").select(
        F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("updated_at"), "event_type"
    )
    store = KeyedTable(spark, scratch(spark, "appended"), ["id"], "id div 100000000")
    for run in range(3):
        # A run brings its third of the events, and the third before it once more.
        events.filter((F.col("id") % 3 == run) | (F.col("id") % 3 == run - 1)).write.mode("append").parquet(source)
        rows = spark.readStream.schema(events.schema).parquet(source)
        stream_append(rows, store, checkpoint, f"run-{run}", loads).awaitTermination()
    return store, spark.read.schema(LOADS_SCHEMA).parquet(loads)


@query("stream_append", "SELECT event_id AS id, ts AS updated_at, event_type FROM events")
def _(spark, sf):
    """Append the events once, though the stream delivers two thirds of them twice."""
    return _appended(spark, sf)[0].read()


@query(
    "stream_load_summary",
    """SELECT 'run-' || run AS run_id, CAST(count(*) AS BIGINT) AS rows_total, max(ts) AS max_updated_at
FROM events, range(3) r(run) WHERE event_id % 3 = run OR event_id % 3 = run - 1 GROUP BY run""",
)
def _(spark, sf):
    """Rows that each run of a stream submitted, whether they were new or not, and the newest stamp among them."""
    loads = _appended(spark, sf)[1].groupBy("run_id")
    return loads.agg(F.sum("rows_total").alias("rows_total"), F.max("max_updated_at").alias("max_updated_at"))
