"""Queries on run logs and data tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.catalog.feeds import raw, run_log, sync_state, table
from tradeloom.catalog.flat import dbl, sk, sql
from tradeloom.catalog.registry import query
from tradeloom.catalog.staging_queries import staged_orders, staged_transactions
from tradeloom.catalog.star_queries import built, order_facts
from tradeloom.functions.keys import surrogate_key
from tradeloom.operators import quality, runlog
from tradeloom.operators import staging as st
from tradeloom.operators.quality import Rule
from tradeloom.plans.star import results_of
from tradeloom.session import written

RUN_SQL = "run_id, domain, mode, started_at, ended_at, rows_ingested, status, error_message, triggered_by"


# -- run log -------------------------------------------------------------------


@query(
    "latest_run_per_domain",
    sql("""SELECT s.domain, last_updated_at, status, mode, started_at, ended_at, rows_ingested, error_message
FROM state s LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY started_at DESC, run_id DESC) AS rn FROM runs) r
ON r.domain = s.domain AND rn = 1"""),
)
def _(spark, sf):
    return runlog.status(sync_state(spark, sf), run_log(spark, sf))


@query("latest_runs", sql(f"SELECT {RUN_SQL} FROM runs ORDER BY started_at DESC, run_id LIMIT 10"))
def _(spark, sf):
    return runlog.latest_runs(run_log(spark, sf))


@query(
    "run_durations",
    sql("""SELECT run_id, domain, started_at, date_diff('microsecond', started_at, ended_at) / 1e6 AS seconds
FROM runs ORDER BY started_at DESC, run_id LIMIT 12"""),
)
def _(spark, sf):
    return runlog.run_durations(run_log(spark, sf))


def _archive(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Run log split as of mid April: runs before mid January are older than 90 days."""
    log = run_log(spark, sf)
    return runlog.archive_split(log, log.filter("false"), F.lit("2024-04-14 00:00:00").cast("timestamp"))


@query("run_log_history", sql(f"SELECT {RUN_SQL} FROM runs"))
def _(spark, sf):
    return runlog.history(*_archive(spark, sf))


@query(
    "archive_split",
    sql(f"SELECT started_at < TIMESTAMP '2024-01-15' AS archived, {RUN_SQL} FROM runs"),
)
def _(spark, sf):
    hot, archive = _archive(spark, sf)
    tagged = hot.withColumn("archived", F.lit(False)).unionByName(archive.withColumn("archived", F.lit(True)))
    return tagged.select("archived", *hot.columns)


@query("kind_histogram", sql("SELECT kind, count(*) AS n FROM transactions GROUP BY kind"))
def _(spark, sf):
    return runlog.kind_histogram(staged_transactions(spark, sf), "kind")


# -- data tests ----------------------------------------------------------------


@query(
    "dq_unique",
    "SELECT l_orderkey AS l_orderkey, count(*) AS n_records FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1",
)
def _(spark, sf):
    """Order keys are not unique among line items."""
    return quality.failing_rows(table(spark, sf, "lineitem"), Rule("lineitem", "l_orderkey", "unique"))


@query("dq_not_null", sql("SELECT order_id, order_name FROM staged_orders WHERE customer_id IS NULL"))
def _(spark, sf):
    orders = staged_orders(spark, sf, "order_id", "order_name", "customer_id")
    return quality.failing_rows(orders, Rule("stg_orders", "customer_id", "not_null")).select("order_id", "order_name")


@query(
    "dq_relationships",
    sql("""SELECT customer_key, count(*) AS n_records FROM order_facts
WHERE customer_key NOT IN (SELECT md5(CAST(customer_id AS VARCHAR)) FROM customers) GROUP BY customer_key"""),
)
def _(spark, sf):
    """Guest orders share the key of the missing customer, which no customer has."""
    customers = st.customers(raw(spark, sf, "customers"), keep=["customer_id"])
    parents = customers.select(surrogate_key("customer_id").alias("customer_key"))
    rule = Rule("fct_orders", "customer_key", "relationships", ("dim_customers", "customer_key"))
    return quality.failing_rows(order_facts(spark, sf), rule, {"dim_customers": parents})


@query(
    "dq_accepted_values",
    sql(f"SELECT transaction_id, kind FROM transactions WHERE kind NOT IN {quality.TRANSACTION_KINDS}"),
)
def _(spark, sf):
    rule = Rule("stg_order_transactions", "kind", "accepted_values", quality.TRANSACTION_KINDS, "warn")
    return quality.failing_rows(staged_transactions(spark, sf), rule).select("transaction_id", "kind")


@query("dq_expression", sql(f"SELECT customer_id, {dbl('total_spent_vnd')} FROM customers WHERE NOT total_spent_vnd >= 0"))
def _(spark, sf):
    customers = st.customers(raw(spark, sf, "customers"), keep=["customer_id", "total_spent_vnd"])
    rule = Rule("stg_customers", "total_spent_vnd", "expression", ">= 0")
    return quality.failing_rows(customers, rule).select("customer_id", "total_spent_vnd")


@query(
    "dq_null_fraction",
    sql("""SELECT CAST(count_if(customer_id IS NULL) AS BIGINT) AS nulls, count(*) AS total,
count_if(customer_id IS NULL) / nullif(count(*), 0) AS null_fraction,
coalesce(count_if(customer_id IS NULL) / nullif(count(*), 0) > 0.95, false) AS exceeded FROM staged_orders"""),
)
def _(spark, sf):
    found = quality.null_fraction(staged_orders(spark, sf, "customer_id"), "customer_id")
    return found.withColumn("exceeded", F.coalesce(F.col("null_fraction") > quality.NULL_CUSTOMER_LIMIT, F.lit(False)))


@query(
    "dq_freshness",
    """SELECT source, newest, age_hours, CASE WHEN age_hours > e THEN 'error' WHEN age_hours > w THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT source, max(seen) AS newest, date_diff('microsecond', max(seen), TIMESTAMP '2024-01-31 04:00:00') / 3.6e9 AS age_hours,
  any_value(w) AS w, any_value(e) AS e
  FROM (SELECT m.source, ts - m.lag * INTERVAL 1 HOUR AS seen, w, e FROM events JOIN (VALUES
    ('click', 'orders', 0, 6, 24), ('view', 'customers', 12, 12, 48), ('purchase', 'products', 96, 24, 72),
    ('signup', 'unlisted', 30, 24, 48)) m(kind, source, lag, w, e) ON event_type = m.kind) GROUP BY source)""",
)
def _(spark, sf):
    """Each kind of event stands for a source that was last landed some hours earlier."""
    lag = {"click": ("orders", 0), "view": ("customers", 12), "purchase": ("products", 96), "signup": ("unlisted", 30),
           "error": ("locations", 500)}
    kind = F.col("event_type")
    source = F.coalesce(*[F.when(kind == k, s) for k, (s, _) in lag.items()])
    hours = F.coalesce(*[F.when(kind == k, F.lit(h)) for k, (_, h) in lag.items()])
    at = F.col("ts").cast("timestamp") - F.make_dt_interval(hours=hours)
    loads = table(spark, sf, "events").select(source.alias("source"), at.alias("ingested_at"))
    return quality.freshness(loads, F.lit("2024-01-31 04:00:00").cast("timestamp"))


# Where the tested tables are found in SQL, and the raw feeds by their id.
SQL_TABLES = {
    "raw_orders": "(SELECT order_id AS id, 1 AS payload, order_updated_at AS updated_at FROM staged_orders)",
    "raw_customers": "(SELECT customer_id AS id FROM customers)",
    "raw_products": "(SELECT product_id AS id FROM products)",
    "raw_locations": "(SELECT location_id AS id FROM locations)",
    "raw_inventory_adjustments": "(SELECT DISTINCT parent_adjustment_id AS id FROM adjustments)",
    "raw_inventory_locations": "(SELECT concat_ws(':', location_id, variant_id, snapshot_date) AS id, * FROM levels)",
    "raw_custom_collections": "(SELECT doc_id AS id FROM documents)",
    "raw_smart_collections": "(SELECT page_id AS id FROM pages)",
    "raw_discounts": "(SELECT p_partkey AS id FROM part)",
    "raw_promotions": "(SELECT s_suppkey AS id FROM supplier)",
    "stg_orders": "staged_orders",
    "stg_order_refunds": "refunds",
    "stg_order_transactions": "transactions",
    "stg_customers": "customers",
    "stg_products": "products",
    "stg_variants": "variants",
    "stg_locations": "locations",
    "stg_inventory_adjustments": "adjustments",
    "stg_inventory_locations": "levels",
    "stg_custom_collections": "(SELECT doc_id AS collection_id FROM documents)",
    "stg_smart_collections": "(SELECT page_id AS collection_id FROM pages)",
    "stg_discounts": "(SELECT p_partkey AS discount_id FROM part)",
    "stg_promotions": "(SELECT s_suppkey AS promotion_id FROM supplier)",
    "dim_customers": f"(SELECT {sk('customer_id')} AS customer_key, * FROM customers)",
    "dim_products": "product_dim",
    "dim_variants": "variant_dim",
    "dim_locations": f"(SELECT {sk('location_id')} AS location_key, * FROM locations)",
    "dim_date": "date_dim",
    "dim_payment_methods": "method_dim",
    "fct_orders": "order_facts",
    "fct_order_lines": "line_facts",
    "fct_transactions": "transaction_facts",
    "fct_refunds": "refund_facts",
    "fct_inventory_adjustments": "adjustment_facts",
    "fct_inventory_snapshot": "snapshot_facts",
    "holidays": "(SELECT date_actual AS date, * FROM holiday_list)",
}


def _rule_sql(rule: Rule) -> str:
    rows, c = SQL_TABLES[rule.table], rule.column
    if rule.test == "unique":
        failures = f"SELECT count(*) FROM (SELECT {c} FROM {rows} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
    elif rule.test == "relationships":
        parent, field = rule.arg
        failures = f"""SELECT count(*) FROM {rows} WHERE {c} IS NOT NULL
AND {c} NOT IN (SELECT {field} FROM {SQL_TABLES[parent]})"""
    elif rule.test == "null_fraction":
        failures = f"SELECT CAST(coalesce(count_if({c} IS NULL) / nullif(count(*), 0) > {rule.arg}, false) AS BIGINT) FROM {rows}"
    else:
        broken = {
            "not_null": f"{c} IS NULL",
            "accepted_values": f"{c} NOT IN {rule.arg}",
            "expression": f"NOT ({c} {rule.arg})",
        }[rule.test]
        failures = f"SELECT count(*) FROM {rows} WHERE {broken}"
    return f"""SELECT '{rule.table}' AS table_name, '{c}' AS column_name, '{rule.test}' AS test,
'{rule.severity}' AS severity, ({failures}) AS failures"""


RESULTS_SQL = f"""SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status
FROM ({" UNION ALL ".join(_rule_sql(r) for r in quality.RULES)})"""

_checked: dict[tuple[str, str], tuple[list[str], DataFrame]] = {}


def suite_results(spark: SparkSession, sf: str) -> tuple[list[str], DataFrame]:
    """Models built, and the result of every test on them; one build per session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _checked:
        star = built(spark, sf)
        _checked[key] = (sorted(star.tables), written(star.check(), "suite"))
    return _checked[key]


@query("dq_results", sql(RESULTS_SQL))
def _(spark, sf):
    """Every shipped test on a complete build."""
    return suite_results(spark, sf)[1]


@query(
    "dq_summary",
    sql(f"""SELECT CAST(25 AS BIGINT) AS models_built, count(*) AS tests_total,
CAST(count_if(status = 'pass') AS BIGINT) AS tests_passed, CAST(count_if(status = 'fail') AS BIGINT) AS tests_failed, count_if(status = 'fail') = 0 AS build_ok FROM ({RESULTS_SQL})"""),
)
def _(spark, sf):
    """The tally that decides whether the build passed."""
    models, suite = suite_results(spark, sf)
    return quality.tally(results_of(models, suite))
