"""Declarative data tests.

A test is a query for failing rows; no rows means it passed. ``failing_rows``
gives those rows for one test. ``run_suite`` counts them for all, in one query for
the tests of a table, each key reduced to one row per task before the shuffle.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tradeloom.session import in_parallel

ROW_TESTS = ("not_null", "accepted_values", "expression", "predicate")
INTEGRAL = ("tinyint", "smallint", "int", "bigint")
#: Tables whose keys are counted side by side.
AT_A_TIME = 2

RESULT_SCHEMA = (
    "table_name string, column_name string, test string, severity string, failures bigint, status string"
)


@dataclass(frozen=True)
class Rule:
    """``arg``: accepted values, the expression, or ``(table, column)`` referred to.

    An ``expression`` continues the column name (``>= 0``), a ``predicate``
    stands alone.
    """

    table: str
    column: str
    test: str
    arg: object = None
    severity: str = "error"


def key(table: str, *columns: str) -> list[Rule]:
    return [Rule(table, c, t) for c in columns for t in ("unique", "not_null")]


def not_null(table: str, *columns: str) -> list[Rule]:
    return [Rule(table, c, "not_null") for c in columns]


def refers(table: str, **targets: tuple[str, str]) -> list[Rule]:
    return [Rule(table, c, "relationships", to) for c, to in targets.items()]


# ---------------------------------------------------------------------------
# The tests of the shipped model, the accepted transaction kinds,
# and the freshness limits in hours.

NULL_CUSTOMER_LIMIT = 0.95
TRANSACTION_KINDS = ("sale", "refund", "authorization", "capture", "void", "change", "pending")

RAW_RULES = [
    *key("raw_orders", "id"),
    *not_null("raw_orders", "payload", "updated_at"),
    *key("raw_customers", "id"),
    *key("raw_products", "id"),
    *key("raw_locations", "id"),
    *key("raw_inventory_adjustments", "id"),
    *key("raw_inventory_locations", "id"),
    *not_null("raw_inventory_locations", "location_id", "variant_id", "snapshot_date"),
    *key("raw_custom_collections", "id"),
    *key("raw_smart_collections", "id"),
    *key("raw_discounts", "id"),
    *key("raw_promotions", "id"),
]

STAGING_RULES = [
    *key("stg_orders", "order_id"),
    Rule("stg_orders", "total_price_vnd", "expression", ">= 0"),
    Rule("stg_orders", "customer_id", "null_fraction", NULL_CUSTOMER_LIMIT),
    *key("stg_order_refunds", "refund_id"),
    *not_null("stg_order_refunds", "order_id"),
    Rule("stg_order_refunds", "refund_amount_vnd", "expression", ">= 0"),
    *key("stg_order_transactions", "transaction_id"),
    *not_null("stg_order_transactions", "order_id"),
    Rule("stg_order_transactions", "kind", "accepted_values", TRANSACTION_KINDS, "warn"),
    *key("stg_customers", "customer_id"),
    *key("stg_products", "product_id"),
    *key("stg_variants", "variant_id"),
    *not_null("stg_variants", "product_id"),
    Rule("stg_variants", "price_vnd", "expression", ">= 0"),
    *key("stg_locations", "location_id"),
    *key("stg_inventory_adjustments", "adjustment_id"),
    *not_null("stg_inventory_adjustments", "variant_id", "location_id"),
    *not_null("stg_inventory_locations", "location_id", "variant_id", "snapshot_date"),
    Rule("stg_inventory_locations", "available_quantity", "expression", ">= 0", "warn"),
    *key("stg_custom_collections", "collection_id"),
    *key("stg_smart_collections", "collection_id"),
    *key("stg_discounts", "discount_id"),
    *key("stg_promotions", "promotion_id"),
]

MART_RULES = [
    *key("dim_customers", "customer_key", "customer_id"),
    *key("dim_products", "product_key"),
    Rule("dim_products", "product_id", "unique"),
    *key("dim_variants", "variant_key"),
    Rule("dim_variants", "variant_id", "unique"),
    *refers("dim_variants", product_key=("dim_products", "product_key")),
    *key("dim_locations", "location_key", "location_id"),
    *key("dim_date", "date_key", "date_actual"),
    *key("dim_payment_methods", "payment_method_key", "method_name"),
    *key("fct_orders", "order_key", "order_id"),
    *refers(
        "fct_orders",
        customer_key=("dim_customers", "customer_key"),
        location_key=("dim_locations", "location_key"),
        order_date_key=("dim_date", "date_key"),
    ),
    Rule("fct_orders", "net_revenue_vnd", "expression", "= total_price_vnd - total_refunded_vnd"),
    Rule(
        "fct_orders", "total_refunded_reported_vnd", "expression",
        "IS NULL OR abs(coalesce(total_refunded_reported_vnd, 0) - total_refunded_vnd) < 1", "warn",
    ),
    *key("fct_order_lines", "line_key"),
    *refers(
        "fct_order_lines", variant_key=("dim_variants", "variant_key"), product_key=("dim_products", "product_key")
    ),
    *key("fct_transactions", "transaction_key"),
    *refers(
        "fct_transactions",
        order_key=("fct_orders", "order_key"),
        payment_method_key=("dim_payment_methods", "payment_method_key"),
    ),
    *key("fct_refunds", "refund_key"),
    *refers("fct_refunds", order_key=("fct_orders", "order_key")),
    *key("fct_inventory_adjustments", "adjustment_key", "adjustment_id"),
    *refers(
        "fct_inventory_adjustments",
        variant_key=("dim_variants", "variant_key"),
        location_key=("dim_locations", "location_key"),
        adjustment_date_key=("dim_date", "date_key"),
    ),
    *key("fct_inventory_snapshot", "snapshot_key"),
    *refers(
        "fct_inventory_snapshot",
        variant_key=("dim_variants", "variant_key"),
        location_key=("dim_locations", "location_key"),
        snapshot_date_key=("dim_date", "date_key"),
    ),
    Rule("fct_inventory_snapshot", "on_hand_quantity", "expression", ">= 0", "warn"),
]

SEED_RULES = [*key("holidays", "date"), *not_null("holidays", "holiday_name", "is_public_holiday")]

RULES = [*RAW_RULES, *STAGING_RULES, *MART_RULES, *SEED_RULES]


DEFAULT_FRESHNESS = (24, 48)
FRESHNESS: dict[str, tuple[int, int] | None] = {
    "orders": (6, 24),
    "customers": (12, 48),
    "products": (24, 72),
    "locations": None,
    "inventory_adjustments": (12, 48),
    "inventory_locations": (36, 72),
    "custom_collections": (48, 96),
    "smart_collections": (48, 96),
    "discounts": (24, 72),
    "promotions": (24, 72),
}
# ---------------------------------------------------------------------------


def _breaks(rule: Rule) -> Column:
    """Condition of a failing row. A NULL outcome of an expression passes."""
    c = F.col(rule.column)
    if rule.test == "not_null":
        return c.isNull()
    if rule.test == "accepted_values":
        return ~c.isin(*rule.arg)  # type: ignore[misc]
    if rule.test == "expression":
        return ~F.expr(f"{rule.column} {rule.arg}")
    if rule.test == "predicate":
        return ~F.expr(str(rule.arg))
    raise ValueError(f"not a row test: {rule.test!r}")


def _duplicates(df: DataFrame, column: str) -> DataFrame:
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_records"))
    return counted.filter("n_records > 1")


def _orphans(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    keys = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_records"))
    return keys.join(parent.select(F.col(field).alias(column)), column, "left_anti")


def failing_rows(df: DataFrame, rule: Rule, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Rows that break the rule.

    For ``unique`` and ``relationships`` these are the offending values with
    their number of rows (``n_records``).
    """
    if rule.test == "unique":
        return _duplicates(df, rule.column)
    if rule.test == "relationships":
        to, field = rule.arg  # type: ignore[misc]
        return _orphans(df, rule.column, (tables or {})[to], field)
    if rule.test not in ROW_TESTS:
        raise ValueError(f"unknown test: {rule.test!r}")
    return df.filter(_breaks(rule))


def run_suite(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """``(table_name, column_name, test, severity, failures, status)`` per rule.

    A column that is referred to is counted together with the columns that refer to it,
    and with its own unique test: its key is yielded once for all of them. The columns and
    row tests of one table are one query, in which each row yields the keys it has and the
    row tests it fails, and two grouped counts follow, by key and by rule; only the counts
    come back to the driver. A few tables are counted at a time, so that no more than their
    keys lie in shuffles. A rule whose table, or the table it refers to, is not given is
    ``skipped``.
    """
    able = [r for r in rules if r.table in tables and (r.test != "relationships" or r.arg[0] in tables)]  # type: ignore[index]
    if not able:
        raise ValueError("no rule applies to the given tables")
    # What is counted, by number: a column, with the rules that refer to it, or a row test.
    number: dict[object, int] = {}
    referring: dict[int, list[Rule]] = defaultdict(list)
    for rule in dict.fromkeys(able):
        i = number.setdefault(_counted(rule), len(number))
        if rule.test == "relationships":
            referring[i].append(rule)
    of_table: dict[str, dict[object, int]] = defaultdict(dict)
    for counted, i in number.items():
        of_table[counted.table if isinstance(counted, Rule) else counted[0]][counted] = i  # type: ignore[index]
    spark = next(iter(tables.values())).sparkSession
    jobs = {t: partial(_counts, tables, own, referring) for t, own in of_table.items()}
    counts = {r["counted"]: r for found in in_parallel(spark, jobs, AT_A_TIME).values() for r in found}

    def result(rule: Rule) -> tuple:
        i = number[_counted(rule)]
        slot = referring[i].index(rule) + 1 if rule.test == "relationships" else 0
        return _result(rule, counts.get(i), slot)

    known = set(able)
    results = [result(rule) if rule in known else (*_names(rule), None, "skipped") for rule in rules]
    return spark.createDataFrame(results, RESULT_SCHEMA)


def _counts(tables: Mapping[str, DataFrame], number: Mapping[object, int], referring: Mapping[int, Sequence[Rule]]) -> list[Row]:
    """Sums by what is counted: rows, keys with several rows, and rows of each referring rule whose key is not there."""
    width = 1 + max([1, *[len(referring.get(i, ())) for i in number.values()]])
    entries: dict[str, list[Column]] = defaultdict(list)
    for counted, i in number.items():
        if isinstance(counted, Rule):
            entries[counted.table].append(_row_entry(i, counted, width))
            continue
        columns = [counted, *[(r.table, r.column) for r in referring.get(i, ())]]
        make = _number_key if all(dict(tables[t].dtypes).get(c) in INTEGRAL for t, c in columns) else _text_key
        for slot, (t, c) in enumerate(columns):
            entries[t].append(_entry(i, make(F.col(c)), [int(n == slot) for n in range(width)]))
    seen = [tables[t].select(F.inline(F.array(*e))).filter("key IS NOT NULL") for t, e in entries.items()]
    slots = [f"n{n}" for n in range(width)]
    by_key = reduce(DataFrame.unionByName, seen).groupBy("counted", "key").agg(*[F.sum(n).alias(n) for n in slots])
    sums = [F.sum(n).alias(n) for n in slots]
    lost = [F.sum(F.when(F.col("n0") == 0, F.col(n))).alias(f"lost_{n}") for n in slots]
    return by_key.groupBy("counted").agg(F.count_if(F.col("n0") > 1).alias("repeated"), *sums, *lost).collect()


def _counted(rule: Rule) -> object:
    """What a rule counts: the column that is unique or referred to, or the rule itself."""
    if rule.test == "unique":
        return rule.table, rule.column
    return rule.arg if rule.test == "relationships" else rule


def _packed(key: Column) -> Column:
    """The text as bytes, a hash key as the 16 bytes it stands for; different texts stay different."""
    raw = F.unhex(key)
    # The text of hex digits that the bytes give again: digits are lower case and complete.
    hashed = (F.length(key) == 32) & F.lower(F.hex(raw)).eqNullSafe(key)
    return F.when(hashed, F.concat(F.lit("h").cast("binary"), raw)).otherwise(
        F.concat(F.lit("t").cast("binary"), key.cast("binary"))
    )


def _text_key(c: Column) -> Column:
    """The bytes of a key of any type, NULL if it is NULL; equal where the texts are."""
    return _packed(c.cast("string"))


def _number_key(c: Column) -> Column:
    """The same for whole numbers only: fewer bytes, as many as the number has."""
    return F.unhex(F.hex(c.cast("bigint")))


def _entry(i: int, key: Column, counts: Sequence[int | Column]) -> Column:
    """What a row yields for number ``i``; nothing if its key is NULL."""
    ns = [(n if isinstance(n, Column) else F.lit(n)).cast("bigint").alias(f"n{k}") for k, n in enumerate(counts)]
    return F.struct(F.lit(i).alias("counted"), key.alias("key"), *ns)


def _row_entry(i: int, rule: Rule, width: int) -> Column:
    """A failing row, or every row and whether it is NULL, without a key to tell rows apart."""
    none, rest = F.lit("").cast("binary"), [0] * (width - 2)
    if rule.test == "null_fraction":
        return _entry(i, none, [1, F.col(rule.column).isNull().cast("int"), *rest])
    return _entry(i, F.when(_breaks(rule), none), [1, 0, *rest])


def _names(rule: Rule) -> tuple[str, str, str, str]:
    return rule.table, rule.column, rule.test, rule.severity


def _result(rule: Rule, counts: Row | None, slot: int) -> tuple:
    if counts is None:
        failures = 0
    elif rule.test == "unique":
        failures = counts["repeated"]
    elif rule.test == "relationships":
        failures = counts[f"lost_n{slot}"] or 0
    elif rule.test == "null_fraction":
        failures = int(counts["n1"] / counts["n0"] > rule.arg)
    else:
        failures = counts["n0"]
    status = "pass" if not failures else "warn" if rule.severity == "warn" else "fail"
    return *_names(rule), failures, status


def require_passed(results: DataFrame, optional: Sequence[str] = ()) -> None:
    """Raise if a test of severity ``error`` failed or was skipped; warnings pass.

    ``optional`` names tables whose skipped tests are not missed.
    """
    failed = results.filter("status = 'fail'").collect()
    skipped = results.filter((F.col("status") == "skipped") & (F.col("severity") == "error") & ~F.col("table_name").isin(*optional)).collect()
    if failed:
        names = ", ".join(f"{r.table_name}.{r.column_name} {r.test} ({r.failures})" for r in failed)
        raise ValueError(f"{len(failed)} data tests failed: {names}")
    if skipped:
        raise ValueError(f"{len(skipped)} data tests could not run, tables missing: {sorted({r.table_name for r in skipped})}")


def null_fraction(df: DataFrame, column: str) -> DataFrame:
    """NULL share of a column in one pass; the share of an empty table is NULL."""
    counts = df.agg(F.count_if(F.col(column).isNull()).alias("nulls"), F.count("*").alias("total"))
    share = F.try_divide(F.col("nulls").cast("double"), F.col("total").cast("double"))
    return counts.select("nulls", "total", share.alias("null_fraction"))


def null_fraction_exceeded(df: DataFrame, column: str, limit: float = NULL_CUSTOMER_LIMIT) -> DataFrame:
    """One row if more than ``limit`` of a non-empty table is NULL."""
    return null_fraction(df, column).filter((F.col("total") > 0) & (F.col("null_fraction") > limit))


def freshness(loads: DataFrame, as_of: Column) -> DataFrame:
    """Age of the newest row per source against the source's limits.

    ``loads(source, ingested_at)`` may be all rows or already one per source.
    Sources without limits are left out.
    """
    newest = loads.groupBy("source").agg(F.max("ingested_at").alias("newest"))
    off = [s for s, limits in FRESHNESS.items() if limits is None]
    warn = _limit(0)
    error = _limit(1)
    age = F.timestamp_diff("MICROSECOND", F.col("newest"), as_of) / F.lit(3.6e9)
    return newest.filter(~F.col("source").isin(*off)).select(
        "source",
        "newest",
        age.alias("age_hours"),
        F.when(F.col("newest").isNull() | (age > error), "error").when(age > warn, "warn").otherwise("pass").alias("status"),
    )


def _limit(i: int) -> Column:
    chosen = None
    for source, limits in FRESHNESS.items():
        if limits is not None:
            hit = F.col("source") == source
            chosen = F.when(hit, limits[i]) if chosen is None else chosen.when(hit, limits[i])
    return chosen.otherwise(DEFAULT_FRESHNESS[i])  # type: ignore[union-attr]


def tally(results: DataFrame) -> DataFrame:
    """``results(kind, status)`` of models and tests as one row of counts.

    Warnings and errors count in the total only; ``build_ok`` is false if a test failed or was skipped.
    """
    model, test = F.col("kind") == "model", F.col("kind") == "test"
    return results.agg(
        F.count_if(model & (F.col("status") == "success")).alias("models_built"),
        F.count_if(test).alias("tests_total"),
        F.count_if(test & (F.col("status") == "pass")).alias("tests_passed"),
        F.count_if(test & (F.col("status") == "fail")).alias("tests_failed"),
        F.count_if(test & (F.col("status") == "skipped")).alias("skipped"),
    ).withColumn("build_ok", (F.col("tests_failed") == 0) & (F.col("skipped") == 0)).drop("skipped")
