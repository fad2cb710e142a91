"""Queries on scalar functions and JSON access, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeloom.catalog.feeds import line_rows, raw, table
from tradeloom.catalog.flat import dbl, dk, sk, sql
from tradeloom.catalog.registry import query
from tradeloom.functions.documents import parse, strict, typed
from tradeloom.functions.keys import date_key, surrogate_key
from tradeloom.functions.values import blank_to_null, days_before, months_after, payment_method, product_title
from tradeloom.operators import staging as st
from tradeloom.operators.dimensions import calendar_parts
from tradeloom.operators.state import SHOP_TIME_ZONE


@query(
    "surrogate_keys",
    sql(f"""SELECT line_id, {sk('line_id')} AS one, {sk('l_orderkey', 'line_id')} AS two,
{sk('l_partkey', 'note', 'CAST(l_shipdate AS DATE)')} AS three, {sk('note')} AS missing
FROM (SELECT *, CASE WHEN l_linestatus = 'O' THEN l_returnflag END AS note FROM line_rows)"""),
)
def _(spark, sf):
    note = F.when(F.col("l_linestatus") == "O", F.col("l_returnflag"))
    return line_rows(spark, sf).select(
        "line_id",
        surrogate_key("line_id").alias("one"),
        surrogate_key("l_orderkey", "line_id").alias("two"),
        surrogate_key("l_partkey", note, F.to_date("l_shipdate")).alias("three"),
        surrogate_key(note).alias("missing"),
    )


@query(
    "date_keys",
    f"""SELECT o_orderkey, {dk('o_orderdate')} AS order_key, {dk("o_orderdate + INTERVAL '20 hours' + INTERVAL '7 hours'")} AS shop_key,
CAST(o_orderdate + INTERVAL '20 hours' AS DATE) AS day FROM orders""",
)
def _(spark, sf):
    """An order at 20:00 UTC falls on the shop's next day."""
    at = F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 20 HOURS")
    return table(spark, sf, "orders").select(
        "o_orderkey", date_key("o_orderdate").alias("order_key"),
        date_key(F.from_utc_timestamp(at, SHOP_TIME_ZONE)).alias("shop_key"), F.to_date(at).alias("day"),
    )


@query(
    "calendar_parts",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
CAST(month(o_orderdate) AS INTEGER) AS month_of_year, CAST(day(o_orderdate) AS INTEGER) AS day_of_month,
CAST(dayofweek(o_orderdate) AS INTEGER) AS day_of_week, CAST(weekofyear(o_orderdate) AS INTEGER) AS week_of_year,
dayofweek(o_orderdate) IN (0, 6) AS is_weekend FROM orders""",
)
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", *calendar_parts(F.to_date("o_orderdate")))


@query(
    "null_handling",
    """SELECT conv_id, turn, nullif(trim(lower(role)), '') AS role, coalesce(nullif(trim(lower(gateway)), ''), 'unknown') AS method
FROM (SELECT *, CASE WHEN turn % 3 = 0 THEN '' WHEN turn % 3 = 1 THEN '  ' || role || ' ' END AS gateway FROM conversations)""",
)
def _(spark, sf):
    turn = F.col("turn") % 3
    gateway = F.when(turn == 0, "").when(turn == 1, F.concat(F.lit("  "), "role", F.lit(" ")))
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", blank_to_null(F.trim(F.lower("role"))).alias("role"), payment_method(gateway).alias("method")
    )


@query(
    "strip_title_suffix",
    """SELECT doc_id, nullif(regexp_replace(source || ' - ' || lang || ' - v' || doc_id, ' - [^-]+$', ''), '') AS two_parts,
nullif(regexp_replace(text, ' - [^-]+$', ''), '') AS whole_text,
nullif(regexp_replace(' - ' || lang, ' - [^-]+$', ''), '') AS nothing_left FROM documents""",
)
def _(spark, sf):
    dash = F.lit(" - ")
    return table(spark, sf, "documents").select(
        "doc_id",
        product_title(F.concat("source", dash, "lang", dash, F.lit("v"), "doc_id")).alias("two_parts"),
        product_title(F.col("text")).alias("whole_text"),
        product_title(F.concat(dash, "lang")).alias("nothing_left"),
    )


@query(
    "json_paths",
    sql("""SELECT order_id AS id, CASE WHEN o_orderkey % 17 <> 0 AND o_orderkey % 10 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS nested,
CASE WHEN o_orderkey % 17 = 0 THEN '' WHEN o_orderkey % 10 = 0 THEN CAST(o_custkey AS VARCHAR) END AS flat,
'{"city":"City ' || (o_custkey % 25) || '"}' AS object, CAST(NULL AS VARCHAR) AS json_null, CAST(NULL AS VARCHAR) AS absent
FROM headers"""),
)
def _(spark, sf):
    fields = [
        strict("id", "id", "bigint"), strict("nested", "customer.id"), strict("flat", "customer_id"),
        strict("object", "shipping_address"), strict("json_null", "billing_address"), strict("absent", "no_such_field"),
    ]
    docs = parse(raw(spark, sf, "orders").select("payload"), fields)
    return docs.select(*typed(fields, "doc"))


@query(
    "json_explode",
    sql("SELECT p_partkey AS product_id, p_partkey * 10 + i AS variant_id, 'V' || i AS title FROM part, range(3) t(i)"),
)
def _(spark, sf):
    """The element without an id vanishes."""
    return st.variants(st.products(raw(spark, sf, "products"), keep=["product_id", "variants_json"])).select(
        "product_id", "variant_id", "title"
    )


@query(
    "typed_casts",
    sql(f"""SELECT line_id AS l, qty AS i, {dbl('price')}, CAST(CAST(pct AS DECIMAL(18,3)) / 1000 AS DOUBLE) AS weight,
l_returnflag = 'R' AS b, l_shipdate + INTERVAL 250 MILLISECOND AS t, CAST(l_shipdate AS DATE) AS d,
CASE WHEN l_linestatus <> 'O' THEN qty END AS optional FROM line_rows"""),
)
def _(spark, sf):
    """Every type a document field can become, out of text."""
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    text = line_rows(spark, sf).select(
        F.col("line_id").cast("string").alias("l"), F.col("qty").cast("string").alias("i"),
        F.col("price").cast("string").alias("price"),
        F.concat(F.lit("0."), F.lpad(F.col("pct").cast("string"), 3, "0")).alias("weight"),
        F.when(F.col("l_returnflag") == "R", "true").otherwise("false").alias("b"),
        F.concat(day, F.lit("T00:00:00.250Z")).alias("t"), day.alias("d"),
        F.when(F.col("l_linestatus") == "O", "").otherwise(F.col("qty").cast("string")).alias("optional"),
    )
    return text.select(
        F.col("l").cast("bigint"), F.col("i").cast("int"), F.col("price").cast("decimal(18,2)"),
        F.col("weight").cast("decimal(18,3)"), F.col("b").cast("boolean"), F.col("t").cast("timestamp"),
        F.col("d").cast("date"), blank_to_null(F.col("optional")).cast("int").alias("optional"),
    )


@query(
    "date_arithmetic",
    """SELECT o_orderkey, CAST(o_orderdate + INTERVAL 4 YEAR AS DATE) AS in_four_years, o_orderdate - INTERVAL 30 DAY AS floor_30,
CAST(o_orderdate - INTERVAL 90 DAY AS DATE) AS floor_90 FROM orders""",
)
def _(spark, sf):
    day = F.to_date("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", months_after(day, 48).alias("in_four_years"),
        days_before(F.col("o_orderdate").cast("timestamp"), 30).alias("floor_30"),
        days_before(day, 90).cast("date").alias("floor_90"),
    )
