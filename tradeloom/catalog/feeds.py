"""Commerce documents made from the flat benchmark tables.

The engine reads nested JSON documents; the given tables are flat. These
functions turn whole tables into feeds, deterministically and with integer
arithmetic, so that SQL over the flat tables can state the expected results.
Ids of documents, "" and missing fields vary with the row to exercise the rules
for each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeloom.functions.keys import date_key
from tradeloom.operators.upsert import last_arrivals
from tradeloom.session import DENSE, scratch, shuffles_freed
from tradeloom.sources.raw import location_rows, raw_rows, scan, snapshot_rows

RUN_ID = "00000000-0000-0000-0000-000000000001"
AS_OF = "2024-02-01 00:00:00"
#: Rows of a document, bits of a row id, and how far apart the ids of a key's documents are.
ROWS, ID_BITS = 4, 60
NEXT_DOCUMENT, NEXT_ADJUSTMENT = 10**12, 10**13
#: Rows of a key beyond which several tasks share it.
HOT_ROWS = 100_000
MONEY = "decimal(18,2)"
EXPLICIT_NULLS = {"ignoreNullFields": "false"}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Rows of a file that is small beside the documents made from them, dealt out to all cores."""
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism)


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def iso(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def day_after(start: str, days: Column) -> Column:
    return F.concat(F.date_add(F.lit(start).cast("date"), days.cast("int")).cast("string"), F.lit("T00:00:00Z"))


def money(c: str) -> Column:
    return F.col(c).cast(MONEY)


def _hundredths(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def line_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with a unique id: the first 60 bits of an md5 over the row.

    (Order key and line number repeat in the data; the whole row does not.)
    """
    li = table(spark, sf, "lineitem")
    text = F.concat_ws(
        "|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", _hundredths("l_quantity"),
        _hundredths("l_extendedprice"), _hundredths("l_discount"), _hundredths("l_tax"),
        "l_returnflag", "l_linestatus", date_key("l_shipdate"),
    )
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate",
        F.col("l_quantity").cast("int").alias("qty"),
        money("l_extendedprice").alias("price"),
        F.round(F.col("l_discount") * 100).cast("int").alias("pct"),
        F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint").alias("line_id"),
    )


def in_documents(rows: DataFrame, keys: Sequence[str], carried: Sequence[str], most: int = HOT_ROWS) -> DataFrame:
    """Rows of each key dealt out to documents of ``ROWS`` rows at most, in the order of ``carried``, an id first.

    Returns the keys, ``part``, which numbers a key's documents, and ``ls``, a document's rows. Rows without
    a key have no document. All rows are shuffled once: a document starts at every ``ROWS``-th row
    of its key and takes the rows that follow. Only a key of more than ``most`` rows is spread over several tasks.
    """
    known = rows.dropna(subset=list(keys)).select(*keys, *carried)
    counts = rows.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("_n"))
    # Few whatever the input: each stands for more than ``most`` rows.
    hot = hot_keys(counts, keys, most)
    if hot is None:
        return _in_turn(known, keys, carried)
    cold = _in_turn(known.join(F.broadcast(hot), list(keys), "left_anti"), keys, carried)
    return cold.unionByName(_in_slices(known.join(F.broadcast(hot), list(keys), "left_semi"), keys, carried))


def hot_keys(counts: DataFrame, keys: Sequence[str], most: int = HOT_ROWS) -> DataFrame | None:
    """Keys that have more than ``most`` rows by their counts ``_n``; None if there are none."""
    with shuffles_freed(counts.sparkSession):
        found = counts.filter(F.col("_n") > most).select(*keys).collect()
    return counts.sparkSession.createDataFrame(found, counts.select(*keys).schema) if found else None


def _in_turn(rows: DataFrame, keys: Sequence[str], carried: Sequence[str]) -> DataFrame:
    # Ordered by the row itself, so that its columns aren't shuffled a second time beside it.
    turn = Window.partitionBy(*keys).orderBy("_0")
    following = [F.lead("_0", i).over(turn).alias(f"_{i}") for i in range(1, ROWS)]
    listed = rows.select(*keys, F.struct(*carried).alias("_0")).select("*", *following, (F.row_number().over(turn) - 1).alias("_nth"))
    ls = F.filter(F.array(*[f"_{i}" for i in range(ROWS)]), lambda x: x.isNotNull())
    return listed.filter(F.col("_nth") % ROWS == 0).select(*keys, F.floor(F.col("_nth") / ROWS).cast("bigint").alias("part"), ls.alias("ls"))


def _in_slices(rows: DataFrame, keys: Sequence[str], carried: Sequence[str]) -> DataFrame:
    """The same in two levels: rows are numbered within slices of the ids, and from one slice of a key to the next."""
    row_id = carried[0]
    sliced = rows.withColumn("_slice", F.shiftright(F.col(row_id), ID_BITS - 8))
    inner = F.row_number().over(Window.partitionBy(*keys, "_slice").orderBy(*carried))
    upto = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = sliced.groupBy(*keys, "_slice").agg(F.count("*").alias("_n"))
    before = counts.select(*keys, "_slice", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"))
    numbered = sliced.withColumn("_nth", inner).join(before, [*keys, "_slice"])
    part = F.floor((F.col("_before") + F.col("_nth") - 1) / ROWS).cast("bigint")
    listed = numbered.groupBy(*keys, part.alias("part"))
    return listed.agg(F.sort_array(F.collect_list(F.struct(*carried))).alias("ls"))


def sold_as(part: Column) -> Column:
    """The product an order mentions: every tenth part is sold under an id that is listed nowhere."""
    return F.when(part % 10 == 9, part + 10**9).otherwise(part)


def _gateway(priority: str) -> Column:
    p = F.col(priority)
    return (
        F.when(p == "1-URGENT", " COD ").when(p == "2-HIGH", "VNPay").when(p == "3-MEDIUM", "").when(p == "5-LOW", "bank_transfer")
    )


def _line_item(x: Column) -> Column:
    blank = F.lit("")
    return F.struct(
        x.line_id.alias("id"),
        F.when(x.line_id % 11 == 0, blank).otherwise(sold_as(x.l_partkey).cast("string")).alias("product_id"),
        F.when(x.line_id % 23 != 0, sold_as(x.l_partkey) * 10 + x.l_linenumber % 3).alias("variant_id"),
        x.qty.cast("string").alias("quantity"),
        x.price.cast("string").alias("price"),
        F.when(x.pct > 5, (x.price + 10).cast("string")).alias("price_original"),
        F.when(x.pct == 0, blank).otherwise(F.concat(x.pct.cast("string"), F.lit(".5"))).alias("total_discount"),
        F.concat(F.lit("SKU-"), x.l_partkey).alias("sku"),
        F.when(x.l_partkey % 29 == 0, blank)
        .otherwise(F.concat(F.lit("Item "), x.l_partkey, F.lit(" - "), x.l_linenumber)).alias("title"),
        F.when(x.l_linenumber % 2 == 0, F.concat(F.lit("V"), x.l_linenumber % 3)).alias("variant_title"),
    )


def _refund_transaction(x: Column, status: str, gateway: Column) -> Column:
    return F.struct(
        x.line_id.alias("id"),
        F.when(x.line_id % 31 == 0, "chargeback").otherwise("refund").alias("kind"),
        F.lit(status).alias("status"),
        gateway.alias("gateway"),
        x.price.cast("string").alias("amount"),
        iso(x.l_shipdate).alias("created_at"),
    )


def _refund(x: Column, gateway: Column) -> Column:
    return F.struct(
        x.line_id.alias("id"),
        iso(x.l_shipdate).alias("created_at"),
        F.when(x.l_linestatus == "O", "").alias("note"),
        F.when(x.l_linestatus == "O", "customer").otherwise("damaged").alias("reason"),
        F.when(x.line_id % 29 == 0, "").otherwise(x.price.cast("string")).alias("amount"),
        (x.line_id % 2 == 0).alias("restock"),
        F.array(F.struct(x.line_id.alias("line_item_id"), x.qty.alias("quantity"))).alias("refund_line_items"),
        F.array(_refund_transaction(x, "success", gateway)).alias("transactions"),
    )


def order_items(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with nested line items, refunds and transactions."""
    carried = [
        "line_id", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate", "qty", "price", "pct",
    ]
    nested = in_documents(line_rows(spark, sf), ["l_orderkey"], carried).withColumnRenamed("l_orderkey", "o_orderkey")
    headers = table(spark, sf, "orders")
    # Sent whole to the tasks that read the headers, the documents would be made by as few as there are header files.
    o = headers.join(nested.hint("merge"), "o_orderkey", "left").withColumns({"ls": F.coalesce("ls", F.array()), "part": F.coalesce("part", F.lit(0))})
    k, status = F.col("o_orderkey"), F.col("o_orderstatus")
    order_id = (k + F.col("part") * NEXT_DOCUMENT).cast("bigint")
    total = F.when(F.col("part") == 0, money("o_totalprice")).otherwise(F.lit(0).cast(MONEY)).cast("string")
    gateway = _gateway("o_orderpriority")
    returned = F.filter("ls", lambda x: x.l_returnflag == "R")
    guest = k % 17 == 0
    flat = k % 10 == 0
    sale = F.struct(
        order_id.alias("id"), F.lit("sale").alias("kind"), F.lit("success").alias("status"), gateway.alias("gateway"),
        total.alias("amount"), iso(F.col("o_orderdate")).alias("created_at"),
    )
    copies = F.transform(
        F.filter(returned, lambda x: x.line_id % 2 == 0), lambda x: _refund_transaction(x, "pending", gateway)
    )
    drift = F.when(k % 19 == 0, F.lit("2.50").cast(MONEY)).otherwise(F.lit(0).cast(MONEY))
    back = F.aggregate(
        F.filter(returned, lambda x: (x.line_id % 29 != 0) & x.price.isNotNull()),
        F.lit(0).cast("decimal(28,2)"), lambda sum, x: (sum + x.price).cast("decimal(28,2)"),
    )
    reported = (back + drift).cast(MONEY).cast("string")
    doc = F.struct(
        order_id.alias("id"),
        F.concat(F.lit("#"), order_id).alias("name"),
        order_id.cast("string").alias("order_number"),
        F.when(~guest & ~flat, F.struct(F.col("o_custkey").alias("id"))).alias("customer"),
        F.when(guest, "").when(flat, F.col("o_custkey").cast("string")).alias("customer_id"),
        F.when(k % 13 == 0, "").otherwise((F.col("o_custkey") % 25).cast("string")).alias("location_id"),
        F.lit("VND").alias("currency"),
        F.when(status == "F", "paid").when(status == "O", "pending").otherwise("partially_paid").alias("financial_status"),
        F.when(status == "F", "fulfilled").when(status == "P", "partial").alias("fulfillment_status"),
        total.alias("subtotal_price"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "").otherwise("0").alias("total_discounts"),
        F.when(k % 7 != 0, (k % 1000) * F.lit(0.25)).alias("total_tax"),
        (k % 50).alias("total_shipping"),
        total.alias("total_price"),
        F.when(k % 5 == 0, "").otherwise(reported).alias("total_refunded"),
        iso(F.col("o_orderdate")).alias("created_at"),
        iso(F.date_add(F.to_date("o_orderdate"), (k % 40).cast("int"))).alias("updated_at"),
        F.when(status == "F", iso(F.date_add(F.to_date("o_orderdate"), 10))).otherwise("").alias("closed_at"),
        F.lit(None).cast("string").alias("cancelled_at"),
        F.struct(F.concat(F.lit("City "), F.col("o_custkey") % 25).alias("city")).alias("shipping_address"),
        F.lit(None).cast("string").alias("billing_address"),
        F.transform("ls", _line_item).alias("line_items"),
        F.transform(returned, lambda x: _refund(x, gateway)).alias("refunds"),
        F.concat(F.array(sale), copies).alias("transactions"),
    )
    return o.select(F.to_json(doc, EXPLICIT_NULLS).alias("item"))


def adjustment_items(spark: SparkSession, sf: str) -> DataFrame:
    """One stock correction per supplier and shipping month."""
    month = F.year("l_shipdate") * 100 + F.month("l_shipdate")
    carried = ["line_id", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus", "qty", "price"]
    nested = in_documents(line_rows(spark, sf).withColumn("ym", month), ["l_suppkey", "ym"], carried)

    def item(x: Column) -> Column:
        return F.struct(
            x.line_id.alias("id"),
            (x.l_partkey * 10 + x.l_linenumber % 4).alias("product_variant_id"),
            F.when(x.line_id % 37 == 0, x.l_partkey + 10**9).otherwise(x.l_partkey).alias("product_id"),
            F.when(x.l_returnflag == "R", x.qty).otherwise(-x.qty).cast("string").alias("quantity"),
            F.when(x.l_linestatus == "O", "").otherwise(x.price.cast("string")).alias("cost_amount"),
            F.concat(F.lit("SKU-"), x.l_partkey).alias("sku"),
            F.lit(None).cast("string").alias("barcode"),
        )

    s = F.col("l_suppkey")
    id = (s * 1_000_000 + F.col("ym") + F.col("part") * NEXT_ADJUSTMENT).cast("bigint")
    month_text = F.concat(F.substring(F.col("ym").cast("string"), 1, 4), F.lit("-"), F.substring(F.col("ym").cast("string"), 5, 2))
    doc = F.struct(
        id.alias("id"),
        (s % 25).alias("location_id"),
        F.when(s % 9 == 0, "").otherwise(F.concat(month_text, F.lit("-01T00:00:00Z"))).alias("created_at"),
        F.concat(month_text, F.lit("-15T12:30:00.250Z")).alias("updated_at"),
        F.when(s % 2 == 0, "recount").otherwise("damage").alias("reason"),
        F.lit(None).cast("string").alias("note"),
        F.concat(F.lit("ADJ-"), id).alias("adjust_number"),
        F.transform("ls", item).alias("line_items"),
    )
    return nested.select(F.to_json(doc).alias("item"))


def customer_items(spark: SparkSession, sf: str) -> DataFrame:
    c = spread(table(spark, sf, "customer"))
    doc = F.struct(
        F.col("c_custkey").alias("id"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.when(F.col("c_nationkey") % 2 == 0, F.concat(F.lit("+84"), F.col("c_custkey"))).alias("phone"),
        F.lit("Customer").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.when(F.col("c_acctbal") < 0, "disabled").otherwise("enabled").alias("state"),
        F.col("c_mktsegment").isin("BUILDING", "MACHINERY").alias("accepts_marketing"),
        F.col("c_nationkey").alias("orders_count"),
        F.when(F.col("c_mktsegment") == "FURNITURE", "").otherwise(money("c_acctbal").cast("string")).alias("total_spent"),
        F.col("c_mktsegment").alias("tags"),
        day_after("2019-01-01", F.col("c_nationkey")).alias("created_at"),
        day_after("2020-01-01", F.col("c_custkey") % 1000).alias("updated_at"),
        F.array(F.struct(F.col("c_nationkey").cast("string").alias("country"))).alias("addresses"),
        F.when(F.col("c_nationkey") > 5, F.struct(F.lit("main").alias("label"))).alias("default_address"),
    )
    return c.select(F.to_json(doc, EXPLICIT_NULLS).alias("item"))


def product_items(spark: SparkSession, sf: str) -> DataFrame:
    p = spread(table(spark, sf, "part"))
    key, size = F.col("p_partkey"), F.col("p_size")

    def variant(i: Column) -> Column:
        return F.struct(
            F.when(i < 3, key * 10 + i).alias("id"),
            F.concat(F.lit("V"), i).alias("title"),
            F.concat(F.lit("SKU-"), key, F.lit("-"), i).alias("sku"),
            F.when(i == 1, F.concat(F.lit("B"), key)).alias("barcode"),
            money("p_retailprice").cast("string").alias("price"),
            F.when(i == 2, "").when(i == 1, (money("p_retailprice") + 5).cast("string")).alias("compare_at_price"),
            size.alias("inventory_quantity"),
            F.concat(F.lit("S"), i).alias("option1"),
            F.lit("").alias("option2"),
            F.lit(None).cast("string").alias("option3"),
            F.lit("shop").alias("inventory_management"),
            F.lit("deny").alias("inventory_policy"),
            F.concat(F.lit("0."), (size + 100).cast("string")).alias("weight"),
            F.lit("kg").alias("weight_unit"),
            F.when(i == 0, "").otherwise(day_after("2020-01-01", size)).alias("created_at"),
            day_after("2020-06-01", size + i).alias("updated_at"),
        )

    doc = F.struct(
        key.alias("id"),
        F.col("p_name").alias("title"),
        F.concat(F.regexp_replace("p_name", " ", "-"), F.lit("-"), key).alias("handle"),
        F.col("p_brand").alias("vendor"),
        F.col("p_type").alias("product_type"),
        F.lit("active").alias("status"),
        F.concat_ws(",", "p_type", "p_brand").alias("tags"),
        day_after("2020-01-01", size).alias("created_at"),
        day_after("2020-06-01", key % 300).alias("updated_at"),
        F.when(F.col("p_type") == "ECONOMY", "").otherwise(day_after("2020-02-01", size)).alias("published_at"),
        # The fourth element has no id and must vanish.
        F.transform(F.sequence(F.lit(0), F.lit(3)), variant).alias("variants"),
        F.array().cast("array<string>").alias("images"),
        F.array(F.struct(F.lit("Size").alias("name"))).alias("options"),
    )
    return p.select(F.to_json(doc).alias("item"))


def location_items(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    key = F.col("n_nationkey")
    changed = day_after("2023-01-01", key)
    doc = F.struct(
        key.alias("id"),
        F.col("n_name").alias("name"),
        F.concat(key, F.lit(" High Street")).alias("address1"),
        F.lit("").alias("address2"),
        F.concat(F.lit("City "), key).alias("city"),
        F.col("r_name").alias("province"),
        F.col("n_name").alias("country"),
        F.concat(F.lit("N"), key).alias("country_code"),
        F.lpad(key.cast("string"), 5, "0").alias("zip"),
        F.lit(None).cast("string").alias("phone"),
        (F.col("n_regionkey") != 3).alias("active"),
        F.when(key % 4 == 0, "").otherwise(day_after("2018-01-01", key)).alias("created_at"),
        F.when(key % 5 == 0, "").when(key % 2 == 0, changed).alias("updated_at"),
        F.when((key % 5 != 0) & (key % 2 == 1), changed).alias("modified_on"),
    )
    return n.select(F.to_json(doc).alias("item"))


def inventory_items(spark: SparkSession, sf: str) -> DataFrame:
    """Stock levels reported by events; several per location, variant and day."""
    level = F.floor("value").cast("int")
    doc = F.struct(
        (F.col("user_id") % 25).alias("loc_id"),
        ((F.col("event_id") % 200) * 10).alias("variant_id"),
        (level - 20).alias("available"),
        level.cast("string").alias("on_hand"),
        F.when(F.col("event_type") == "error", "").otherwise("5").alias("committed"),
    )
    return table(spark, sf, "events").select(
        F.to_json(doc).alias("item"), F.to_date("ts").alias("day"), F.col("ts").cast("timestamp").alias("seen_at"),
        F.col("event_id").alias("position"),
    )


def discount_items(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size")
    doc = F.struct(
        F.col("p_partkey").alias("id"),
        F.concat(F.lit("D"), "p_partkey").alias("code"),
        F.when(size % 2 == 0, "percentage").otherwise("fixed_amount").alias("value_type"),
        F.when(size % 5 == 0, "").otherwise(money("p_retailprice").cast("string")).alias("value"),
        F.col("p_type").alias("applies_to"),
        day_after("2020-01-01", size).alias("starts_at"),
        F.when(size > 25, "").otherwise(day_after("2020-02-01", size)).alias("ends_at"),
        size.alias("usage_count"),
        F.lit("enabled").alias("status"),
        day_after("2020-01-01", size).alias("updated_at"),
    )
    return spread(table(spark, sf, "part")).select(F.to_json(doc).alias("item"))


def promotion_items(spark: SparkSession, sf: str) -> DataFrame:
    doc = F.struct(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("title"),
        F.lit("fixed_amount").alias("value_type"),
        money("s_acctbal").cast("string").alias("value"),
        day_after("2021-01-01", F.col("s_nationkey")).alias("starts_at"),
        F.lit(None).cast("string").alias("ends_at"),
        F.when(F.col("s_acctbal") < 0, "disabled").otherwise("enabled").alias("status"),
        day_after("2021-03-01", F.col("s_nationkey")).alias("updated_at"),
    )
    return table(spark, sf, "supplier").select(F.to_json(doc).alias("item"))


def custom_collection_items(spark: SparkSession, sf: str) -> DataFrame:
    """Texts of any length and script, carried whole."""
    doc = F.struct(
        F.col("doc_id").alias("id"),
        F.col("source").alias("title"),
        F.col("lang").alias("handle"),
        F.col("text").alias("description"),
        F.when(F.col("n_chars") % 4 == 0, "").otherwise(day_after("2022-01-01", F.col("n_chars") % 365)).alias("published_at"),
        day_after("2022-01-01", F.col("doc_id") % 700).alias("updated_at"),
    )
    return table(spark, sf, "documents").select(F.to_json(doc).alias("item"))


def smart_collection_items(spark: SparkSession, sf: str) -> DataFrame:
    doc = F.struct(
        F.col("page_id").alias("id"),
        F.col("url").alias("title"),
        F.concat(F.lit("page-"), "page_id").alias("handle"),
        F.col("html").alias("description"),
        F.lit(None).cast("string").alias("published_at"),
        F.lit("2022-06-01T08:00:00+07:00").alias("updated_at"),
    )
    return table(spark, sf, "pages").select(F.to_json(doc).alias("item"))


ITEMS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "locations": location_items,
    "customers": customer_items,
    "products": product_items,
    "custom_collections": custom_collection_items,
    "smart_collections": smart_collection_items,
    "discounts": discount_items,
    "promotions": promotion_items,
    "orders": order_items,
    "inventory_adjustments": adjustment_items,
    "inventory_locations": inventory_items,
}

# Feeds whose documents are gathered from many rows: landed once per session
# and read from there, as a raw table is.
GATHERED = ("orders", "inventory_adjustments")
_landed: dict[tuple[str, str, str], str] = {}


def raw(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """Raw table of a feed."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key in _landed:
        return scan(spark, _landed[key])
    items = ITEMS[name](spark, sf)
    if name == "locations":
        return location_rows(items, RUN_ID, as_of(), as_of())
    if name == "inventory_locations":
        rows = snapshot_rows(items, RUN_ID, F.col("day"), F.col("seen_at"), as_of())
        return last_arrivals(rows.drop("day", "seen_at"))
    rows = raw_rows(items, RUN_ID, as_of())
    if name not in GATHERED:
        return rows
    path = scratch(spark, f"raw-{name}")
    with shuffles_freed(spark):
        rows.write.parquet(path, compression=DENSE)
    _landed[key] = path
    return scan(spark, path)


@contextmanager
def landed(spark: SparkSession, sf: str, name: str) -> Iterator[DataFrame]:
    """As :func:`raw`; what is landed for this block only is deleted after it."""
    key = (spark.sparkContext.applicationId, sf, name)
    others = key in _landed
    try:
        yield raw(spark, sf, name)
    finally:
        if not others and key in _landed:
            folder = spark._jvm.org.apache.hadoop.fs.Path(_landed.pop(key))
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """One run per event; purchases are still running, errors have failed."""
    kind = F.col("event_type")
    started = F.col("ts").cast("timestamp")
    ran = F.make_dt_interval(secs=F.col("value").cast("decimal(18,6)"))
    open_run = kind == "purchase"
    return table(spark, sf, "events").select(
        F.format_string("run-%012d", "event_id").alias("run_id"),
        kind.alias("domain"),
        F.when(F.col("user_id") % 2 == 0, "full").otherwise("incremental").alias("mode"),
        started.alias("started_at"),
        F.when(~open_run, started + ran).alias("ended_at"),
        F.when(~open_run, F.get_json_object("props", "$.k").cast("bigint")).alias("rows_ingested"),
        F.when(open_run, "running").when(kind == "error", "failed").otherwise("success").alias("status"),
        F.when(kind == "error", F.repeat(F.lit("boom "), (F.col("event_id") % 400).cast("int"))).alias("error_message"),
        F.lit("cron").alias("triggered_by"),
    )


def sync_state(spark: SparkSession, sf: str) -> DataFrame:
    """A loader that last ran ten days before the end of the data, and never for signups."""
    newest = table(spark, sf, "events").groupBy("event_type").agg(
        F.max("ts").cast("timestamp").alias("newest"), F.max("event_id").alias("top")
    )
    return newest.filter("event_type <> 'signup'").select(
        F.col("event_type").alias("domain"),
        (F.col("newest") - F.expr("INTERVAL 10 DAYS")).alias("last_updated_at"),
        F.lit("run-before").alias("last_run_id"),
        F.lit("2024-01-20 00:00:00").cast("timestamp").alias("updated_at"),
        F.when(F.col("event_type") != "view", F.floor(F.col("top") / 2).cast("bigint")).alias("last_high_id"),
    )
