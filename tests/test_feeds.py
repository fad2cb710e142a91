"""Documents gathered from the rows of flat tables."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tradeloom.catalog import feeds


@pytest.fixture
def lines(spark):
    """Keys of 1 to 50 rows and rows without a key; ids are spread over 60 bits."""
    id = F.expr("conv(substring(md5(cast(id AS string)), 1, 15), 16, 10)").cast("bigint")
    key = F.when(F.col("id") % 7 == 0, 1).when(F.col("id") % 11 != 0, F.col("id") % 60)
    return spark.range(350).select(id.alias("line_id"), key.cast("bigint").alias("k"), (F.col("id") % 5).alias("v"))


def expected(lines):
    by_key = {}
    for r in lines.collect():
        if r.k is not None:
            by_key.setdefault(r.k, []).append((r.line_id, r.v))
    four = ((k, part, sorted(held)[part * 4 : part * 4 + 4]) for k, held in by_key.items() for part in range(-(-len(held) // 4)))
    return sorted(four)


@pytest.mark.parametrize("most", [1000, 10, 1])
def test_a_key_has_as_many_documents_as_it_needs(spark, lines, most):
    got = feeds.in_documents(lines, ["k"], ["line_id", "v"], most)
    assert sorted((r.k, r.part, [tuple(x) for x in r.ls]) for r in got.collect()) == expected(lines)


def test_rows_are_shuffled_once(spark, lines, tmp_path):
    lines.write.parquet(str(tmp_path / "lines"))
    stored = spark.read.parquet(str(tmp_path / "lines"))
    plan = feeds.in_documents(stored, ["k"], ["line_id", "v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1


def test_orders_keep_their_lines_and_read_them_once(spark, tmp_path):
    order = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    spark.sql("SELECT id, id % 3, 'F', 9.5D, TIMESTAMP '1998-01-02', '2-HIGH' FROM range(1, 5)").toDF(*[c.split()[0] for c in order.split(", ")]).write.parquet(str(tmp_path / "orders.parquet"))
    # Order 1 has ten lines, order 2 three that came back, 3 and 4 have none, and two lines have no order.
    spark.sql("""SELECT CASE WHEN id < 10 THEN 1 WHEN id < 13 THEN 2 END AS l_orderkey, id + 5 AS l_partkey, id AS l_suppkey,
        CAST(id % 7 AS int) AS l_linenumber, 2.0D AS l_quantity, id + 0.25D AS l_extendedprice, 0.04D AS l_discount, 0.01D AS l_tax,
        CASE WHEN id BETWEEN 10 AND 12 THEN 'R' ELSE 'N' END AS l_returnflag, 'O' AS l_linestatus,
        TIMESTAMP '1998-02-03' AS l_shipdate FROM range(15)""").write.parquet(str(tmp_path / "lineitem.parquet"))
    items = feeds.order_items(spark, str(tmp_path))
    plan = items._jdf.queryExecution().executedPlan().toString()
    assert plan.count("struct<l_orderkey") == 1 and "SortMergeJoin" in plan and "Broadcast" not in plan
    schema = "id bigint, total_refunded string, line_items array<struct<id: bigint, price: string>>, refunds array<struct<id: bigint>>"
    docs = items.select(F.from_json("item", schema).alias("d")).select("d.*")
    shown = docs.select("id", F.size("line_items").alias("n"), F.size("refunds").alias("back"), "total_refunded")
    ids = {r.line_id: r.price for r in feeds.line_rows(spark, str(tmp_path)).filter("l_orderkey = 2").collect()}
    back = sum(price for id, price in ids.items() if id % 29)
    assert rows(shown, "*") == sorted([
        (1, 4, 0, "0.00"), (1 + 10**12, 4, 0, "0.00"), (1 + 2 * 10**12, 2, 0, "0.00"), (2, 3, 3, f"{back:.2f}"),
        (3, 0, 0, "0.00"), (4, 0, 0, "0.00"),
    ], key=str)


def test_documents_of_small_files_are_made_by_all_cores(spark, tmp_path):
    spark.sql("SELECT id AS p_partkey, 'a b' AS p_name, 'B' AS p_brand, 'T' AS p_type, 3 AS p_size, 1.5D AS p_retailprice FROM range(100)").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    items = feeds.product_items(spark, str(tmp_path))
    assert items.count() == 100 and items.rdd.getNumPartitions() > 1
