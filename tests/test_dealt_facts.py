"""Facts are dealt out by partition before they get their hash keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeloom.functions.keys import surrogate_key
from tradeloom.plans.star import StarBuild


def test_rows_are_dealt_out_without_hash_keys(spark, tmp_path):
    refunds = spark.range(40).select(
        (F.col("id") * 3).alias("refund_id"), F.when(F.col("id") > 3, F.col("id")).alias("order_id"), F.lit("x").alias("note")
    )
    refunds = refunds.unionByName(refunds.limit(1).withColumn("refund_id", F.lit(None).cast("long")))
    star = StarBuild(spark, {}, str(tmp_path), None, None, None, id_bucket=50)
    plans = []

    def make(rows):
        made = rows.select(surrogate_key("refund_id").alias("refund_key"), "refund_id", "order_id", "note")
        plans.append(made._jdf.queryExecution().optimizedPlan().toString())
        return made

    got = star._merge_fact(make, "fct_refunds", refunds)
    assert sorted(map(str, got.collect())) == sorted(map(str, make(refunds).collect()))
    assert got.columns == ["refund_key", "refund_id", "order_id", "note"]
    assert star._stored["fct_refunds"].snapshot().parts == {"0", "1", "2", "none"}
    keyed, dealt = plans[0].find("md5"), plans[0].find("RebalancePartitions")
    assert 0 <= keyed < dealt and "md5" not in plans[0][dealt:]


def test_facts_of_orders_stay_where_the_staged_orders_are(spark, tmp_path):
    staged = spark.range(40).select(F.col("id").alias("order_id"), F.lit("x").alias("note"))
    star, plans = StarBuild(spark, {}, str(tmp_path), None, None, None, id_bucket=50, order_bucket=20), []

    def make(rows):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return rows

    got = star._merge_fact(make, "fct_orders", staged)
    assert sorted(r.order_id for r in got.collect()) == list(range(40))
    assert star._stored["fct_orders"].snapshot().parts == {"0", "1"}
    assert "RebalancePartitions" not in plans[0]
