"""Stock corrections: only what is kept is parsed, and lines are shuffled once, as one column."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tradeloom.catalog import feeds
from tradeloom.operators import staging as st

DOC = (
    '{"id": 7, "location_id": 3, "created_at": "2024-01-01T00:00:00Z", "updated_at": "", "reason": "recount", "note": null, '
    '"line_items": [{"id": 1, "product_variant_id": 10, "product_id": 5, "quantity": "-2", "cost_amount": "", "sku": "a"}, '
    '{"id": null, "product_id": 6}, {"id": 2, "product_id": null}]}'
)


def raw(spark):
    return spark.createDataFrame([(DOC,)], "payload string").select("payload", F.current_timestamp().alias("ingested_at"), F.lit("r").alias("source_run_id"))


@pytest.mark.parametrize("keep", [["product_id"], ["adjustment_id"], ["created_at", "variant_id"], ["parent_adjustment_id", "quantity_delta"]])
def test_kept_columns_are_those_of_the_whole_table(spark, keep):
    whole, some = st.inventory_adjustments(raw(spark)), st.inventory_adjustments(raw(spark), keep=keep)
    order = [c for c in st.ADJUSTMENT_COLUMNS if c in keep]
    assert some.columns == [*order, *st.ENVELOPE]
    assert sorted(map(str, some.select(*order).collect())) == sorted(map(str, whole.select(*order).collect()))
    assert whole.count() == 2


def test_only_kept_columns_are_parsed(spark):
    plan = st.inventory_adjustments(raw(spark), keep=["product_id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "product_id" in plan
    assert "cost_amount" not in plan and "adjust_number" not in plan


def test_unknown_columns_are_refused(spark):
    with pytest.raises(ValueError):
        st.inventory_adjustments(raw(spark), keep=["nothing"])


def test_lines_of_a_document_are_shuffled_as_one_column(spark):
    rows = spark.createDataFrame([(k, i, f"v{i}") for k in (1, 2) for i in range(9, -1, -1)] + [(1, 3, None), (None, 1, "x")], "k long, id long, v string")
    made = feeds.in_documents(rows, ["k"], ["id", "v"])
    got = {(r["k"], r["part"]): [tuple(x) for x in r["ls"]] for r in made.collect()}
    lines = {1: sorted([*[(i, f"v{i}") for i in range(10)], (3, None)], key=lambda x: (x[0], x[1] or "")), 2: [(i, f"v{i}") for i in range(10)]}
    assert got == {(k, at // 4): own[at : at + 4] for k, own in lines.items() for at in range(0, len(own), 4)}
    node = made._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Window":
        node = node.children().head()
    assert node.children().head().output().size() == 2
