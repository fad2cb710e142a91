"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Every result is
computed in full and discarded, so nothing is pruned and nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tradeloom.catalog import QUERIES
from tradeloom.catalog.feeds import GATHERED, raw
from tradeloom.session import local_session

HEADLINE = [
    "star_build",
    "stg_orders",
    "stg_transactions",
    "order_lines",
    "order_net_revenue",
    "latest_variant_seen",
    "orders_with_customer",
    "dim_products",
    "dim_variants",
    "dim_payment_methods",
    "fct_orders",
    "fct_order_lines",
    "fct_transactions",
    "fct_inventory_snapshot",
    "star_revenue_by_product",
    "merge_orders_30d",
    "merge_order_lines",
    "guarded_upsert",
    "ingest_pages",
    "stream_landing",
    "id_batches",
    "inventory_grid",
    "latest_run_per_domain",
    "archive_split",
    "dq_relationships",
    "dq_results",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    start = time.perf_counter()
    for feed in GATHERED:
        raw(spark, sf_dir, feed)
    times["land_documents"] = round(time.perf_counter() - start, 3)
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    line = {"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": float(sf)}
    print(json.dumps(line))


if __name__ == "__main__":
    main()
