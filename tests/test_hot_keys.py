"""Results where one key of each table holds a third of the rows."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from check import TABLES, compare, oracle_connection  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the benchmark tables")

# Every third row gets the same keys.
HOT = {
    "lineitem": {
        "l_orderkey": "7", "l_partkey": "5", "l_suppkey": "3", "l_shipdate": "TIMESTAMP '1999-05-05'",
    },
    "orders": {"o_custkey": "9"},
    "events": {"user_id": "1"},
}
QUERIES = [
    "stg_orders", "stg_transactions", "stg_adjustments", "order_lines", "latest_variant_seen", "order_net_revenue",
    "orders_with_customer", "fct_orders", "dim_products", "star_revenue_by_product", "guarded_upsert", "batch_dedupe",
    "snapshot_upsert", "dq_unique", "dq_relationships", "count_drift", "merge_order_lines",
]


@pytest.fixture(scope="module")
def hot(tmp_path_factory):
    folder = tmp_path_factory.mktemp("hot")
    for name in TABLES.split():
        hot_columns = HOT.get(name, {})
        changes = ", ".join(
            f"CASE WHEN file_row_number % 3 = 0 THEN {value} ELSE {column} END AS {column}" for column, value in hot_columns.items()
        )
        columns = f"* EXCLUDE (file_row_number) REPLACE ({changes})" if changes else "* EXCLUDE (file_row_number)"
        duckdb.execute(
            f"COPY (SELECT {columns} FROM read_parquet('{SF}/{name}.parquet', file_row_number = true)) "
            f"TO '{folder / name}.parquet' (FORMAT parquet)"
        )
    return str(folder)


@pytest.fixture(scope="module")
def oracle(hot):
    return oracle_connection(hot)


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql_on_hot_keys(spark, oracle, hot, name):
    ok, note = compare(spark, oracle, hot, name)
    assert ok, note
