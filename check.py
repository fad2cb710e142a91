"""Compare registered queries with their SQL: ``python check.py [sf dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

from tradeloom.catalog import ORACLES, QUERIES
from tradeloom.session import local_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def oracle_connection(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{Path(sf) / name}.parquet')")
    return con


def _plain(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (pd.Timestamp,)):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "item"):
        return _plain(v.item())
    if type(v).__name__ == "Decimal":
        return round(float(v), 6)
    return v


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark, con, sf: str, name: str) -> tuple[bool, str]:
    df = QUERIES[name](spark, sf)
    got_cols, got = rows_of(df.columns, df.collect())
    res = con.execute(ORACLES[name])
    cols = [d[0] for d in res.description]
    types = dict(zip(cols, [str(d[1]) for d in res.description]))
    want_cols, want = rows_of(cols, res.fetchall())
    if got_cols != want_cols:
        return False, f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return False, f"rows {len(got)} != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            bad = [(c, a, b) for c, a, b in zip(got_cols, g, w) if a != b]
            return False, f"values differ (spark, sql): {bad}"[:600]
    kinds = {c: (t, types[c]) for c, t in df.dtypes if not _same_kind(t, types[c])}
    return True, f"{len(got)} rows" + (f"  type notes {kinds}" if kinds else "")


def _same_kind(spark_type: str, sql_type: str) -> bool:
    pairs = {
        "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE",
        "timestamp_ntz": "TIMESTAMP",
    }
    return pairs.get(spark_type) == sql_type


def main(argv: list[str]) -> int:
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = local_session("check")
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf)
    failed = 0
    for name in names:
        start = time.time()
        try:
            ok, note = compare(spark, con, sf, name)
        except Exception as e:  # noqa: BLE001
            ok, note = False, f"{type(e).__name__}: {str(e)[:700]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:26s} {time.time() - start:6.1f}s  {note}", flush=True)
    print(f"{len(names) - failed} of {len(names)} match")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
