from __future__ import annotations

from collections import defaultdict

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from tradeloom.llm.queries import ORACLES, QUERIES

from .conftest import messy_rows
from .test_near_copies import jaccard_truth

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, messy, labels, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    messy.write.parquet(f"{path}/documents.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    return path


def test_every_stage_of_messy_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in pipeline.STAGES:
        before = {(r["doc_id"], r["text"]) for r in docs.collect()}
        columns = docs.columns
        docs = stage(spark, docs, folder)
        if name != "packing":
            assert docs.columns == columns
            assert {(r["doc_id"], r["text"]) for r in docs.collect()} <= before
    assert docs.count() > 0


@pytest.mark.parametrize("name,stage", pipeline.STAGES)
def test_every_stage_of_no_documents(spark, folder, none, name, stage):
    assert stage(spark, none, folder).count() == 0


def test_run_as_its_stages_one_by_one(spark):
    found = pipeline.run(spark, SF)
    rows = duckdb.connect().execute(f"SELECT doc_id, text, lang, source, n_chars FROM '{SF}/documents.parquet'").fetchall()
    docs = pipeline.table(spark, SF, "documents")
    stay = {r["doc_id"] for r in pipeline.good_quality(spark, pipeline.language(spark, docs, SF), SF).collect()}
    last = {}
    for r in sorted(r for r in rows if r[0] in stay):
        last[r[1]] = r
    left = list(last.values())
    want = {c for _, c in jaccard_truth(left)}
    tokens = defaultdict(int)
    for r in found.collect():
        tokens[r["doc_id"]] += r["tokens"]
    assert dict(tokens) == {r[0]: len(r[1].split()) for r in left if r[0] in want}
    assert len(stay) > 0.7 * len(rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered_queries(spark, name):
    found = entry.queries()[name](spark, SF)
    if name not in ORACLES:
        assert found.count() > 0
        return
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(found.columns)
    assert sorted(map(tuple, found.select(*columns).collect()), key=str) == sorted(want.fetchall(), key=str)


def test_messy_rows_hold_what_they_should():
    rows = messy_rows()
    assert all(any(r[i] is None for r in rows) for i in range(5)) and len(rows) > len(set(rows))
