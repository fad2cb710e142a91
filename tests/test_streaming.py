"""Page files and append-only rows as streams."""

import json

from conftest import rows
from pyspark.sql import functions as F

from tradeloom.sources.domains import domain
from tradeloom.sources.tables import KeyedTable
from tradeloom.streaming.append import append_new, stream_append
from tradeloom.streaming.landing import stream_landing


def envelope(n, *items):
    docs = [{"id": i, "name": name, "updated_at": f"2026-01-{day:02d}T00:00:00Z"} for i, name, day in items]
    return json.dumps({"page": n, "orders": docs}) + "\n"


def test_files_arriving_over_time(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    store = KeyedTable(spark, str(tmp_path / "raw"), ["id"], "id div 10")

    def land():
        job = stream_landing(spark, str(pages), store, domain("orders"), str(tmp_path / "cp"), "run", files_per_batch=1)
        job.awaitTermination()
        name = F.get_json_object("payload", "$.name").alias("name")
        return rows(store.read().select("id", name), "*")

    (pages / "1.jsonl").write_text(envelope(1, (1, "a", 5), (2, "b", 5), (1, "a again", 5)))
    assert land() == [(1, "a again"), (2, "b")]
    # Late documents: an older version of 1, a newer one of 2, and an unknown 30.
    (pages / "2.jsonl").write_text(envelope(2, (1, "late", 4), (2, "newer", 6), (30, "c", 1)))
    assert land() == [(1, "a again"), (2, "newer"), (30, "c")]
    assert land() == [(1, "a again"), (2, "newer"), (30, "c")]


def test_append_keeps_the_first_row_of_an_id(spark, tmp_path):
    store = KeyedTable(spark, str(tmp_path / "t"), ["id"], "id div 10")
    schema = "id bigint, v string, page int, position int"
    append_new(store, spark.createDataFrame([(1, "late", 2, 0), (1, "first", 1, 0), (15, "x", 1, 1)], schema))
    append_new(store, spark.createDataFrame([(1, "again", 3, 0), (2, "new", 3, 1)], schema))
    assert rows(store.read(), "*") == [(1, "first"), (15, "x"), (2, "new")]


def test_stream_append_is_replay_safe(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(20).selectExpr("id", "concat('v', id) AS v").write.parquet(source)
    store = KeyedTable(spark, str(tmp_path / "t"), ["id"], "id div 10")
    for attempt in range(2):
        stream = spark.readStream.schema("id bigint, v string").parquet(source)
        stream_append(stream, store, str(tmp_path / f"cp{attempt}")).awaitTermination()
    assert store.read().count() == 20
