"""Pages, raw rows and seeds."""

import json
import os
from datetime import datetime
from decimal import Decimal

import pytest
from conftest import at, rows
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tradeloom.functions.documents import parse, strict, typed
from tradeloom.operators.upsert import last_arrivals
from tradeloom.sources.domains import DOMAINS, domain
from tradeloom.sources.pages import ingest
from tradeloom.sources.raw import location_rows, raw_rows, snapshot_rows
from tradeloom.sources.seeds import read_holidays

# Some executor errors reach Python unconverted.
ERRORS = (PySparkException, Py4JJavaError)


def page(n, key, *ids):
    return json.dumps({"page": n, key: [{"id": i, "updated_at": "2026-01-02T00:00:00Z"} for i in ids]})


def test_pages_one_per_line_keep_arrival_order(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text(page(1, "orders", 5, 4) + "\n" + page(2, "orders", 9) + "\n" + page(3, "other", 1) + "\n")
    got = ingest(spark, str(tmp_path), domain("orders"))
    ids = got.select("page", "position", F.get_json_object("item", "$.id").cast("int").alias("id"))
    assert rows(ids, "*") == [(1, 0, 5), (1, 1, 4), (2, 0, 9)]


def test_pretty_printed_file_takes_its_number_from_the_name(spark, tmp_path):
    body = json.dumps({"adjustments": [{"id": 7}]}, indent=2)
    (tmp_path / "page-00012.json").write_text(body)
    got = ingest(spark, str(tmp_path), domain("inventory_adjustments"), whole_files=True)
    assert rows(got, "page", "position", "item") == [(12, 0, json.dumps({"id": 7}, indent=2).replace("\n", "\n    "))]


def test_broken_page_is_an_error(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"orders":[{"id":1}\n')
    with pytest.raises(ERRORS):
        ingest(spark, str(tmp_path), domain("orders")).collect()


def items(spark, *docs):
    return spark.createDataFrame([(json.dumps(d),) for d in docs], "item string")


def test_raw_rows_parse_zulu_offsets_and_fractions(spark):
    got = raw_rows(
        items(spark, {"id": 9007199254740993, "updated_at": "2026-01-02T03:04:05.123+07:00"}, {"id": "2", "updated_at": "2026-01-02T00:00:00Z"}),
        "run-1",
    )
    shown = got.select("id", F.col("updated_at").cast("string").alias("t"), "source_run_id")
    assert rows(shown, "*") == [
        (2, "2026-01-02 00:00:00", "run-1"), (9007199254740993, "2026-01-01 20:04:05.123", "run-1"),
    ]


@pytest.mark.parametrize("doc", [{"updated_at": "2026-01-02T00:00:00Z"}, {"id": 1}, {"id": 1, "updated_at": "soon"}])
def test_items_without_id_or_time_are_errors(spark, doc):
    with pytest.raises(ERRORS):
        raw_rows(items(spark, doc), "run-1").collect()


def test_location_time_falls_back(spark):
    docs = [
        {"id": 1, "updated_at": "2026-01-01T00:00:00Z", "modified_on": "2026-01-09T00:00:00Z"},
        {"id": 2, "updated_at": "", "modified_on": "2026-01-02T00:00:00Z"},
        {"id": 3},
    ]
    got = location_rows(items(spark, *docs), "r", F.lit("2026-02-01").cast("timestamp"))
    assert rows(got.select("id", F.to_date("updated_at").cast("string").alias("d")), "*") == [
        (1, "2026-01-01"), (2, "2026-01-02"), (3, "2026-02-01"),
    ]


def test_snapshot_key_and_renamed_location(spark):
    got = snapshot_rows(
        items(spark, {"loc_id": 101, "variant_id": 11, "on_hand": 3}), "r", F.lit("2026-05-28"), F.lit("2026-05-28")
    )
    assert rows(got, "id", "location_id", "variant_id") == [("101:11:2026-05-28", 101, 11)]


def test_feeds(spark):
    assert domain("inventory_adjustments").envelope == "adjustments"
    assert dict(domain("orders").static_filter) == {"status": "any"}
    assert [d.name for d in DOMAINS.values() if not d.incremental] == ["locations", "inventory_locations"]


def test_holiday_seed(spark, tmp_path):
    packaged = read_holidays(spark)
    assert packaged.count() == packaged.select("date").distinct().count() > 0
    (tmp_path / "h.csv").write_text("date,holiday_name,is_public_holiday\n2026-02-17,Tết Nguyên Đán,true\n", encoding="utf-8")
    row = read_holidays(spark, str(tmp_path / "h.csv")).first()
    assert (row.date.isoformat(), row.holiday_name, row.is_public_holiday) == ("2026-02-17", "Tết Nguyên Đán", True)
    assert isinstance(at("2026-01-01"), datetime)


def test_items_keep_their_text_and_amounts_their_digits(spark, tmp_path):
    item = '{"id": 1, "a":12345678901234567.89,"b":1.10, "updated_at":"2026-01-01T00:00:00Z"}'
    (tmp_path / "1.jsonl").write_text('{"orders":[' + item + "]}\n")
    got = ingest(spark, str(tmp_path), domain("orders"))
    assert rows(got, "item") == [(item,)]
    fields = [strict("a", "a", "decimal(20,2)"), strict("b", "b", "decimal(20,2)")]
    amounts = parse(got, fields, payload="item").select(*typed(fields, "doc"))
    assert rows(amounts, "a", "b") == [(Decimal("12345678901234567.89"), Decimal("1.10"))]


def test_a_later_crawl_beats_an_earlier_one_at_equal_age(spark, tmp_path):
    for name, number, note, when in (("a", 9, "old", 1_000), ("b", 1, "new", 2_000)):
        path = tmp_path / f"{name}.jsonl"
        path.write_text(json.dumps({"page": number, "orders": [{"id": 1, "updated_at": "2026-01-01T00:00:00Z", "note": note}]}) + "\n")
        os.utime(path, (when, when))
    landed = last_arrivals(raw_rows(ingest(spark, str(tmp_path), domain("orders")), "run"))
    assert rows(landed, F.get_json_object("payload", "$.note")) == [("new",)]
