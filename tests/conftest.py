from __future__ import annotations

import sys
from datetime import UTC, datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tradeloom.session import local_session  # noqa: E402

RAW = "id bigint, payload string, updated_at timestamp, ingested_at timestamp, source_run_id string"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "4")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=UTC)


def raw_table(spark, *docs: str, first_id: int = 1):
    rows = [(first_id + i, d, at("2026-01-01"), at("2026-01-01"), "run") for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, RAW)


def rows(df, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
