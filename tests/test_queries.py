"""Every registered query against its SQL, and the driver contract."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry_module  # noqa: E402
from check import compare, oracle_connection  # noqa: E402
from tradeloom.catalog import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the benchmark tables")


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF)


def test_contract():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, oracle, name):
    ok, note = compare(spark, oracle, SF, name)
    assert ok, note
