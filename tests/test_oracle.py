"""Every registered query against its DuckDB twin (small tables; the
driver repeats this at sf0.01, see tools/oracle_check.py)."""

import pytest

import __spark_entry__ as entry
from ledgerlens.queries import QUERIES
from tests.conftest import SF_SMALL
from tools.oracle_check import compare, duck

NAMES = list(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    result = compare(spark, con, name, SF_SMALL)
    assert result[1] == "OK", result


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "flag_degradation" in df.columns
