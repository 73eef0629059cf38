"""Every registered query against its DuckDB oracle on the smallest test data."""

import os

import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck

SF_DIR = os.environ.get("SPARKMART_ORACLE_SF", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


NAMES = sorted(n for n in entry.queries() if n.startswith("q_"))


def test_every_query_has_an_oracle():
    assert set(NAMES) == {n for n in entry.oracle_sql() if n.startswith("q_")}
    assert len(NAMES) >= 32


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, n, _, _, detail = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF_DIR)
    assert ok, detail
    assert n > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["year", "month", "month_name"]
    assert df.count() > 0
