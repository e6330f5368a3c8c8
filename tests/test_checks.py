"""Every check query against its DuckDB statement on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import compare, duck

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_matches_sql(spark, con, name):
    df = queries()[name](spark, SF_DIR)
    assert compare(df, con, oracle_sql()[name]) == ""


def test_entry(spark):
    assert entry(spark).count() > 0
