"""Every query with a SQL counterpart against DuckDB on the same Parquet files."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from tests.compare import differences

SQL = entry_points.oracle_sql()
# needs all three models trained at full settings; covered by tests/check_all.py
SLOW = {"prediction_lineage"}


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(set(SQL) - SLOW))
def test_equals_sql(spark, sf_dir, con, name):
    assert differences(entry_points.queries()[name](spark, sf_dir), con, SQL[name]) == []


def test_entry(spark):
    rows = {r["label"]: r["count"] for r in entry_points.entry(spark).collect()}
    assert rows == {
        "WEB_ATTACK": 2233,
        "HEARTBLEED": 784,
        "BENIGN": 739,
        "DOS_HULK": 719,
        "PORT_SCAN": 702,
        None: 31,
    }
