"""Every registered query against its SQL in DuckDB."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from check_oracles import compare, open_tables
from tradegrain.workload.oracles import ORACLES
from tradegrain.workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    if not Path(FOLDER).is_dir():
        pytest.skip("no test tables")
    return open_tables(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, tables, name):
    assert compare(spark, tables, FOLDER, name) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["Segment", "revenue", "profit", "margin_pct", "orders"]
