"""Every registered query against its SQL, on the smallest tables."""

import os

import compare
import pytest

import __spark_entry__ as entry
from bikeflow.plans import catalog, oracle

SF = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(oracle.SQL)
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    table = catalog.QUERIES[name](spark, SF).toArrow()
    assert table.num_rows > 0
    assert compare.compare(table, duck.sql(oracle.SQL[name]).to_arrow_table()) is None


def test_entry(spark):
    frame = entry.entry(spark)
    assert "pickup_station_name" in frame.columns and not frame.isEmpty()
