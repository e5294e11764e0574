"""Every registered query against its SQL, on the smallest test tables."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql
from linetally.workload.queries import QUERIES
from tools.compare import compare

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, con, name):
    ok, note = compare(spark, con, name, SF)
    assert ok, note


def test_entry(spark):
    assert entry(spark).count() > 0
