"""Every registered query against its DuckDB oracle on sf0.001 (the driver
runs the same comparison at sf0.01)."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "scripts"))

from check_oracle import compare, duck  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402

from standlens.plans.registry import queries as registry  # noqa: E402

SF = "/root/testdata/sf0.001"
# the reference's operators; the optional training-data queries have tests of their own
QS = {name: run for name, run in queries().items() if name in registry()}
SQL = {name: sql for name, sql in oracle_sql().items() if name in registry()}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QS) == set(SQL)


@pytest.mark.parametrize("name", sorted(QS))
def test_query_matches_oracle(spark, con, name):
    ok, n, _, msg = compare(spark, con, name, QS[name], SQL[name], SF)
    assert ok, msg


def test_entry(spark):
    df = entry(spark)
    assert df.count() >= 0 and "project_cover_class" in df.columns
