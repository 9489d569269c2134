"""Every registered query against its DuckDB oracle (sf0.001 by default;
set TRIPKIT_ORACLE_SF to another folder to widen)."""

import os

import pytest

import __spark_entry__ as E
from oracle_check import compare, duck

SF = os.environ.get("TRIPKIT_ORACLE_SF", "/root/testdata/sf0.001")
QUERIES = E.queries()
SQLS = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def training_data(name):
    """Whether a query is of the training-data subpackage, whose operators are not all expressible in SQL."""
    return name == "pipeline" or name.startswith("op") and name[2].isdigit()


def test_every_query_has_oracle():
    assert {n for n in QUERIES if not training_data(n)} <= set(SQLS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(SQLS)))
def test_query_matches_oracle(spark, con, name):
    ok, n, _, detail = compare(spark, con, name, QUERIES[name], SQLS[name], SF)
    assert ok, detail


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "total_trips" in df.columns
