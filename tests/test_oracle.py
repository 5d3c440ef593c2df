"""Every registered driver query against its DuckDB oracle at sf0.01 (the
driver's correctness gate, run locally)."""

import os

import pytest

from tests.conftest import ROOT  # noqa: F401  (puts the repo on sys.path)

import __spark_entry__ as E  # noqa: E402
from marketlake.plans import catalog  # noqa: E402
from tools.oracle_check import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data missing")

QUERIES, ORACLE = catalog.QUERIES, catalog.ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF, name, QUERIES[name], ORACLE.get(name), con)
    assert r["status"] == "ok", r


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


def test_entry_registers_them():
    assert set(QUERIES) <= set(E.queries()) and ORACLE.items() <= E.oracle_sql().items()


def test_entry_runs(spark):
    df = E.entry(spark)
    out = df.collect()
    assert df.columns == ["ticker", "total_volume"]
    assert 0 < len(out) <= 10
