"""Driver tier: every registered query against its DuckDB oracle (sf0.001)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import digest, duck  # noqa: E402
from lakebars.plans import oracle, registry  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = sorted(E.oracle_sql())


def test_every_query_has_an_oracle():
    assert set(oracle.oracle_sql()) == set(registry.queries())
    assert set(NAMES) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    hs, _ = digest(df.columns, [tuple(r) for r in df.collect()])
    hd, _ = digest(rel.columns, rel.fetchall())
    assert hs == hd


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[0] == "ticker" and df.count() >= 0
