"""Driver contract: entry() runs, every query equals its DuckDB oracle on the test tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import compare, duck

SMALL = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["pk", "username", "full_name"]
    assert df.count() >= 0


OWN = {n: f for n, f in queries().items() if n.startswith("q")}  # the llm subpackage tests its own


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(oracle_sql()) <= set(queries())


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, OWN[name], oracle_sql()[name], SMALL, con)
    assert res["match"] is True, res
