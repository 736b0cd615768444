"""Driver contract: entry smoke, registry/oracle keys, and every key vs DuckDB."""

import pytest

import __spark_entry__ as E
import duck_oracle
from cardlake.plans.catalog import REGISTRY
from tests.conftest import SMOKE
from tools.oracle_check import compare, duck


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_settlement" in df.columns


def test_every_query_has_an_oracle():
    assert set(REGISTRY) == set(duck_oracle.queries())
    assert set(REGISTRY) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE)


@pytest.mark.parametrize("key", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SMOKE)
    res = con.execute(E.oracle_sql()[key])
    ok, msg = compare([tuple(r) for r in df.collect()], df.columns,
                      res.fetchall(), [d[0] for d in res.description])
    assert ok, msg
