"""Driver contract and the DuckDB oracle gate (sf0.01)."""

import pytest

import __spark_entry__ as E
from recordlink.plans.queries import QUERIES
from tests.conftest import SF_ORACLE
from tests.oracle_check import compare

ORACLE = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["taxpayer_id", "has_registry_data", "has_account_data"]


def test_contract_keys():
    assert set(E.oracle_sql()) <= set(E.queries()) and set(QUERIES) <= set(E.queries())
    assert set(QUERIES) == set(ORACLE)      # every query is compared by value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    r = compare(spark, SF_ORACLE, name, QUERIES[name], ORACLE.get(name), duck)
    assert r["status"] in ("match", "rows-only"), r
    assert r["spark_rows"] > 0
