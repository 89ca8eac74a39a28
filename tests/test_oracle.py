"""Every registered query against its DuckDB oracle SQL at sf0.001
(the driver runs the same check at sf0.01)."""

import pytest

import __spark_entry__ as E
from snapledger.plans.oracle import ORACLE
from snapledger.plans.queries import QUERIES
from conftest import SF001
from oracle_harness import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_oracle_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, E.queries()[name], ORACLE[name], SF001, con)
    assert res["match"], res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema.fields] == ["snapshot_date", "release_date", "subsidiary", "gmv_value",
                                                  "transaction_count", "is_current_snapshot", "transaction_date"]
