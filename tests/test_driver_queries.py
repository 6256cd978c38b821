"""Every driver query against its DuckDB oracle on the smallest generated scale,
plus the contract of ``__spark_entry__``."""

import pytest
from oracle import compare, duck

import __spark_entry__ as E
from casebook.plans.catalogue import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
NAMES = sorted(ORACLE)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["customer_id", "total_amount"]
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    r = compare(spark, con, E.queries()[name], E.oracle_sql()[name], SF)
    assert r["names_match"], r
    assert r["values_match"], r
    assert r["types_match"], (r["spark_types"], r["oracle_types"])
