"""Every registered question equals its independent SQL."""

import pytest
from compare import duck, oracle_rows, spark_rows
from explain import SMALL, plan

import __spark_entry__ as contract
from tallyhouse.plans.registry import QUERIES

ORACLE = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_question_has_an_oracle():
    assert set(QUERIES) <= set(ORACLE) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_question(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    names, got = spark_rows(df)
    expected_names, expected = oracle_rows(con, ORACLE[name])
    assert names == expected_names
    assert got == expected
    assert expected
    # No join without keys, no Python in the plan.
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert word not in plan(df)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["day", "channel", "revenue"] and df.count() > 0
