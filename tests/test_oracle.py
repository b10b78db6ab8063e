"""Every registered query against its SQL on an independent engine."""

import pytest

import __spark_entry__ as contract
from granary.plans.queries import ORACLE, QUERIES
from compare import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees(spark, con, name):
    found = differences(spark, con, name, SF)
    # a narrow filter may select nothing from the smallest tables
    assert [f for f in found if f != "no rows"] == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_comparison_notices_a_difference(spark, con, monkeypatch):
    wrong = {"remove_fields": "SELECT c_custkey, c_nationkey + 1 AS c_nationkey, c_mktsegment FROM customer"}
    monkeypatch.setattr(contract, "oracle_sql", lambda: wrong)
    assert differences(spark, con, "remove_fields", SF)
