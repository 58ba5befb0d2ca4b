"""Every registered query against its check SQL."""

import os

import pytest

import __spark_entry__ as contract
from compare import connect, differences
from tierstone.workload.oracles import ORACLES
from tierstone.workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_check_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert differences(contract.queries()[name](spark, SF_DIR), con, contract.oracle_sql()[name]) == []


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def nodes(plan):
    yield plan
    for i in range(plan.children().size()):
        yield from nodes(plan.children().apply(i))


@pytest.mark.parametrize("name", ["tip_tiers_documents", "silver_tip_features", "tips_monthly", "silver_review_features"])
def test_no_join_carries_a_text(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan()
    joins = [n for n in nodes(plan) if n.nodeName() in ("Join", "Window", "Aggregate")]
    assert joins
    for n in joins:
        assert "text" not in [n.output().apply(i).name() for i in range(n.output().size())]


def test_hot_key_join_scans_lineitem_twice(spark):
    plan = QUERIES["pit_join_hot_keys_split"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_orderkey") > 0 and plan.count("Relation [l_orderkey") == 1  # the keys were counted in a job before
