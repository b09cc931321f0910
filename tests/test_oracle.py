"""Every example query against its SQL on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry
from tests.oracle_check import compare, connect
from zonecast.plans.catalog import QUERIES
from zonecast.plans.oracle import ORACLE

queries, oracle_sql = QUERIES.copy, ORACLE.copy

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")

# Queries whose result SQL cannot state; they are checked elsewhere in these tests.
NO_SQL = {
    "ks_exact", "rate_limit_replay", "gbt_eval", "compare_objectives", "feature_importance", "stream_admission",
}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def no_cross_join(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_every_query_has_sql_or_a_reason():
    assert set(queries()) - set(oracle_sql()) == NO_SQL
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, con, name):
    df = queries()[name](spark, SF)
    no_cross_join(df)
    problem = compare(df, con, oracle_sql()[name])
    assert problem is None, problem


@pytest.mark.parametrize("name", sorted(NO_SQL))
def test_other_queries_return_rows(spark, name):
    df = queries()[name](spark, SF)
    no_cross_join(df)
    assert len(df.columns) == len(set(df.columns)) and df.count() > 0


def test_streamed_and_replayed_admission_agree(spark):
    a, b = (queries()[n](spark, SF).select("request_id", "client", "admitted") for n in ("rate_limit_replay", "stream_admission"))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_entry(spark):
    assert entry(spark).count() > 0
