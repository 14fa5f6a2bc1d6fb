"""Every named query against its SQL, and the shape of its plan."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from talkmart.plans.queries import QUERIES, SQL
from tests.compare import connect, mismatch
from tests.conftest import plan_of

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# Queries that have no rows on the smallest tables, on either side.
EMPTY: set[str] = set()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    problem = mismatch(QUERIES[name](spark, FOLDER), duck, SQL[name])
    assert problem == ("both sides are empty" if name in EMPTY else None), problem


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # Only reports and samples with a proven bound may end in one partition.
    if "SinglePartition" in plan:
        assert name in {"constraint_report", "constraint_report_keys", "stride_shards"}


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_windows_reach_the_scan(spark):
    for name, column in (("day_window_kst", "ts"), ("backfill_days", "ts"), ("month_window", "o_orderdate")):
        plan = plan_of(QUERIES[name](spark, FOLDER))
        assert f"GreaterThanOrEqual({column}," in plan and f"LessThan({column}," in plan, plan


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["doc_id", "pos", "sentence"] and df.count() > 0
