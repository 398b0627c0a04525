"""What the plans must and must not contain."""

import re

import pytest

from checks.queries import QUERIES, task_plan
from tests.rows import executed, planned

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def no_broadcast(spark):
    """As with large tables: no side is small enough to broadcast by itself."""
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_no_cross_joins(spark, no_broadcast, name):
    plan = planned(QUERIES[name](spark, SF))
    assert not re.search(r"Python|ArrowEval|BatchEval|CartesianProduct|BroadcastNestedLoopJoin", plan)


def test_scans_read_only_needed_columns(spark, no_broadcast):
    plan = planned(QUERIES["session_aggr_stat"](spark, SF))
    schemas = set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan))
    assert "struct<ts:timestamp_ntz,user_id:bigint>" in schemas
    assert not any("props" in s or "value" in s for s in schemas)


def test_top_sessions_are_limited_before_the_shuffle(spark, no_broadcast):
    plan = executed(QUERIES["top10_session"](spark, SF))
    partial = plan.index("Partial")
    assert "WindowGroupLimit" in plan and "Exchange hashpartitioning(category_id" in plan[: partial]


def test_sample_shuffles_only_rows_above_the_mark(spark, no_broadcast):
    plan = executed(task_plan(spark, SF).sampled())
    lines = plan.splitlines()
    window = next(i for i, line in enumerate(lines) if "row_number()" in line)
    below = "\n".join(lines[window: window + 12])
    assert "BroadcastHashJoin" in below and "last_band" in below
    assert "ReusedExchange" in plan


def test_details_do_not_shuffle_actions(spark, no_broadcast):
    plan = task_plan(spark, SF)
    text = planned(plan.details(plan.sampled().selectExpr("*", "'sample' as origin"), ["origin"]))
    top = [line for line in text.splitlines() if "Join" in line or "Exchange" in line]
    assert "BroadcastHashJoin" in top[0]
