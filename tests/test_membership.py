"""The filter of session ids at the scan: nothing lost, few others passed, few actions shuffled."""

import re

import pytest
from pyspark.sql import functions as F

from checks.queries import task_plan
from tests.rows import action, actions, executed, values
from visitlens.operators import membership
from visitlens.operators.details import actions_of
from visitlens.operators.membership import blocks_for, chosen_actions, filter_of, fits, may_be_in

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(conf):
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        conf(key, "-1")


def test_blocks():
    assert [blocks_for(n) for n in (0, 1, 42, 43, 1000)] == [1, 1, 1, 2, 32]
    assert fits(40_000_000) and not fits(60_000_000)


@pytest.mark.parametrize("n", [0, 1, 100, 20_000])
def test_no_id_lost_and_few_others_pass(spark, n):
    ids = spark.range(n).select(F.concat(F.lit("s"), "id").alias("session_id"))
    rows = spark.range(100_000).select(F.concat(F.lit("s"), "id").alias("session_id"), "id")
    passed = may_be_in(rows, filter_of(ids, n), n)
    assert passed.where(F.col("id") < n).count() == n
    assert passed.count() - n < 0.02 * (100_000 - n)


def test_more_ids_than_announced_are_all_found(spark):
    ids = spark.range(5000).select(F.col("id").cast("string").alias("session_id"))
    assert may_be_in(ids, filter_of(ids, 10), 10).count() == 5000


def test_null_and_repeated_ids_and_empty_tables(spark):
    rows = actions(spark, [action("a"), action("a"), action("b"), action(None), action("")])
    chosen = spark.createDataFrame([("a",), ("a",), (None,), ("",)], "session_id string")
    assert [v[0] for v in values(chosen_actions(rows, chosen, 4), "session_id")] == ["", "a", "a"]
    assert chosen_actions(rows, chosen.limit(0), 0).count() == 0
    assert chosen_actions(rows.limit(0), chosen, 4).count() == 0


def test_without_a_filter_the_result_is_the_same(spark, monkeypatch):
    plan = task_plan(spark, SF, 2)
    expected = values(actions_of(plan.actions, plan.sessions))
    assert values(chosen_actions(plan.actions, plan.sessions, 10_000)) == expected
    monkeypatch.setattr(membership, "MOST_BLOCKS", 0)
    assert values(chosen_actions(plan.actions, plan.sessions, 10_000)) == expected


def test_few_actions_of_other_sessions_are_shuffled(spark, no_broadcast, tmp_path):
    plan = task_plan(spark, SF, 2)
    plan.actions.write.parquet(f"{tmp_path}/actions")
    plan.sessions.write.parquet(f"{tmp_path}/sessions")
    rows, sessions = spark.read.parquet(f"{tmp_path}/actions"), spark.read.parquet(f"{tmp_path}/sessions")
    n = sessions.count()
    result = chosen_actions(rows, sessions, n)
    text = executed(result)
    # The broadcast semi join is below the shuffle of the actions.
    actions_side = text[text.index("LeftSemi"):]
    assert actions_side.index("Exchange hashpartitioning(session_id") < actions_side.index("BroadcastHashJoin")
    assert not re.search(r"Python|BroadcastNestedLoopJoin|Cartesian", text)
    wanted, sent = result.count(), may_be_in(rows, filter_of(sessions, n), n).count()
    others = rows.count() - wanted
    assert wanted <= sent <= wanted + 0.02 * others and wanted < 0.5 * rows.count()
