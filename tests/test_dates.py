"""One task alone and the same task among others give the same tables."""

from datetime import date

import pytest

from tests.rows import action, stored, users, values
from visitlens.plans.many import ManyTasksPlan
from visitlens.plans.single import TaskPlan
from visitlens.sources.tables import as_actions
from visitlens.sources.tasks import Task, load_tasks

ROWS = [
    action("a", "2024-01-01 10:00:00", 1, keyword="tea", click=-1), action("a", "2024-01-02 10:00:00", 2, click=7, order="7,3"),
    action("b", "2024-01-12 09:00:00", 2, keyword="hotpot", pay="1"), action("c", "2024-01-03 08:00:00", 3, click=5),
    action(None, "2024-01-02 11:00:00", 1, keyword="tea"), action("e", "2024-01-02 12:00:00", 99),
]
UNDATED = [action("d", "2024-01-02 10:00:00", 1, date="bad"), action("d", "2024-01-02 10:00:00", 1, date="2024-01-1x"),
           action("b", "2024-01-12 09:30:00", 2, date="2024-1-12")]
PEOPLE = [(1, 20, "p", "x", "male"), (2, 40, "q", "y", "female"), (3, 30, "p", "y", "male")]
TASKS = [
    Task(1), Task(2, date(2024, 1, 2), None), Task(3, None, date(2024, 1, 2)), Task(4, date(2024, 1, 2), date(2024, 1, 12)),
    Task(5, start_age=18, end_age=25), Task(6, sex="female"), Task(7, keywords=("tea", "hotpot")), Task(8, category_ids=(-1, 5)),
    Task(9, keywords=()), Task(10, cities=("y",), professionals=("p",)), Task(11, date(2024, 1, 5), date(2024, 1, 1)),
    Task(12, category_ids=tuple(range(100))),
]


@pytest.mark.parametrize("kind", ["text", "day"])
def test_many_equal_each_alone(spark, kind):
    rows = stored(spark, [*ROWS, *UNDATED])
    null_date = rows.limit(2).selectExpr("cast(null as string) as date", *rows.columns[1:])
    rows = rows.unionByName(null_date)
    if kind == "day":
        rows = rows.selectExpr("try_cast(date as date) as date", *rows.columns[1:]).where("date is null or day(date) < 12 or session_id <> 'b'")
    actions, people = as_actions(rows), users(spark, PEOPLE)
    many = ManyTasksPlan(spark, actions, people, TASKS, total=20)
    stat, sample, top = many.stat().collect(), many.sample().collect(), many.top_category().collect()
    for task in TASKS:
        alone = TaskPlan(actions, people, task, total=20)
        expected = values(alone.stat())
        assert [tuple(r) for r in stat if r["task_id"] == task.task_id] == (expected or [(task.task_id, 0, *[None] * (len(stat[0]) - 2))])
        assert sorted((tuple(r) for r in sample if r["task_id"] == task.task_id), key=repr) == values(alone.sample())
        assert sorted((tuple(r) for r in top if r["task_id"] == task.task_id), key=repr) == values(alone.top_category())


def test_nothing_is_shuffled_after_sessions_are_copied_to_tasks(spark, conf):
    """Only (task, session) pairs that passed leave the stage that makes them."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = ManyTasksPlan(spark, as_actions(stored(spark, ROWS)), users(spark, PEOPLE), [t for t in TASKS if t.start_date and t.end_date])
    lines = plan.sessions._jdf.queryExecution().executedPlan().toString().splitlines()
    copied = next(i for i, line in enumerate(lines) if "Generate explode(numbers" in line)
    assert not any("Exchange" in line and "Broadcast" not in line for line in lines[:copied])
    below = "\n".join(lines[copied:])
    assert "hashpartitioning(task_id" not in below and "hashpartitioning(session_id" in below
    assert "SortAggregate" not in below
    pairs = plan.per_session._jdf.queryExecution().executedPlan().toString()
    assert "explode(sequence" not in pairs and "hashpartitioning(date" not in pairs


def test_a_bad_task_is_noted_and_the_others_run(spark):
    from tests.test_tasks import SCHEMA

    rows = [(1, '{"sex":["male"]}'), (2, '{"startDate":["2024-1-3"]}'), (3, '{"categoryIds":["-1,07,99999999999999999999"]}')]
    table = spark.createDataFrame([(i, "t", None, None, None, "x", "new", p) for i, p in rows], SCHEMA)
    bad = {}
    tasks = load_tasks(table, [1, 2, 3], bad)
    assert [t.task_id for t in tasks] == [1, 3] and list(bad) == [2]
    assert tasks[1].category_ids == (-1,)
    with pytest.raises(ValueError):
        load_tasks(table, [1, 2, 3])
