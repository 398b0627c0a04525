from datetime import date

import pytest

from checks.queries import TASK_PARAMS
from visitlens.schemas import TASK_COLUMNS
from visitlens.sources.tasks import Task, decode_params, load_task, load_tasks

SCHEMA = ", ".join(f"{n} {t}" for n, t in TASK_COLUMNS.items())


def table(spark, params):
    return spark.createDataFrame([(i, "t", None, None, None, "x", "new", p) for i, p in params.items()], SCHEMA)


ODD = {
    10: "{}",
    11: '{"cities":[],"sex":[""],"startAge":[18],"endAge":["30"]}',
    12: '{"cities":["Rome,,Oslo,"],"categoryIds":["7,07,x,8"],"keywords":["a","ignored"]}',
    13: '{"sex":["male"],"unknown":["1"]}',
}


def test_first_element_only_and_absent_is_null(spark):
    got = {r.task_id: r for r in decode_params(table(spark, ODD)).collect()}
    assert (got[10].cities, got[10].start_age) == (None, None)
    assert (got[11].cities, got[11].sex, got[11].start_age, got[11].end_age) == (None, None, "18", "30")
    assert got[12].keywords == "a"


def test_plain_values(spark):
    tasks = {t.task_id: t for t in load_tasks(table(spark, {**ODD, **TASK_PARAMS}), [12, 1, 11, 3])}
    assert list(tasks) == [12, 1, 11, 3]
    assert tasks[1] == Task(1, date(2024, 1, 3), date(2024, 1, 25), 10, 50)
    assert tasks[12].cities == ("Rome", "Oslo")
    assert tasks[12].category_ids == (7, 8)  # '07' is another text, 'x' no id
    assert tasks[11].ages == (18, 30)
    assert tasks[3].ages is None  # one bound alone


def test_json_and_table_agree(spark):
    both = {**ODD, **TASK_PARAMS}
    for task in load_tasks(table(spark, both), list(both)):
        assert task == Task.from_json(task.task_id, both[task.task_id])


def test_missing_and_double_tasks(spark):
    df = table(spark, TASK_PARAMS)
    with pytest.raises(LookupError):
        load_task(df, 99)
    with pytest.raises(ValueError):
        load_task(df.union(df), 1)
