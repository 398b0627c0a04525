"""The whole job on derived tables: one task, many tasks, reruns, kept results in a shared folder."""

import os

import pytest
from pyspark.sql import functions as F

from checks.queries import SAMPLE_TOTAL, TASK_PARAMS, TASKS, many_plan, task_plan
from tests.rows import values
from visitlens import schemas
from visitlens.__main__ import main
from visitlens.plans import job
from visitlens.plans.keep import Kept
from visitlens.plans.single import TaskPlan
from visitlens.sources.derived import derived_actions, derived_users
from visitlens.sources.tables import read_actions
from visitlens.sources.tasks import Task

SF = "/root/testdata/sf0.001"
TABLES = {
    job.STAT: schemas.STAT_COLUMNS,
    job.SAMPLE: schemas.SAMPLE_COLUMNS,
    job.TOP_CATEGORY: schemas.TOP_CATEGORY_COLUMNS,
    job.TOP_SESSION: schemas.TOP_SESSION_COLUMNS,
    job.DETAIL: schemas.DETAIL_COLUMNS + schemas.DETAIL_TAGS,
}


@pytest.fixture(scope="module")
def stored_world(spark, tmp_path_factory):
    """The derived tables as files a job would read: dates and times as text, split by date."""
    root = tmp_path_factory.mktemp("world")
    actions = derived_actions(spark, SF).withColumns({
        "action_time": F.date_format("action_time", "yyyy-MM-dd H:mm:ss"),
        "date": F.col("date").cast("string"),
    })
    actions.write.partitionBy("date").parquet(f"{root}/actions")
    derived_users(spark, SF).write.parquet(f"{root}/users")
    spark.createDataFrame(
        [(i, "t", None, None, None, "session", "new", p) for i, p in TASK_PARAMS.items()],
        ", ".join(f"{n} {t}" for n, t in schemas.TASK_COLUMNS.items()),
    ).write.parquet(f"{root}/tasks")
    return str(root)


def run(spark, world, out, tasks, folder=None):
    actions = read_actions(spark, f"{world}/actions", "parquet")
    job.run_tasks(spark, actions, spark.read.parquet(f"{world}/users"), tasks, out, SAMPLE_TOTAL, work_folder=folder)


def contents(spark, out, task_id):
    got = {}
    for name, columns in TABLES.items():
        df = spark.read.parquet(f"{out}/{name}").where(F.col("task_id") == task_id)
        got[name] = values(df, *columns)
    return got


@pytest.fixture(scope="module")
def single(spark, stored_world, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("single"))
    for task in TASKS.values():
        run(spark, stored_world, out, [task])
    return out


def test_job_writes_what_the_plan_says(spark, single):
    plan = task_plan(spark, SF)
    got = contents(spark, single, 1)
    assert got[job.STAT] == values(plan.stat(), *schemas.STAT_COLUMNS)
    assert got[job.SAMPLE] == values(plan.sample(), *schemas.SAMPLE_COLUMNS)
    assert got[job.TOP_CATEGORY] == values(plan.top_category(), *schemas.TOP_CATEGORY_COLUMNS)
    assert got[job.TOP_SESSION] == values(plan.top_session(), *schemas.TOP_SESSION_COLUMNS)
    n = len(schemas.DETAIL_COLUMNS)
    sample = [r[:n] for r in got[job.DETAIL] if r[n] == "sample"]
    top = [r[:n] + (r[n + 1],) for r in got[job.DETAIL] if r[n] == "top10"]
    assert sorted(sample, key=repr) == values(plan.sample_detail(), *schemas.DETAIL_COLUMNS)
    assert sorted(top, key=repr) == values(plan.top_session_detail(), *schemas.DETAIL_COLUMNS, "category_id")
    assert len(got[job.SAMPLE]) == 189  # all sessions of the fixture


def test_many_tasks_equal_each_alone_and_rerun_changes_nothing(spark, stored_world, single, tmp_path):
    out = str(tmp_path)
    for _ in range(2):
        run(spark, stored_world, out, list(TASKS.values()))
        for task_id in TASKS:
            assert contents(spark, out, task_id) == contents(spark, single, task_id)


def test_many_details_equal_single(spark):
    many = many_plan(spark, SF)
    one = TaskPlan(derived_actions(spark, SF), derived_users(spark, SF), many.tasks[2], total=many.total)
    for method in ("sample_detail", "top_session_detail"):
        got = getattr(many, method)().where("task_id = 3")
        assert values(got, *sorted(got.columns)) == values(getattr(one, method)(), *sorted(got.columns))


def test_result_rows_have_the_database_columns(spark, single):
    for name, columns in job.RESULTS.items():
        rows = job.result_rows(spark, single, name, [1, 3])
        assert rows.columns == columns
        assert {r.task_id for r in rows.select("task_id").distinct().collect()} == {1, 3}


def test_export_appends_each_table(spark, single, monkeypatch):
    seen = {}
    monkeypatch.setattr(job, "write_jdbc", lambda df, url, table, **more: seen.update({table: (df.columns, url, more)}))
    job.export_tables(spark, single, [1], "jdbc:x:y", user="me")
    assert seen == {name: (columns, "jdbc:x:y", {"user": "me"}) for name, columns in job.RESULTS.items()}


def test_shared_folder(spark, stored_world, single, tmp_path):
    folder = str(tmp_path / "shared")
    os.makedirs(folder)
    out = str(tmp_path / "out")
    run(spark, stored_world, out, [TASKS[1]], folder)
    assert contents(spark, out, 1) == contents(spark, single, 1)
    assert os.listdir(folder) == []  # the job's working tables are gone


def test_kept_result_is_read_from_the_folder(spark, tmp_path):
    with Kept(spark, str(tmp_path)) as kept:
        df = kept.keep(spark.range(5).withColumn("x", F.lit("y")), "r")
        assert df.columns == ["id", "x"] and df.count() == 5
        assert "parquet" in df._jdf.queryExecution().executedPlan().toString().lower()
    with Kept(spark) as kept:
        assert kept.keep(spark.range(5), "r").count() == 5


def test_command_line(spark, stored_world, single, tmp_path, monkeypatch):
    out = str(tmp_path)
    main(["--task", "1", "3", "--out", out, "--format", "parquet", "--total", str(SAMPLE_TOTAL),
          "--actions", f"{stored_world}/actions", "--users", f"{stored_world}/users", "--tasks", f"{stored_world}/tasks"])
    for task_id in (1, 3):
        assert contents(spark, out, task_id) == contents(spark, single, task_id)


def test_empty_range_and_missing_dates(spark, stored_world, tmp_path):
    from datetime import date

    nothing = Task(8, start_date=date(2030, 1, 1), end_date=date(2030, 1, 2))
    everything = Task(9)
    for tasks, out in (([nothing], "a"), ([nothing, everything], "b")):
        run(spark, stored_world, str(tmp_path / out), tasks)
        got = contents(spark, str(tmp_path / out), 8)
        assert got[job.STAT][0][:2] == (8, 0) and set(got[job.STAT][0][2:]) == {None}
        assert all(not rows for name, rows in got.items() if name != job.STAT)
    run(spark, stored_world, str(tmp_path / "c"), [everything])
    assert contents(spark, str(tmp_path / "b"), 9) == contents(spark, str(tmp_path / "c"), 9)
