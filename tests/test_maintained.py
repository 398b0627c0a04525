"""Stored session days after late, rewritten and deleted days equal a full run, and only changed days are read again."""

import shutil
from datetime import date

import pytest
from pyspark.sql import functions as F

from checks.queries import SAMPLE_TOTAL, TASKS
from tests.rows import action, executed, planned, stored, values
from visitlens.operators.categories import session_categories
from visitlens.plans import maintained
from visitlens.plans.maintained import MaintainedPlan, SessionDays
from visitlens.plans.single import TaskPlan
from visitlens.sources.derived import derived_actions, derived_users
from visitlens.sources.tables import as_actions
from visitlens.sources.tasks import Task

SF = "/root/testdata/sf0.001"


def write(df, path, mode="append"):
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)


def same(spark, store, path, users, task):
    """All results from the store are those of the actions."""
    actions = as_actions(spark.read.parquet(path))
    full, kept = TaskPlan(actions, users, task, SAMPLE_TOTAL), MaintainedPlan(store, actions, users, task, SAMPLE_TOTAL)
    columns = ["session_id", "user_id", "start_time", "step_length", "visit_length"]
    assert values(kept.sessions, *columns) == values(full.sessions, *columns)
    for result in ("stat", "sample", "top_category", "top_session"):
        assert values(getattr(kept, result)()) == values(getattr(full, result)()), result


def test_late_rewritten_deleted_and_new_days(spark, tmp_path):
    path, store = f"{tmp_path}/actions", SessionDays(spark, f"{tmp_path}/store")
    stream, users = derived_actions(spark, SF).where("date is not null"), derived_users(spark, SF)
    part = F.pmod(F.xxhash64("session_id"), F.lit(3))
    write(stream.where((F.col("date") < "2024-01-20") & (part != 0)).coalesce(1), path)
    first = store.refresh(spark.read.parquet(path))
    assert len(first) == 19 and store.refresh(spark.read.parquet(path)) == []
    same(spark, store, path, users, TASKS[1])

    write(stream.where((F.col("date") == "2024-01-08") & (part == 0)).coalesce(1), path)
    write(stream.where(F.col("date") == "2024-01-22").coalesce(1), path)
    write(stream.where((F.col("date") == "2024-01-10") & (part == 1)).coalesce(1), path, "overwrite")
    shutil.rmtree(f"{path}/date=2024-01-12")
    changed = store.refresh(spark.read.parquet(path))
    assert changed == [date(2024, 1, 8), date(2024, 1, 10), date(2024, 1, 22)]
    assert store.table("days").where("date = '2024-01-12'").count() == 0
    same(spark, store, path, users, TASKS[4])

    before = values(store.table("days"))
    assert store.expire(keep=1) == [] and values(store.table("days")) == before


def test_one_day_at_a_time_equals_all_at_once(spark, tmp_path):
    rows = [action("s", f"2024-01-0{d} 10:00:0{i}", user=9 - d, keyword="tea" if i else None, click=d % 2, order="1,x,1", pay="2")
            for d in (1, 2, 3) for i in range(d)]
    path = f"{tmp_path}/actions"
    store, whole = SessionDays(spark, f"{tmp_path}/a"), SessionDays(spark, f"{tmp_path}/b")
    for day in ("2024-01-02", "2024-01-03", "2024-01-01"):
        stored(spark, [row for row in rows if row[0] == day]).write.mode("append").parquet(path)
        assert [d.isoformat() for d in store.refresh(spark.read.parquet(path))] == [day]
    assert len(whole.refresh(spark.read.parquet(path))) == 3
    for name in maintained.TABLES:
        assert values(store.table(name)) == values(whole.table(name))
    task = Task.from_json(1, '{"startDate":["2024-01-02"],"endDate":["2024-01-03"]}')
    session = store.sessions(task).collect()
    assert [(r["user_id"], r["step_length"], r["n_days"], r["visit_length"]) for r in session] == [(6, 5, 2, 86402)]
    assert values(store.session_categories(task)) == values(
        session_categories(as_actions(spark.read.parquet(path)).where("date > '2024-01-01'")), "session_id", "category_id", "click_count", "order_count", "pay_count")


def test_null_ids_dates_and_empty_tables(spark, tmp_path):
    rows = [action(None, click=3, keyword="tea"), action(None, keyword=""), action("a", time="never"), action("b", date="no day")]
    path, store = f"{tmp_path}/actions", SessionDays(spark, f"{tmp_path}/store")
    stored(spark, rows).write.parquet(path)
    assert store.refresh(spark.read.parquet(path)) == [date(2024, 1, 1)]
    task = Task.from_json(1, '{"keywords":["tea"]}')
    got = {r["session_id"]: r for r in store.sessions(task).collect()}
    assert set(got) == {None, "a"} and got[None]["keyword_hit"] and not got["a"]["keyword_hit"]
    assert (got[None]["step_length"], got["a"]["step_length"], got["a"]["start_time"]) == (2, 1, None)

    stored(spark, []).write.parquet(f"{tmp_path}/empty")
    assert store.refresh(spark.read.parquet(f"{tmp_path}/empty")) == []
    assert store.sessions(task).count() == 0 and store.list_rows(task).count() == 0
    assert SessionDays(spark, f"{tmp_path}/none").session_categories(task).count() == 0


def test_a_failed_refresh_changes_nothing(spark, tmp_path, monkeypatch):
    path, store = f"{tmp_path}/actions", SessionDays(spark, f"{tmp_path}/store")
    stored(spark, [action("a", click=1)]).write.parquet(path)
    store.refresh(spark.read.parquet(path))
    before = {name: values(store.table(name)) for name in maintained.TABLES}
    stored(spark, [action("b", click=1), action("b", "2024-01-02 10:00:00")]).write.mode("append").parquet(path)

    def broken(*_):
        raise OSError("the cluster went away")

    with monkeypatch.context() as patch, pytest.raises(OSError):
        patch.setattr(maintained.Manifests, "publish", broken)
        store.refresh(spark.read.parquet(path))
    assert {name: values(store.table(name)) for name in maintained.TABLES} == before
    assert store.refresh(spark.read.parquet(path)) == [date(2024, 1, 1), date(2024, 1, 2)]
    assert values(store.table("days"), "session_id") == [("a",), ("b",), ("b",)]


def test_only_the_days_asked_for_are_read(spark, tmp_path):
    path, store = f"{tmp_path}/actions", SessionDays(spark, f"{tmp_path}/store")
    write(stored(spark, [action("a", f"2024-01-0{d} 10:00:00") for d in (1, 2, 3)]).coalesce(1), path)
    store.refresh(spark.read.parquet(path))
    days = store.table("days", date(2024, 1, 2), date(2024, 1, 2))
    assert days.inputFiles() and "PartitionFilters: [" in planned(days) and days.count() == 1
    # Fingerprints of a table partitioned by date read no column.
    assert "ReadSchema: struct<>" in executed(maintained.fingerprints(spark.read.parquet(path)))
