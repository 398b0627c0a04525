"""Runs whose tables are switched together: failures after each table, reruns, runs side by side."""

import pytest
from pyspark.sql import functions as F

from checks.queries import SAMPLE_TOTAL, TASKS
from tests.rows import values
from visitlens.plans import job
from visitlens.sinks.published import Manifests
from visitlens.sources.derived import derived_actions, derived_users

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("world")
    derived_actions(spark, SF).write.parquet(f"{root}/a")
    derived_users(spark, SF).write.parquet(f"{root}/u")
    return spark.read.parquet(f"{root}/a"), spark.read.parquet(f"{root}/u")


def published(spark, out):
    tables = {name: job.published_rows(spark, out, name) for name in job.RESULTS}
    return {name: None if df is None else values(df) for name, df in tables.items()}


def test_a_failed_run_changes_nothing_and_a_rerun_switches_all(spark, world, tmp_path, monkeypatch):
    out, task = str(tmp_path), TASKS[1]
    assert set(published(spark, out).values()) == {None}
    job.publish_tasks(spark, *world, [task], out, SAMPLE_TOTAL)
    before = published(spark, out)
    plain = str(tmp_path / "plain")
    job.run_tasks(spark, *world, [task], plain, SAMPLE_TOTAL)
    assert before == {name: values(job.result_rows(spark, plain, name, [1])) for name in job.RESULTS}

    half = world[0].where(F.xxhash64("session_id") % 2 == 0)
    write = job.write_by_task
    for tables in range(len(job.RESULTS)):
        left = [tables]

        def failing(*args, **more):
            if not left[0]:
                raise OSError("the cluster went away")
            left[0] -= 1
            write(*args, **more)

        monkeypatch.setattr(job, "write_by_task", failing)
        with pytest.raises(OSError):
            job.publish_tasks(spark, half, world[1], [task], out, SAMPLE_TOTAL)
        assert published(spark, out) == before
    monkeypatch.setattr(job, "write_by_task", write)
    run = job.publish_tasks(spark, half, world[1], [task], out, SAMPLE_TOTAL)
    after = published(spark, out)
    assert all(after[name] != before[name] for name in (job.STAT, job.SAMPLE, job.DETAIL))

    manifests = Manifests(spark, out)
    assert len(manifests.expire(out, list(job.RESULTS), keep=1)) == 1 + len(job.RESULTS) - 1  # the first run and those that wrote a table
    assert published(spark, out) == after and manifests.last() == {1: run} and len(manifests.versions()) == 1


def test_runs_of_other_tasks_side_by_side(spark, world, tmp_path, monkeypatch):
    """A run that publishes while another is about to is kept by it."""
    out = str(tmp_path)
    first = job.publish_tasks(spark, *world, [TASKS[1]], out, SAMPLE_TOTAL)
    create, between = Manifests.create, []

    def slow(self, version, tasks):
        if not between:
            between.append("other")
            assert Manifests(spark, out).publish("rother", [77])
        return create(self, version, tasks)

    monkeypatch.setattr(Manifests, "create", slow)
    others = [TASKS[i] for i in sorted(TASKS) if i != 1][:2]
    second = job.publish_tasks(spark, *world, others, out, SAMPLE_TOTAL)
    monkeypatch.setattr(Manifests, "create", create)
    assert Manifests(spark, out).last() == {1: first, 77: "rother", **{t.task_id: second for t in others}}
    got = job.published_rows(spark, out, job.STAT, [1, *[t.task_id for t in others]])
    assert {r["task_id"] for r in got.collect()} == {1, *[t.task_id for t in others]}
    assert "PartitionFilters" in got._jdf.queryExecution().executedPlan().toString()


def test_unfinished_manifests_are_passed_over(spark, tmp_path):
    manifests = Manifests(spark, str(tmp_path))
    assert manifests.publish("ra", [1]) == 1 and manifests.publish("rb", [2]) == 2
    assert not manifests.create(2, {})
    (tmp_path / "_manifests" / "000000000003").write_text('{"tasks": {"1": ')
    (tmp_path / "_manifests" / "000000000004").write_text("")
    assert Manifests(spark, str(tmp_path)).last() == {1: "ra", 2: "rb"}
    assert manifests.publish("rc", [1]) == 5 and manifests.last() == {1: "rc", 2: "rb"}
