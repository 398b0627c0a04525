"""Run tasks and write their result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.functions.times import parse_time
from visitlens.operators.sampling import DEFAULT_SEED, DEFAULT_TOTAL
from visitlens.plans.keep import Kept
from visitlens.plans.many import ManyTasksPlan
from visitlens.plans.single import TaskPlan
from visitlens.schemas import (
    DETAIL_COLUMNS, DETAIL_TAGS, SAMPLE_COLUMNS, STAT_COLUMNS, TOP_CATEGORY_COLUMNS, TOP_SESSION_COLUMNS,
)
from visitlens.sinks.files import rebalanced, write_by_task
from visitlens.sinks.jdbc import write_jdbc
from visitlens.sinks.published import Manifests, new_run, read_published, table_path
from visitlens.sources.tasks import Task

# Result table names.
STAT, SAMPLE, DETAIL = "session_aggr_stat", "session_random_extract", "session_detail"
TOP_CATEGORY, TOP_SESSION = "top10_category", "top10_session"
RESULTS = {
    STAT: STAT_COLUMNS,
    SAMPLE: SAMPLE_COLUMNS,
    DETAIL: DETAIL_COLUMNS,
    TOP_CATEGORY: TOP_CATEGORY_COLUMNS,
    TOP_SESSION: TOP_SESSION_COLUMNS,
}


def run_tasks(
    spark: SparkSession, actions: DataFrame, users: DataFrame, tasks: Sequence[Task], out: str,
    total: int = DEFAULT_TOTAL, seed: int = DEFAULT_SEED, work_folder: str | None = None, run: str | None = None,
) -> None:
    """Write the five tables under ``out`` for one task or many; with ``run``, into that run's folders.

    The actions are read three times, each time with only the columns needed: for the sessions, for
    the category counts, and once for all detail rows. Everything else works on kept results, for
    which ``work_folder`` (shared by all executors) is used where ``spark.checkpoint.dir`` is unset.
    """
    if len(tasks) == 1:
        plan = TaskPlan(actions, users, tasks[0], total, seed)
    else:
        plan = ManyTasksPlan(spark, actions, users, tasks, total, seed)
    ids = [t.task_id for t in tasks]

    with Kept(spark, work_folder) as kept:
        plan.sessions = kept.keep(plan.sessions, "sessions")
        if isinstance(plan, TaskPlan):
            plan.n_sessions = plan.sessions.count()
        write_by_task(plan.stat(), table_path(out, STAT, run), ids)
        plan.per_session = kept.keep(plan.per_session, "session_categories")
        top = kept.keep(plan.top_category(), "top_category")
        write_by_task(top, table_path(out, TOP_CATEGORY, run), ids)
        ranked = kept.keep(plan.top_session(top), "top_session")
        write_by_task(ranked, table_path(out, TOP_SESSION, run), ids)
        sampled = kept.keep(plan.sampled(), "sampled")

        chosen = _tagged(sampled, "sample", F.lit(None).cast("bigint")).unionByName(
            _tagged(ranked, "top10", F.col("category_id"))
        )
        details = plan.details(chosen, DETAIL_TAGS)
        write_by_task(rebalanced(details), table_path(out, DETAIL, run), ids)

        # The sampled sessions' actions were just written; their lists come from there.
        rows = (
            spark.read.schema(details.schema).parquet(table_path(out, DETAIL, run))
            .where(F.col("task_id").isin(ids) & (F.col("origin") == "sample"))
            .withColumn("action_time", parse_time(F.col("action_time")))
        )
        write_by_task(plan.sample(sampled, rows), table_path(out, SAMPLE, run), ids)


def publish_tasks(spark: SparkSession, actions: DataFrame, users: DataFrame, tasks: Sequence[Task], out: str, *args, **options) -> str:
    """:func:`run_tasks` into a run of its own, whose five tables readers of :func:`published_rows` see
    together, once all are written. A run that fails changes nothing for them. Returns the run's name."""
    run = new_run()
    run_tasks(spark, actions, users, tasks, out, *args, run=run, **options)
    Manifests(spark, out).publish(run, [t.task_id for t in tasks])
    return run


def published_rows(spark: SparkSession, out: str, name: str, task_ids: Sequence[int] | None = None) -> DataFrame | None:
    """Published rows of a result table, in the column order of the database table."""
    rows = read_published(spark, out, name, task_ids)
    return None if rows is None else rows.select(*RESULTS[name])


def _tagged(chosen: DataFrame, origin: str, category) -> DataFrame:
    return chosen.select("task_id", "session_id", F.lit(origin).alias("origin"), category.alias("for_category_id"))


def result_rows(spark: SparkSession, out: str, name: str, task_ids: Sequence[int]) -> DataFrame:
    """Rows of these tasks of a written result table, in the column order of the database table."""
    rows = spark.read.parquet(f"{out}/{name}").where(F.col("task_id").isin(list(task_ids)))
    return rows.withColumn("task_id", F.col("task_id").cast("bigint")).select(*RESULTS[name])


def export_tables(spark: SparkSession, out: str, task_ids: Sequence[int], url: str, published: bool = False, **options: str) -> None:
    """Append the written (or published) results of these tasks to a database's tables of the same names."""
    for name in RESULTS:
        rows = published_rows(spark, out, name, task_ids) if published else result_rows(spark, out, name, task_ids)
        if rows is not None:
            write_jdbc(rows, url, name, **options)
