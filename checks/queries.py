"""Every operator on the click stream derived from the driver tables.

Results use plain types (text, bigint, double), so that they compare across engines: dates, times
and lists are text.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.functions.times import format_time
from visitlens.operators import categories, details, filters, membership, rollup, sampling, skew, stats, users
from visitlens.operators.threshold_rounds import Rounds
from visitlens.plans.keep import Kept
from visitlens.plans.maintained import MaintainedPlan, SessionDays
from visitlens.plans.many import ManyTasksPlan
from visitlens.plans.single import TaskPlan, for_task
from visitlens.schemas import ACTION_COLUMNS, TOP_SESSION_COLUMNS
from visitlens.session import apply_runtime_conf
from visitlens.sources.derived import derived_actions, derived_tasks, derived_users
from visitlens.sources.tables import read_actions
from visitlens.sources.tasks import Task, decode_params, load_tasks

# The task rows of FIXTURES.md.
TASK_PARAMS = {
    1: '{"startDate":["2024-01-03"],"endDate":["2024-01-25"],"startAge":["10"],"endAge":["50"]}',
    2: '{"startDate":["2024-01-01"],"endDate":["2024-01-31"],"sex":["male"],"professionals":["BUILDING,MACHINERY"]}',
    3: '{"startDate":["2024-01-05"],"endDate":["2024-01-12"],"cities":["NATION_1,NATION_2,NATION_3"],"startAge":["20"]}',
    4: '{"startDate":["2024-01-01"],"endDate":["2024-01-31"],"keywords":["hotpot,tea"],"categoryIds":["0,7"]}',
}
TASKS = {i: Task.from_json(i, text) for i, text in TASK_PARAMS.items()}

# Tasks of the task table that the many-task queries run.
TABLE_TASKS = (1, 2, 3, 4)

# 100 sessions over 23 days truncate to none per hour; 1,000 leave something to compare.
SAMPLE_TOTAL = 1000

Query = Callable[[SparkSession, str], DataFrame]


def task_plan(spark: SparkSession, sf_dir: str, task_id: int = 1) -> TaskPlan:
    apply_runtime_conf(spark)
    return TaskPlan(
        derived_actions(spark, sf_dir), derived_users(spark, sf_dir), TASKS[task_id], total=SAMPLE_TOTAL
    )


def many_plan(spark: SparkSession, sf_dir: str) -> ManyTasksPlan:
    apply_runtime_conf(spark)
    tasks = load_tasks(derived_tasks(spark, sf_dir), TABLE_TASKS)
    return ManyTasksPlan(
        spark, derived_actions(spark, sf_dir), derived_users(spark, sf_dir), tasks, total=SAMPLE_TOTAL
    )


def _action_text(df: DataFrame) -> DataFrame:
    return (
        df.withColumn("date", F.date_format("date", "yyyy-MM-dd"))
        .withColumn("action_time", format_time(F.col("action_time")))
        .select(*ACTION_COLUMNS)
    )


def _session_text(df: DataFrame) -> DataFrame:
    for name in ("start_time", "end_time"):
        if name in df.columns:
            df = df.withColumn(name, format_time(F.col(name)))
    return df


def _joined(df: DataFrame) -> DataFrame:
    """Sessions with user attributes, widths as in the SQL."""
    df = _session_text(df).withColumn("age", F.col("age").cast("bigint"))
    return df.select(
        "session_id", "user_id", "start_time", "visit_length", "step_length", "age", "professional", "city", "sex"
    )


def action_range(spark, sf_dir):
    return _action_text(task_plan(spark, sf_dir).actions)


def session_agg(spark, sf_dir):
    return _session_text(rollup.roll_up_with_lists(task_plan(spark, sf_dir).actions))


def _sessions_and_users(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    plan = task_plan(spark, sf_dir)
    return rollup.roll_up(plan.actions), derived_users(spark, sf_dir)


def session_user_join(spark, sf_dir):
    return _joined(users.join_users(*_sessions_and_users(spark, sf_dir)))


def session_user_left_join(spark, sf_dir):
    return _joined(users.join_users(*_sessions_and_users(spark, sf_dir), how="left"))


def broadcast_user_join(spark, sf_dir):
    return _joined(users.broadcast_join_users(*_sessions_and_users(spark, sf_dir)))


def _stored(spark: SparkSession) -> Kept:
    """Tables for results that a query reads several times. They are deleted when the driver ends."""
    unset = spark.conf.get("spark.checkpoint.dir", None) is None
    kept = Kept(spark, f"file://{tempfile.mkdtemp(prefix='visitlens-')}" if unset else None)

    def end() -> None:
        with contextlib.suppress(Exception):  # the driver's JVM may have ended already
            kept.__exit__()

    atexit.register(end)
    return kept


def _stored_sessions_and_users(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Sessions rolled up once, for joins that read them several times."""
    sessions, people = _sessions_and_users(spark, sf_dir)
    return _stored(spark).keep(sessions, "sessions"), people


def salted_user_join(spark, sf_dir):
    return _joined(skew.salted_join_users(*_stored_sessions_and_users(spark, sf_dir)))


def split_user_join(spark, sf_dir):
    return _joined(skew.split_join_users(*_stored_sessions_and_users(spark, sf_dir)))


def balanced_user_join(spark, sf_dir):
    return _joined(skew.balanced_join_users(*_stored_sessions_and_users(spark, sf_dir)))


def heavy_categories(spark, sf_dir):
    return skew.keys_above(derived_actions(spark, sf_dir), "click_category_id", parts=16)


def skew_keys(spark, sf_dir):
    sessions, _ = _sessions_and_users(spark, sf_dir)
    return skew.heavy_keys(sessions, "user_id", "session_id", n=10, share=1.0)


def _one_filter(make, task_id: int) -> Query:
    """One filter alone, over the sessions of the task's dates."""

    def query(spark, sf_dir):
        plan = task_plan(spark, sf_dir, task_id)
        joined = users.join_users(rollup.roll_up(plan.actions, plan.task), derived_users(spark, sf_dir))
        return _joined(filters.filter_sessions(joined, plan.task, [make]))

    return query


def filter_session(spark, sf_dir):
    plan = task_plan(spark, sf_dir, 4)
    return _session_text(plan.sessions)


def filtered_actions(spark, sf_dir):
    plan = task_plan(spark, sf_dir)
    sessions = _stored(spark).keep(plan.sessions.select("session_id"), "sessions")
    return _action_text(membership.chosen_actions(plan.actions, sessions, sessions.count()))


def visit_length_hist(spark, sf_dir):
    return stats.visit_length_hist(task_plan(spark, sf_dir).sessions)


def step_length_hist(spark, sf_dir):
    return stats.step_length_hist(task_plan(spark, sf_dir).sessions)


def session_aggr_stat(spark, sf_dir):
    return task_plan(spark, sf_dir).stat()


def hour_counts(spark, sf_dir):
    return sampling.hour_counts(task_plan(spark, sf_dir).sessions)


def sample_quota(spark, sf_dir):
    return sampling.hour_quotas(sampling.hour_counts(task_plan(spark, sf_dir).sessions), SAMPLE_TOTAL)


def sample_sessions(spark, sf_dir):
    return task_plan(spark, sf_dir).sample()


def sample_detail(spark, sf_dir):
    return task_plan(spark, sf_dir).sample_detail()


def _category_count(kind: str) -> Query:
    def query(spark, sf_dir):
        plan = task_plan(spark, sf_dir)
        return categories.category_count(plan.actions, plan.sessions, kind)

    return query


def category_counts(spark, sf_dir):
    return categories.category_totals(task_plan(spark, sf_dir).per_session)


def distinct_categories(spark, sf_dir):
    return categories.distinct_categories(task_plan(spark, sf_dir).per_session)


def salted_category_count(spark, sf_dir):
    plan = task_plan(spark, sf_dir)
    actions = details.actions_of(plan.actions, plan.sessions)
    counted = skew.salted_count(actions, "click_category_id", "session_id")
    return counted.select(F.col("click_category_id").alias("category_id"), F.col("row_count").alias("click_count"))


def top10_category(spark, sf_dir):
    return task_plan(spark, sf_dir).top_category()


def category_session_counts(spark, sf_dir):
    return task_plan(spark, sf_dir).session_clicks()


def top10_session(spark, sf_dir):
    return task_plan(spark, sf_dir).top_session()


def top10_session_detail(spark, sf_dir):
    return task_plan(spark, sf_dir).top_session_detail()


def task_params(spark, sf_dir):
    return decode_params(derived_tasks(spark, sf_dir))


def task_by_id(spark, sf_dir):
    """One task found by its id, from the row as it is stored."""
    return decode_params(derived_tasks(spark, sf_dir).where(F.col("task_id") == 7))


def delivered_actions(spark, sf_dir):
    """The click stream as delivered, in a view of text dates and times in several forms, read back typed:
    unpadded hours, unpadded fields, trailing text, the hours 24 to 47 of the day before, the months 13 to 24 of the year before."""
    time = F.col("action_time")
    carried_day = F.concat(F.date_format(time - F.expr("interval 1 day"), "yyyy-MM-dd "), (F.hour(time) + 24).cast("string"), F.date_format(time, ":mm:ss"))
    carried_month = F.concat((F.year(time) - 1).cast("string"), F.lit("-"), (F.month(time) + 12).cast("string"), F.date_format(time, "-d H:m:s"))
    forms = F.array(
        F.date_format(time, "yyyy-MM-dd H:mm:ss"), F.date_format(time, "yyyy-M-d H:m:s"),
        F.date_format(time, "yyyy-MM-dd HH:mm:ss.'0'"), carried_day, carried_month)
    text = derived_actions(spark, sf_dir).withColumns({
        "date": F.date_format("date", "yyyy-MM-dd"), "action_time": F.element_at(forms, F.second(time) % 5 + 1),
    })
    text.createOrReplaceTempView("delivered_actions")
    return _action_text(read_actions(spark, "delivered_actions"))


def _maintained(spark, sf_dir, task_id: int = 1) -> tuple[MaintainedPlan, Kept]:
    """A task's plan over stored days. They are filled twice: from two thirds of the sessions of the first half of the
    month, then with the rest, which comes late to days already stored."""
    plan, kept = task_plan(spark, sf_dir, task_id), _stored(spark)
    actions = derived_actions(spark, sf_dir)
    early = (F.dayofmonth("date") <= 15) & (F.pmod(F.xxhash64("session_id"), F.lit(3)) > 0)
    store = SessionDays(spark, kept.path("store"))
    for part in (actions.where(early), actions.where(~early)):
        part.hint("rebalance", "date").write.mode("append").partitionBy("date").parquet(kept.path("actions"))
        store.refresh(spark.read.schema(plan.actions.schema).parquet(kept.path("actions")))
    stored = spark.read.schema(plan.actions.schema).parquet(kept.path("actions"))
    return MaintainedPlan(store, stored, derived_users(spark, sf_dir), plan.task, total=SAMPLE_TOTAL), kept


def maintained_stat(spark, sf_dir):
    return _maintained(spark, sf_dir)[0].stat()


def maintained_sample(spark, sf_dir):
    return _maintained(spark, sf_dir)[0].sample()


def maintained_sessions(spark, sf_dir):
    return _session_text(_maintained(spark, sf_dir, 4)[0].sessions.drop("n_days"))


def rounds_top10_session(spark, sf_dir):
    """The top sessions from stored days in rounds."""
    plan, kept = _maintained(spark, sf_dir)
    plan.sessions = kept.keep(plan.sessions, "sessions")
    top = kept.keep(plan.top_category(), "top")
    rounds = Rounds(plan.daily_clicks(), plan.sessions, plan.sessions.count(), top, kept.keep)
    return for_task(rounds.top, plan.task.task_id).select(*TOP_SESSION_COLUMNS)


def multi_task_stat(spark, sf_dir):
    return many_plan(spark, sf_dir).stat()


def multi_task_sample(spark, sf_dir):
    return many_plan(spark, sf_dir).sample()


def multi_task_top10_category(spark, sf_dir):
    return many_plan(spark, sf_dir).top_category()


def multi_task_top10_session(spark, sf_dir):
    return many_plan(spark, sf_dir).top_session()


QUERIES: dict[str, Query] = {
    "action_range": action_range,
    "session_agg": session_agg,
    "session_user_join": session_user_join,
    "session_user_left_join": session_user_left_join,
    "broadcast_user_join": broadcast_user_join,
    "salted_user_join": salted_user_join,
    "split_user_join": split_user_join,
    "balanced_user_join": balanced_user_join,
    "heavy_categories": heavy_categories,
    "skew_keys": skew_keys,
    "filter_age": _one_filter(filters.age_filter, 1),
    "filter_professional": _one_filter(filters.professional_filter, 2),
    "filter_city": _one_filter(filters.city_filter, 3),
    "filter_sex": _one_filter(filters.sex_filter, 2),
    "filter_keyword": _one_filter(filters.keyword_filter, 4),
    "filter_category": _one_filter(filters.category_filter, 4),
    "filter_session": filter_session,
    "filtered_actions": filtered_actions,
    "visit_length_hist": visit_length_hist,
    "step_length_hist": step_length_hist,
    "session_aggr_stat": session_aggr_stat,
    "hour_counts": hour_counts,
    "sample_quota": sample_quota,
    "sample_sessions": sample_sessions,
    "sample_detail": sample_detail,
    "category_click_count": _category_count("click"),
    "category_order_count": _category_count("order"),
    "category_pay_count": _category_count("pay"),
    "category_counts": category_counts,
    "distinct_categories": distinct_categories,
    "salted_category_count": salted_category_count,
    "top10_category": top10_category,
    "category_session_counts": category_session_counts,
    "top10_session": top10_session,
    "top10_session_detail": top10_session_detail,
    "task_params": task_params,
    "task_by_id": task_by_id,
    "delivered_actions": delivered_actions,
    "maintained_stat": maintained_stat,
    "maintained_sample": maintained_sample,
    "maintained_sessions": maintained_sessions,
    "rounds_top10_session": rounds_top10_session,
    "multi_task_stat": multi_task_stat,
    "multi_task_sample": multi_task_sample,
    "multi_task_top10_category": multi_task_top10_category,
    "multi_task_top10_session": multi_task_top10_session,
}
