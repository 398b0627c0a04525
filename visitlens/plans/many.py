"""Many tasks over the same actions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.functions.times import format_time
from visitlens.operators.bounds import broadcast_if
from visitlens.operators.categories import TOP_N, category_totals, clicks_in_top, top_categories, top_sessions
from visitlens.operators.details import as_details
from visitlens.operators.many_tasks import BY_TASK, bounded, rows_of, task_session_categories, task_sessions
from visitlens.operators.rollup import session_lists
from visitlens.operators.sampling import DEFAULT_SEED, DEFAULT_TOTAL, sample_sessions
from visitlens.operators.stats import session_shares
from visitlens.schemas import SAMPLE_COLUMNS, STAT_COLUMNS, TOP_CATEGORY_COLUMNS, TOP_SESSION_COLUMNS
from visitlens.sources.tasks import Task, task_frame


class ManyTasksPlan:
    """Like :class:`visitlens.plans.single.TaskPlan`, every result for all tasks at once."""

    def __init__(self, spark: SparkSession, actions: DataFrame, users: DataFrame, tasks: Sequence[Task],
                 total: int = DEFAULT_TOTAL, seed: int = DEFAULT_SEED):
        if len({t.task_id for t in tasks}) != len(tasks):
            raise ValueError("task ids must be distinct")
        self.spark, self.total, self.seed = spark, total, seed
        self.actions, self.tasks = bounded(actions, tasks), list(tasks)
        self.sessions = task_sessions(spark, self.actions, users, self.tasks)
        self._per_session: DataFrame | None = None

    @property
    def task_ids(self) -> list[int]:
        return [t.task_id for t in self.tasks]

    @property
    def per_session(self) -> DataFrame:
        if self._per_session is None:
            self._per_session = task_session_categories(self.spark, self.actions, self.sessions, self.tasks)
        return self._per_session

    @per_session.setter
    def per_session(self, kept: DataFrame) -> None:
        self._per_session = kept

    def stat(self) -> DataFrame:
        """A task without sessions has a row too: count 0, null ratios."""
        ids = task_frame(self.spark, self.tasks).select("task_id")
        return (
            ids.join(session_shares(self.sessions, BY_TASK), "task_id", "left")
            .fillna({"session_count": 0})
            .select(*STAT_COLUMNS)
        )

    def sampled(self) -> DataFrame:
        return sample_sessions(self.sessions, self.total, self.seed, BY_TASK, len(self.tasks))

    def sample(self, sampled: DataFrame | None = None, rows: DataFrame | None = None) -> DataFrame:
        """``rows``: the sampled sessions' actions with their ``task_id``, if already at hand."""
        sampled = self.sampled() if sampled is None else sampled
        if rows is None:
            chosen = sampled.select("task_id", "session_id", "start_time")
            rows = rows_of(self.spark, self.actions, chosen, self.total * len(self.tasks), self.tasks, null_ids=True)
        else:
            columns = ["task_id", "session_id", "search_keyword", "click_category_id"]
            chosen = sampled.select("task_id", "session_id", "start_time")
            chosen = broadcast_if(chosen, self.total * len(self.tasks))
            rows = rows.select(*columns).join(chosen, ["task_id", "session_id"])
        lists = session_lists(rows, ["task_id", "session_id", "start_time"])
        return lists.withColumn("start_time", format_time(F.col("start_time"))).select(*SAMPLE_COLUMNS)

    def _rows_of(self, chosen: DataFrame, tags: list[str], per_task: int) -> DataFrame:
        chosen = chosen.select("task_id", "session_id", *tags)
        return rows_of(self.spark, self.actions, chosen, per_task * len(self.tasks), self.tasks)

    def sample_detail(self) -> DataFrame:
        return as_details(self._rows_of(self.sampled(), [], self.total))

    def top_category(self) -> DataFrame:
        return top_categories(category_totals(self.per_session, BY_TASK), by=BY_TASK).select(*TOP_CATEGORY_COLUMNS)

    def top_session(self, top: DataFrame | None = None) -> DataFrame:
        top = self.top_category() if top is None else top
        clicks = clicks_in_top(self.per_session, top, by=BY_TASK, groups=len(self.tasks))
        return top_sessions(clicks, by=BY_TASK).select(*TOP_SESSION_COLUMNS)

    def top_session_detail(self) -> DataFrame:
        return as_details(self._rows_of(self.top_session(), ["category_id"], TOP_N * TOP_N), ["category_id"])

    def details(self, chosen: DataFrame, tags: list[str]) -> DataFrame:
        """Detail rows of sampled and ranked sessions together."""
        return as_details(self._rows_of(chosen, tags, self.total + TOP_N * TOP_N), tags)
