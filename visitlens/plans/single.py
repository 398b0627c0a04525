"""One task: from actions, users and parameters to sessions and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.functions.times import format_time
from visitlens.operators.bounds import broadcast_if
from visitlens.operators.categories import (
    TOP_N, category_totals, clicks_in_top, only_sessions, session_categories, top_categories, top_sessions,
)
from visitlens.operators.details import details_of
from visitlens.operators.filters import filter_sessions
from visitlens.operators.membership import filter_of, fits, may_be_in
from visitlens.operators.rollup import roll_up, session_lists
from visitlens.operators.sampling import DEFAULT_SEED, DEFAULT_TOTAL, sample_sessions
from visitlens.operators.scan import actions_between
from visitlens.operators.stats import session_shares
from visitlens.operators.users import join_users
from visitlens.schemas import SAMPLE_COLUMNS, STAT_COLUMNS, TOP_CATEGORY_COLUMNS, TOP_SESSION_COLUMNS
from visitlens.sources.tasks import Task


def for_task(df: DataFrame, task_id: int) -> DataFrame:
    return df.withColumn("task_id", F.lit(task_id).cast("bigint"))


class TaskPlan:
    """The lazy results of one task. Nothing runs until a result is written or collected.

    ``sessions`` and ``per_session`` (the filtered sessions, and their category counts) are read by
    several results; a job replaces them by kept copies. Where it knows how many kept sessions there are
    (``n_sessions``), actions of other sessions are filtered out where they are read.
    """

    n_sessions: int | None = None

    def __init__(self, actions: DataFrame, users: DataFrame, task: Task,
                 total: int = DEFAULT_TOTAL, seed: int = DEFAULT_SEED):
        self.task, self.total, self.seed = task, total, seed
        self.actions = actions_between(actions, task.start_date, task.end_date)
        joined = join_users(roll_up(self.actions, task), users)
        self.sessions = filter_sessions(joined, task).select(
            "session_id", "user_id", "start_time", "step_length", "visit_length"
        )
        self._per_session: DataFrame | None = None

    @property
    def per_session(self) -> DataFrame:
        if self._per_session is None:
            actions = self.actions
            if self.n_sessions is not None and fits(self.n_sessions):
                actions = may_be_in(actions, filter_of(self.sessions, self.n_sessions), self.n_sessions)
            self._per_session = only_sessions(session_categories(actions), self.sessions)
        return self._per_session

    @per_session.setter
    def per_session(self, kept: DataFrame) -> None:
        self._per_session = kept

    def stat(self) -> DataFrame:
        return for_task(session_shares(self.sessions), self.task.task_id).select(*STAT_COLUMNS)

    def sampled(self) -> DataFrame:
        """The sampled sessions, without their lists."""
        return for_task(sample_sessions(self.sessions, self.total, self.seed), self.task.task_id)

    def sample(self, sampled: DataFrame | None = None, actions: DataFrame | None = None) -> DataFrame:
        """``session_random_extract``. The lists are made for the sampled sessions only; ``actions``
        may be any relation that holds all actions of these."""
        sampled = self.sampled() if sampled is None else sampled
        actions = self.actions if actions is None else actions
        columns = ["search_keyword", "click_category_id"]
        chosen = sampled.select("task_id", F.col("session_id").alias("_id"), "start_time")
        # Null-safe: actions without a session id form one session, and it may be drawn.
        rows = actions.select("session_id", *columns).join(
            broadcast_if(chosen, self.total), F.col("session_id").eqNullSafe(F.col("_id")))
        lists = session_lists(rows, ["task_id", "session_id", "start_time"])
        return lists.withColumn("start_time", format_time(F.col("start_time"))).select(*SAMPLE_COLUMNS)

    def sample_detail(self) -> DataFrame:
        return details_of(self.actions, self.sampled(), self.total)

    def top_category(self) -> DataFrame:
        return for_task(top_categories(category_totals(self.per_session)), self.task.task_id).select(*TOP_CATEGORY_COLUMNS)

    def session_clicks(self, top: DataFrame | None = None) -> DataFrame:
        return clicks_in_top(self.per_session, self.top_category() if top is None else top)

    def top_session(self, top: DataFrame | None = None) -> DataFrame:
        return for_task(top_sessions(self.session_clicks(top)), self.task.task_id).select(*TOP_SESSION_COLUMNS)

    def top_session_detail(self) -> DataFrame:
        """A session ranked in several categories comes once for each; ``category_id`` tells which."""
        chosen = self.top_session().select("task_id", "session_id", "category_id")
        return details_of(self.actions, chosen, TOP_N * TOP_N, ["category_id"])

    def details(self, chosen: DataFrame, tags: list[str]) -> DataFrame:
        """Detail rows of sampled and ranked sessions together."""
        return details_of(self.actions, chosen, self.total + TOP_N * TOP_N, tags)
