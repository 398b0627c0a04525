"""Session roll-ups kept up to date: only days whose input files changed are rolled up again.

A store holds, for every day, what a task needs of the actions of that day, in four tables under
``<root>/<table>/run=<run>/date=<day>``:

- ``days``: (session) user, first and last time, number of actions,
- ``words``: distinct (session, keyword),
- ``categories``: clicks, orders and payments of (session, category),
- ``files``: a fingerprint of the input files that hold rows of the day.

All of them merge: a range of days is one aggregate over rows that are far fewer than actions. A refresh compares
the fingerprints of today's files with the stored ones, reads the changed days only, writes them as a run of
its own and switches to it by one manifest. A refresh that fails changes nothing. Fingerprints are taken before
the rows are read, so a file that changes meanwhile is found by the next refresh.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.functions.times import seconds_between
from visitlens.operators.categories import COUNTS, only_sessions, session_categories
from visitlens.operators.filters import filter_sessions
from visitlens.operators.rollup import roll_up
from visitlens.operators.sampling import DEFAULT_SEED, DEFAULT_TOTAL
from visitlens.operators.scan import actions_between, readable_date
from visitlens.operators.users import join_users
from visitlens.plans.single import TaskPlan
from visitlens.sinks.published import Manifests, new_run, table_path
from visitlens.sources.tables import as_actions
from visitlens.sources.tasks import Task

TABLES = {
    "days": "session_id string, user_id bigint, start_time timestamp, end_time timestamp, step_length bigint",
    "words": "session_id string, search_keyword string",
    "categories": "session_id string, category_id bigint, click_count bigint, order_count bigint, pay_count bigint",
    "files": "n_files bigint, mark bigint, total decimal(38,0)",
}


def _number(day: date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def _day(number: int) -> date:
    return date(number // 10000, number // 100 % 100, number % 100)


def fingerprints(source: DataFrame) -> DataFrame:
    """date, n_files, mark, total: the files of each day by path, size and time of change, in any order.

    ``source`` is a table of files with a column ``date``. Where it is partitioned by ``date``, no column is
    read, else that one. Each task sends a row for every day and file it has met.
    """
    about = F.xxhash64("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    files = source.select(readable_date(source).alias("date"), about.alias("file")).distinct()
    return files.where("date is not null").groupBy("date").agg(
        F.count(F.lit(1)).alias("n_files"), F.bit_xor("file").alias("mark"),
        F.sum(F.col("file").cast("decimal(20,0)")).cast("decimal(38,0)").alias("total"))


class SessionDays:
    """``SessionDays(spark, root).refresh(spark.read.parquet(actions))``, then :class:`MaintainedPlan`."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root = spark, root.rstrip("/")
        self._manifests = Manifests(spark, self._root)

    def table(self, name: str, start: date | None = None, end: date | None = None) -> DataFrame:
        """The stored rows of the days from ``start`` to ``end`` (both inclusive, None: no bound), with their ``date``.

        Only the folders of these days are read.
        """
        runs: dict[str, list[date]] = {}
        for number, run in self._manifests.last().items():
            day = _day(number)
            if (start is None or day >= start) and (end is None or day <= end):
                runs.setdefault(run, []).append(day)
        schema = f"{TABLES[name]}, run string, date date"
        if not runs:
            return self._spark.createDataFrame([], schema).drop("run")
        rows = self._spark.read.schema(schema).option("basePath", f"{self._root}/{name}").parquet(
            *[table_path(self._root, name, run) for run in sorted(runs)])
        mine = F.lit(False)
        for run, days in sorted(runs.items()):
            mine |= (F.col("run") == run) & F.col("date").isin(days)
        return rows.where(mine).drop("run")

    def refresh(self, source: DataFrame) -> list[date]:
        """Bring the store to the state of ``source`` (all action files, as they are now). Returns the days rolled
        up again. The days, not their sessions, are compared on the driver."""
        now = {row["date"]: tuple(row)[1:] for row in fingerprints(source).collect()}
        before = {row["date"]: (row["n_files"], row["mark"], row["total"]) for row in self.table("files").collect()}
        changed = sorted(day for day, files in now.items() if before.get(day) != files)
        gone = sorted(set(before) - set(now))
        if not changed and not gone:
            return []
        run = new_run()
        if changed:
            self._write(source, changed, run, [(day, *now[day]) for day in changed])
        self._manifests.publish(run, [_number(day) for day in changed], [_number(day) for day in gone])
        return changed

    def _write(self, source: DataFrame, changed: list[date], run: str, marks: list[tuple]) -> None:
        actions = as_actions(source)
        as_text = dict(actions.dtypes)["date"] == "string"
        # Literals of the stored type: other days' partitions are not read.
        actions = actions.where(F.col("date").isin([day.isoformat() if as_text else day for day in changed]))
        actions = actions.withColumn("date", readable_date(actions))
        parts = {
            "days": roll_up(actions, keys=("date", "session_id")).drop("visit_length"),
            "words": actions.where("search_keyword is not null").select("date", "session_id", "search_keyword").distinct(),
            "categories": session_categories(actions, ("date", "session_id")),
            "files": self._spark.createDataFrame(marks, f"date date, {TABLES['files']}").coalesce(1),
        }
        for name, rows in parts.items():
            rows.hint("rebalance", "date").write.partitionBy("date").parquet(table_path(self._root, name, run))

    def expire(self, keep: int = 2) -> list[str]:
        """Delete runs that none of the last ``keep`` states names. Not while a refresh is at work."""
        return self._manifests.expire(self._root, list(TABLES), keep)

    def sessions(self, task: Task) -> DataFrame:
        """:func:`~visitlens.operators.rollup.roll_up` of the task's days, and ``n_days``: on how many the session was."""
        parts = self.table("days", task.start_date, task.end_date).select(
            "session_id", "user_id", "start_time", "end_time", "step_length", F.lit(1).alias("n_days"),
            F.lit(False).alias("keyword_hit"), F.lit(False).alias("category_hit"))
        # Sessions that have what the task asks for come as rows that change nothing else, not by a join.
        if task.keywords is not None:
            words = self.table("words", task.start_date, task.end_date)
            parts = parts.unionByName(_hits(words.where(F.col("search_keyword").isin(list(task.keywords))), "keyword_hit", parts))
        if task.category_ids is not None:
            clicked = self.table("categories", task.start_date, task.end_date).where("click_count > 0")
            parts = parts.unionByName(_hits(clicked.where(F.col("category_id").isin(list(task.category_ids))), "category_hit", parts))
        return parts.groupBy("session_id").agg(
            F.min("user_id").alias("user_id"), F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"),
            F.sum("step_length").alias("step_length"), F.sum("n_days").alias("n_days"),
            F.bool_or("keyword_hit").alias("keyword_hit"), F.bool_or("category_hit").alias("category_hit"),
        ).withColumn("visit_length", seconds_between(F.col("start_time"), F.col("end_time")))

    def session_categories(self, task: Task) -> DataFrame:
        """Counts per (session, category) over the task's days."""
        parts = self.table("categories", task.start_date, task.end_date)
        return parts.groupBy("session_id", "category_id").agg(*[F.sum(c).alias(c) for c in COUNTS])

    def list_rows(self, task: Task) -> DataFrame:
        """session_id, search_keyword, click_category_id: what the lists of sessions are made from, of every
        session at least a row without either."""
        none = self.table("days", task.start_date, task.end_date).select(
            "session_id", F.lit(None).cast("string").alias("search_keyword"), F.lit(None).cast("bigint").alias("click_category_id"))
        words = self.table("words", task.start_date, task.end_date)
        clicked = self.table("categories", task.start_date, task.end_date).where("click_count > 0")
        return none.unionByName(words.select("session_id", "search_keyword", F.lit(None).cast("bigint").alias("click_category_id"))).unionByName(
            clicked.select("session_id", F.lit(None).cast("string").alias("search_keyword"), F.col("category_id").alias("click_category_id")))


def _hits(rows: DataFrame, flag: str, like: DataFrame) -> DataFrame:
    """Rows in the columns of ``like`` that say nothing but that a session has the flag."""
    neutral = {"step_length": F.lit(0), "n_days": F.lit(0), "keyword_hit": F.lit(False), "category_hit": F.lit(False), flag: F.lit(True)}
    return rows.select(*[
        F.col("session_id") if name == "session_id" else neutral.get(name, F.lit(None)).cast(kind).alias(name)
        for name, kind in like.dtypes
    ])


class MaintainedPlan(TaskPlan):
    """The results of one task from a store. ``actions`` serve the detail rows alone."""

    def __init__(self, store: SessionDays, actions: DataFrame, users: DataFrame, task: Task,
                 total: int = DEFAULT_TOTAL, seed: int = DEFAULT_SEED):
        self.store, self.task, self.total, self.seed = store, task, total, seed
        self.actions = actions_between(actions, task.start_date, task.end_date)
        self.sessions = filter_sessions(join_users(store.sessions(task), users), task).select(
            "session_id", "user_id", "start_time", "step_length", "visit_length", "n_days")
        self._per_session: DataFrame | None = None

    @property
    def per_session(self) -> DataFrame:
        if self._per_session is None:
            self._per_session = only_sessions(self.store.session_categories(self.task), self.sessions)
        return self._per_session

    @per_session.setter
    def per_session(self, kept: DataFrame) -> None:
        self._per_session = kept

    def daily_clicks(self) -> DataFrame:
        """date, session_id, category_id, click_count (above 0), of all sessions."""
        rows = self.store.table("categories", self.task.start_date, self.task.end_date)
        return rows.where("click_count > 0").select("date", "session_id", "category_id", "click_count")

    def sample(self, sampled: DataFrame | None = None, actions: DataFrame | None = None) -> DataFrame:
        return super().sample(sampled, self.store.list_rows(self.task) if actions is None else actions)
