"""Sessions of many tasks from one pass over the actions.

A session is cut at each task's date range before it is rolled up, so tasks cannot share sessions.
They do share *session-days*: a day is inside a range or outside it. Actions are rolled up once to
(session, day), joined with their users there, and brought together by session; only then is a session
copied, to the tasks that its users and its days can be in.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.functions.times import seconds_between
from visitlens.operators.bounds import broadcast_if
from visitlens.operators.categories import COUNTS, session_categories
from visitlens.operators.day_blocks import levels, merged
from visitlens.operators.scan import actions_between, readable_date
from visitlens.operators.task_index import TaskIndex, both, either, has, numbers_in
from visitlens.sources.tasks import Task, task_frame

BY_TASK = ("task_id",)

# Wanted values that share one bigint, a bit each.
MASK_BITS = 63


def merged_ranges(tasks: Sequence[Task]) -> list[tuple[date, date]] | None:
    """The days any task asks for as disjoint ranges; None if a task lacks a bound."""
    if any(t.start_date is None or t.end_date is None for t in tasks):
        return None
    merged: list[tuple[date, date]] = []
    for start, end in sorted((t.start_date, t.end_date) for t in tasks if t.start_date <= t.end_date):
        if merged and start.toordinal() <= merged[-1][1].toordinal() + 1:
            merged[-1] = merged[-1][0], max(end, merged[-1][1])
        else:
            merged.append((start, end))
    return merged


def bounded(actions: DataFrame, tasks: Sequence[Task]) -> DataFrame:
    """Actions of the days any task asks for, their ``date`` as a day; undated ones are in no task.

    The ranges are literals, gaps between them included. If a task lacks a bound, so does the scan.
    """
    ranges = merged_ranges(tasks)
    start = min((t.start_date for t in tasks), default=None) if all(t.start_date for t in tasks) else None
    end = max((t.end_date for t in tasks), default=None) if all(t.end_date for t in tasks) else None
    span = actions_between(actions, start, end)
    if ranges is not None and len(ranges) > 1:
        as_text = dict(actions.dtypes)["date"] == "string"
        bound = (lambda day: F.lit(day.isoformat())) if as_text else F.lit
        span = span.where(reduce(lambda x, y: x | y, (F.col("date").between(bound(a), bound(b)) for a, b in ranges)))
    return span.withColumn("date", readable_date(span))


def _wanted(values) -> list:
    return sorted({v for given in values if given is not None for v in given})


def _width(values: Sequence) -> int:
    """Masks needed for so many values."""
    return -(-len(values) // MASK_BITS)


def _masks(values: list, given) -> list[int | None]:
    """The bits of ``given`` among ``values``, in as many numbers as are needed; None asks for nothing."""
    if given is None:
        return [None] * _width(values)
    masks = [0] * _width(values)
    for value in given:
        at = values.index(value)
        masks[at // MASK_BITS] |= 1 << at % MASK_BITS
    return masks


def _seen(column: str, values: list, name: str) -> list[Column]:
    """One fixed-width aggregate per mask: the wanted values that occur."""
    if not values:
        return []
    at = F.array_position(F.array(*map(F.lit, values)), F.col(column)) - 1
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(at, F.lit(MASK_BITS)).cast("int"))
    return [
        F.bit_or(F.when(at.between(n * MASK_BITS, n * MASK_BITS + MASK_BITS - 1), bit)).alias(f"{name}_{n}")
        for n in range(_width(values))
    ]


def _params(spark, tasks: Sequence[Task], keywords: list, categories: list) -> DataFrame:
    """Number, dates, and what each task asks of sessions as bit masks."""
    kinds = ["number int", "task_id bigint", "start_date date", "end_date date", "by_keyword boolean", "by_category boolean"]
    kinds += [f"{name}_mask_{n} bigint" for name, values in (("keyword", keywords), ("category", categories)) for n in range(_width(values))]
    rows = [
        (i, t.task_id, t.start_date, t.end_date, t.keywords is not None, t.category_ids is not None, *_masks(keywords, t.keywords), *_masks(categories, t.category_ids))
        for i, t in enumerate(tasks)
    ]
    return broadcast_if(spark.createDataFrame(rows, ", ".join(kinds)), len(tasks))


def _merge(masks: Sequence[str]):
    """Two stretches of a session in one."""
    def merge(x: Column, y: Column) -> Column:
        return F.struct(
            F.least(x["user_id"], y["user_id"]).alias("user_id"),
            F.least(x["start_time"], y["start_time"]).alias("start_time"),
            F.greatest(x["end_time"], y["end_time"]).alias("end_time"),
            (x["step_length"] + y["step_length"]).alias("step_length"),
            *[x[m].bitwiseOR(y[m]).alias(m) for m in masks],
        )

    return merge


def _met(name: str, values: list) -> Column:
    """A task that gives no list passes; a given one passes if one of its values was seen."""
    seen = [F.col(f"part.{name}_{n}").bitwiseAND(F.col(f"{name}_mask_{n}")) != 0 for n in range(_width(values))]
    return ~F.col(f"by_{name}") | reduce(lambda x, y: x | y, seen, F.lit(False))


def session_days(actions: DataFrame, keywords: list = (), categories: list = ()) -> DataFrame:
    """One fixed-width row per session and day, whatever the tasks."""
    return actions.groupBy("session_id", "date").agg(
        F.min("user_id").alias("user_id"),
        F.min("action_time").alias("start_time"),
        F.max("action_time").alias("end_time"),
        F.count(F.lit(1)).alias("step_length"),
        *_seen("search_keyword", list(keywords), "keyword"),
        *_seen("click_category_id", list(categories), "category"),
    )


def task_sessions(spark, actions: DataFrame, users: DataFrame, tasks: Sequence[Task]) -> DataFrame:
    """Filtered sessions of every task: task_id, session_id, user_id, start_time, step_length,
    visit_length. Takes what :func:`bounded` returns.

    Users and days carry bitmaps of tasks (:mod:`task_index`); a session is copied only to tasks that
    both have, after its days have come together, so that what a task makes of them needs no shuffle.
    A task's days are merged from the session's dyadic blocks (:mod:`day_blocks`). A session holds as
    many days as it has rows here, each of fixed width. It belongs to its least user in the task's dates,
    and passes if that user does.
    """
    keywords = _wanted(t.keywords for t in tasks)
    categories = _wanted(t.category_ids for t in tasks)
    masks = [f"keyword_{n}" for n in range(_width(keywords))] + [f"category_{n}" for n in range(_width(categories))]
    measures = ["user_id", "start_time", "end_time", "step_length", *masks]
    index = TaskIndex(spark, tasks)
    merge = _merge(masks)

    days = session_days(actions, keywords, categories).fillna(0, masks) if masks else session_days(actions)
    days = index.of_days(days.join(index.of_users(users), "user_id", "left"), "held")
    none = F.array(*[F.lit(0).cast("bigint") for _ in index.every])
    day = F.struct("date", F.coalesce("tasks", none).alias("tasks"), "held", F.struct(*measures).alias("part"))
    sessions = days.groupBy("session_id").agg(F.collect_list(day).alias("days"))
    sessions = sessions.withColumn("days", F.array_sort("days"))

    def any_of(name: str) -> Column:
        return F.aggregate("days", none, lambda found, d: either(found, d[name]))

    sessions = sessions.select(
        "session_id", F.transform("days", lambda d: F.struct(d["date"].alias("date"), d["tasks"].alias("tasks"), d["part"]["user_id"].alias("user_id"))).alias("days"),
        levels(F.transform("days", lambda d: d["part"]), merge).alias("blocks"),
        numbers_in(both(any_of("tasks"), any_of("held"))).alias("numbers"))
    pairs = sessions.select("session_id", "days", "blocks", F.explode("numbers").alias("number"))
    pairs = pairs.join(_params(spark, tasks, keywords, categories), "number")

    def before(test) -> Column:
        return F.size(F.filter("days", lambda d: F.coalesce(test(d["date"]), F.lit(False))))

    first = before(lambda d: d < F.col("start_date"))
    last = F.when(F.col("end_date").isNull(), F.size("days")).otherwise(before(lambda d: d <= F.col("end_date")))
    nothing = F.struct(
        F.lit(None).cast("bigint").alias("user_id"), F.lit(None).cast(actions.schema["action_time"].dataType).alias("start_time"),
        F.lit(None).cast(actions.schema["action_time"].dataType).alias("end_time"), F.lit(0).cast("bigint").alias("step_length"),
        *[F.lit(0).cast("bigint").alias(m) for m in masks])
    pairs = pairs.select("*", first.alias("first"), (last - first).alias("count")).where("count > 0")
    pairs = pairs.withColumn("part", merged(F.col("blocks"), F.col("first"), F.col("count"), merge, nothing))
    passes = F.exists("days", lambda d: (d["user_id"] == F.col("part.user_id")) & has(d["tasks"], F.col("number")))
    return (
        pairs.where(passes & _met("keyword", keywords) & _met("category", categories))
        .select("task_id", "session_id", "part.user_id", "part.start_time", "part.step_length",
                seconds_between(F.col("part.start_time"), F.col("part.end_time")).alias("visit_length"))
    )


def task_session_categories(spark, actions: DataFrame, sessions: DataFrame, tasks: Sequence[Task]) -> DataFrame:
    """Counts per (task, session, category) for the filtered ``sessions`` of every task.

    Only days of sessions that pass are copied, and only to the tasks they pass.
    """
    per_day = session_categories(actions, ("session_id", "date"))
    dates = broadcast_if(task_frame(spark, tasks).select("task_id", "start_date", "end_date"), len(tasks))
    chosen = sessions.select("task_id", "session_id").join(dates, "task_id")
    inside = "(start_date is null or date >= start_date) and (end_date is null or date <= end_date)"
    return (
        per_day.join(chosen, "session_id").where(inside)
        .groupBy("task_id", "session_id", "category_id")
        .agg(*[F.sum(c).alias(c) for c in COUNTS])
    )


def rows_of(
    spark, actions: DataFrame, chosen: DataFrame, at_most: int, tasks: Sequence[Task], null_ids: bool = False,
) -> DataFrame:
    """Actions of a bounded choice (task_id, session_id, tags), each inside its task's dates, which
    travel with the choice. ``null_ids``: those without a session id too."""
    dates = task_frame(spark, tasks).select("task_id", "start_date", "end_date")
    dated = chosen.join(broadcast_if(dates, len(tasks)), "task_id")
    dated = broadcast_if(dated.withColumnRenamed("session_id", "_id"), at_most)
    same = F.col("session_id").eqNullSafe(F.col("_id")) if null_ids else F.col("session_id") == F.col("_id")
    inside = "(start_date is null or date >= start_date) and (end_date is null or date <= end_date)"
    return actions.join(dated, same).where(inside).drop("start_date", "end_date", "_id")
