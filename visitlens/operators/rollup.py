"""Actions rolled up to sessions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.functions.lists import non_empty, sorted_text
from visitlens.functions.times import seconds_between
from visitlens.sources.tasks import Task


def _measures() -> list[Column]:
    # All four combine map-side into one fixed-width row per session and task, so a session that
    # owns a large share of the rows costs the reducer one row per map task.
    return [
        F.min("user_id").alias("user_id"),
        F.min("action_time").alias("start_time"),
        F.max("action_time").alias("end_time"),
        F.count(F.lit(1)).alias("step_length"),
    ]


def hit_flags(task: Task) -> list[Column]:
    """Whether any action of the session searched / clicked what the task asks for.

    One boolean per session, instead of collecting every session's keywords and categories to
    compare them afterwards.
    """
    flags = []
    if task.keywords is not None:
        flags.append(_any_of(F.col("search_keyword"), task.keywords).alias("keyword_hit"))
    if task.category_ids is not None:
        flags.append(_any_of(F.col("click_category_id"), task.category_ids).alias("category_hit"))
    return flags


def _any_of(column: Column, values: Sequence) -> Column:
    return F.coalesce(F.bool_or(column.isin(list(values))), F.lit(False))


def roll_up(actions: DataFrame, task: Task | None = None, keys: Sequence[str] = ("session_id",)) -> DataFrame:
    """One row per session (or other ``keys``): user_id, start_time, end_time, step_length, visit_length, hit flags.

    Rows without a readable time count as steps but not for start and end.
    """
    flags = hit_flags(task) if task is not None else []
    return (
        actions.groupBy(*keys)
        .agg(*_measures(), *flags)
        .withColumn("visit_length", seconds_between(F.col("start_time"), F.col("end_time")))
    )


def session_lists(actions: DataFrame, keys: Sequence[str] = ("session_id",)) -> DataFrame:
    """Distinct keywords and clicked categories per session as sorted comma lists."""
    return (
        actions.groupBy(*keys)
        .agg(
            F.collect_set(non_empty(F.col("search_keyword"))).alias("_keywords"),
            F.collect_set("click_category_id").alias("_categories"),
        )
        .select(
            *keys,
            sorted_text(F.col("_keywords")).alias("search_keywords"),
            # sorted as numbers, joined as text
            non_empty(F.array_join(F.array_sort("_categories").cast("array<string>"), ",")).alias("click_category_ids"),
        )
    )


def roll_up_with_lists(actions: DataFrame) -> DataFrame:
    """:func:`roll_up` plus the two lists.

    For callers that want the lists of *every* session; the job computes them for sampled ones only.
    The lists come from distinct (session, value) pairs, which combine map-side like the measures: no
    reducer gets the raw rows of a session.
    """
    sessions = roll_up(actions)
    keyword = non_empty(F.col("search_keyword"))
    values = F.array(
        F.struct(keyword.alias("keyword"), F.lit(None).cast("bigint").alias("category")),
        F.struct(F.lit(None).cast("string").alias("keyword"), F.col("click_category_id").alias("category")),
    )
    pairs = (
        actions.select("session_id", F.explode(values).alias("v")).select("session_id", "v.*")
        .where("keyword is not null or category is not null").distinct()
    )
    lists = pairs.groupBy(F.col("session_id").alias("_id")).agg(
        F.collect_list("keyword").alias("_keywords"), F.collect_list("category").alias("_categories"))
    return sessions.join(lists, F.col("session_id").eqNullSafe(F.col("_id")), "left").select(
        "session_id", "user_id", "start_time", "end_time", "step_length", "visit_length",
        sorted_text(F.col("_keywords")).alias("search_keywords"),
        non_empty(F.array_join(F.array_sort("_categories").cast("array<string>"), ",")).alias("click_category_ids"),
    )
