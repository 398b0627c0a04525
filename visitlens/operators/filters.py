"""Session filters of a task. Each passes when its parameter is not given; when it is given, a
missing value fails."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.sources.tasks import Task


def age_filter(task: Task) -> Column | None:
    return F.col("age").between(*task.ages) if task.ages is not None else None


def professional_filter(task: Task) -> Column | None:
    return F.col("professional").isin(list(task.professionals)) if task.professionals is not None else None


def city_filter(task: Task) -> Column | None:
    return F.col("city").isin(list(task.cities)) if task.cities is not None else None


def sex_filter(task: Task) -> Column | None:
    return F.col("sex") == task.sex if task.sex is not None else None


def keyword_filter(task: Task) -> Column | None:
    return F.col("keyword_hit") if task.keywords is not None else None


def category_filter(task: Task) -> Column | None:
    return F.col("category_hit") if task.category_ids is not None else None


ALL_FILTERS = (age_filter, professional_filter, city_filter, sex_filter, keyword_filter, category_filter)


def filter_sessions(sessions: DataFrame, task: Task, filters=ALL_FILTERS) -> DataFrame:
    """Sessions that pass every given filter. Catalyst moves the user conditions below the user
    join and the hit flags below it on the session side."""
    given = [condition for make in filters if (condition := make(task)) is not None]
    return sessions.where(reduce(and_, given)) if given else sessions
