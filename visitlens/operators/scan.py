"""Actions of a date range."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Only this form of a text date sorts like the day it names.
TEXT_DATE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def readable_date(actions: DataFrame) -> Column:
    """The day of each action; null where ``date`` is missing or, as text, unreadable."""
    if dict(actions.dtypes)["date"] == "string":
        return F.when(F.col("date").rlike(TEXT_DATE), F.col("date").try_cast("date"))
    return F.col("date").cast("date")


def actions_between(actions: DataFrame, start: date | None, end: date | None) -> DataFrame:
    """Both ends inclusive; a missing bound is no bound. Actions without a readable date are in no range.

    The bounds are literals of the column's own type, so a table partitioned by ``date`` is pruned
    and any other columnar table gets the filter pushed down.
    """
    as_text = dict(actions.dtypes)["date"] == "string"

    def bound(day: date):
        return F.lit(day.isoformat()) if as_text else F.lit(day)

    if start is not None:
        actions = actions.where(F.col("date") >= bound(start))
    if end is not None:
        actions = actions.where(F.col("date") <= bound(end))
    return actions.where(readable_date(actions).isNotNull())
