"""Action rows of chosen sessions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.functions.times import format_time
from visitlens.operators.bounds import broadcast_if, reshuffled
from visitlens.schemas import DETAIL_COLUMNS


def actions_of(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """Actions of the given sessions, each once. For any number of sessions of any size."""
    return actions.join(reshuffled(sessions.select("session_id")), "session_id", "left_semi")


def as_details(rows: DataFrame, tags: Sequence[str] = ()) -> DataFrame:
    """The columns of ``session_detail``; rows must carry ``task_id``."""
    return rows.withColumn("action_time", format_time(F.col("action_time"))).select(*DETAIL_COLUMNS, *tags)


def details_of(actions: DataFrame, chosen: DataFrame, at_most: int, tags: Sequence[str] = ()) -> DataFrame:
    """Detail rows of a *bounded* choice of sessions, once per row of ``chosen``.

    ``chosen`` (task_id, session_id, tags) is a sample or a ranking: its size is set by the sample
    total and by N, not by the data. So it is broadcast, and the actions are filtered where they are
    read, without a shuffle, however large a chosen session is.
    """
    chosen = broadcast_if(chosen.select("task_id", "session_id", *tags), at_most)
    return as_details(actions.join(chosen, "session_id"), tags)
