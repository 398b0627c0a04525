"""Visit-length and step-length distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.functions.buckets import bucket_counts
from visitlens.functions.ratios import share
from visitlens.schemas import STEP_BUCKETS, VISIT_BUCKETS


def visit_length_hist(sessions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return sessions.groupBy(*by).agg(*bucket_counts("visit_length", VISIT_BUCKETS))


def step_length_hist(sessions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return sessions.groupBy(*by).agg(*bucket_counts("step_length", STEP_BUCKETS))


def session_shares(sessions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """session_count and the fifteen ratios, in one aggregation.

    Without ``by`` always one row: no sessions give count 0 and null ratios.
    """
    counted = sessions.groupBy(*by).agg(
        F.count(F.lit(1)).alias("session_count"),
        *bucket_counts("visit_length", VISIT_BUCKETS),
        *bucket_counts("step_length", STEP_BUCKETS),
    )
    ratios = [
        share(name, "session_count").alias(f"{name}_ratio")
        for name, _, _ in VISIT_BUCKETS + STEP_BUCKETS
    ]
    return counted.select(*by, "session_count", *ratios)
