"""What a join may rely on: broadcast sides that are known to be small, and splittable skew."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a few narrow columns; a million of them are some 100 MB at most.
BROADCAST_ROWS = 1_000_000


def broadcast_if(df: DataFrame, at_most: int) -> DataFrame:
    """Broadcast ``df``, which provably has no more than ``at_most`` rows, if that is few enough.

    Otherwise it stays as it is, and the join shuffles like any other.
    """
    return F.broadcast(df) if at_most <= BROADCAST_ROWS else df


def reshuffled(df: DataFrame) -> DataFrame:
    """The same rows, to be shuffled by the join that reads them.

    An aggregate grouped by the join key feeds the join as it is, and adaptive execution splits a
    skewed partition only where *both* sides come straight from a shuffle. A coalesce to more
    partitions than there are moves nothing but drops the known partitioning. Costs a shuffle of
    this side, so it is for the side with one row per key.
    """
    return df.coalesce(2**30)
