"""Sessions joined with their users."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

USER_ATTRIBUTES = ["age", "professional", "city", "sex"]

# What a broadcast may hold, measured on the data before it is used.
BROADCAST_BYTES = 256 * 1024 * 1024


def attributes(users: DataFrame) -> DataFrame:
    return users.select("user_id", *USER_ATTRIBUTES)


def join_users(sessions: DataFrame, users: DataFrame, how: str = "inner", more: Sequence[str] = ()) -> DataFrame:
    """Inner: sessions without a user and users without a session vanish. Left: sessions stay.

    No hint: Spark broadcasts a small user table, and splits skewed users of a large one.
    """
    return sessions.join(users.select("user_id", *USER_ATTRIBUTES, *more), "user_id", how)


def measured_bytes(df: DataFrame) -> int:
    """Bytes the rows need: 8 per fixed-width value, 8 plus the content per text value, plus an
    allowance of 32 per row. One aggregation over the needed columns, nothing collected but a number."""
    widths = [
        F.coalesce(F.octet_length(name), F.lit(0)) + 8 if kind == "string" else F.lit(8)
        for name, kind in df.dtypes
    ]
    row_bytes = sum(widths, F.lit(32))
    return df.agg(F.coalesce(F.sum(row_bytes.cast("bigint")), F.lit(0))).first()[0]


def broadcast_join_users(sessions: DataFrame, users: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Map-side join: the users travel to the sessions, which are not shuffled again.

    Only if the users measure at most ``max_bytes``; beyond that it is the plain join.
    """
    small = attributes(users)
    if measured_bytes(small) <= max_bytes:
        small = F.broadcast(small)
    return sessions.join(small, "user_id")
