"""Shares rounded to two decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def share(part: str, whole: str) -> Column:
    """``part / whole`` of two count columns to two decimals, half up, null when ``whole`` is 0.

    Rounded in integers: floor(100*part/whole + 1/2) = (200*part + whole) div (2*whole). A double
    cannot hold most ties exactly, so rounding the quotient would depend on its last bit.
    """
    return F.expr(f"((200 * {part} + {whole}) div nullif(2 * {whole}, 0)) / 100D")
