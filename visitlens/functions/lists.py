"""Comma lists at rest, arrays in plans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def non_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def split_ids(text: Column) -> Column:
    """``'3,3,x,'`` -> ``['3', '3', 'x', '']``; read each item with :func:`to_id`."""
    return F.split(text, ",")


def to_id(item: Column) -> Column:
    """Text to id, null when it is not a number."""
    return item.try_cast("bigint")


def sorted_text(values: Column) -> Column:
    """Set -> sorted comma list, null when the set is empty."""
    return non_empty(F.array_join(F.array_sort(values), ","))
