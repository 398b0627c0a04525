"""Counting values per length bucket in one aggregation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket_counts(value: str, buckets) -> list[Column]:
    """One count per bucket of a column; null values fall in none."""
    return [
        F.expr(f"count_if({value} >= {low}" + ("" if high is None else f" and {value} <= {high}") + f") as {name}")
        for name, low, high in buckets
    ]
