"""Partial roll-ups of 1, 2, 4, ... consecutive days of a session, from which any range of days is merged.

A session's days are an array in order of their dates. Level n has, for every day, the merger of the
2^n days from there on. A range of k days is the merger of at most one block a level, those of the bits of
k, whatever the number of days; the blocks are made once for all tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Merge = Callable[[Column, Column], Column]


def levels(days: Column, merge: Merge) -> Column:
    """Arrays of merged days, by level."""
    # The greatest level has a block of all days or of more than half of them.
    top = F.length(F.bin(F.size(days))) - 1

    def double(made: Column, level: Column) -> Column:
        last = F.element_at(made, -1)
        half = F.call_function("shiftleft", F.lit(1), level - 1)
        merged = F.transform(F.slice(last, F.lit(1), F.size(last) - half), lambda block, at: merge(block, F.get(last, at + half)))
        return F.concat(made, F.array(merged))

    return F.when(F.size(days) > 1, F.aggregate(F.sequence(F.lit(1), top), F.array(days), double)).otherwise(F.array(days))


def merged(blocks: Column, first: Column, count: Column, merge: Merge, nothing: Column) -> Column:
    """The merger of ``count`` days from place ``first``; ``nothing`` is a block that changes no other."""
    def add(done: Column, level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1), level)
        block = F.get(F.get(blocks, level), done["at"])
        return F.when(
            count.bitwiseAND(size) != 0, F.struct((done["at"] + size).alias("at"), merge(done["part"], block).alias("part"))
        ).otherwise(done)

    start = F.struct(first.alias("at"), nothing.alias("part"))
    return F.aggregate(F.sequence(F.lit(0), F.size(blocks) - 1), start, add)["part"]
