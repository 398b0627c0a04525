"""Connected components of a graph given by its edges, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import Shelf
from visitlens.operators.bounds import reshuffled


def components(edges: DataFrame, shelf: Shelf) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node on an edge (a, b) of two longs.

    Rounds of large-star and small-star: first every node hands its larger neighbours the least node
    it knows, then its smaller ones. Minima are combined before each shuffle, so a node with very
    many neighbours costs one row per task. Rounds end when the edges no longer change.
    """
    def oriented(a: str, b: str) -> list:
        return [F.greatest(a, b).alias("high"), F.least(a, b).alias("low")]

    now = shelf.keep(edges.filter("a <> b").select(*oriented("a", "b")).distinct(), "edges")
    state = None
    while True:
        print_ = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)")).alias("s")).collect()[0]
        if tuple(print_) == state:
            break
        state = tuple(print_)
        both = now.unionByName(now.select(F.col("low").alias("high"), F.col("high").alias("low")))
        least = both.groupBy("high").agg(F.min("low").alias("m")).select("high", F.least("m", "high").alias("m"))
        large = both.filter("low > high").join(reshuffled(least), "high").select(F.col("low").alias("high"), F.col("m").alias("low"))
        large = shelf.keep(large.filter("high <> low").distinct(), "large")
        least = large.groupBy("high").agg(F.min("low").alias("m"))
        small = large.join(reshuffled(least), "high").select(F.explode(F.array(
            F.struct(F.col("low").alias("high"), F.col("m").alias("low")), F.struct(F.col("high"), F.col("m").alias("low")),
        )).alias("e")).select("e.high", "e.low").filter("high <> low").distinct()
        after = shelf.keep(small, "small")
        shelf.drop(now, large)
        now = after
    # Every node now has one edge, to the least node of its component.
    found = now.select(F.col("high").alias("node"), F.col("low").alias("root"))
    return found.unionByName(now.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct())
