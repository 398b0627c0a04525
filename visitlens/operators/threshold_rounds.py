"""The sessions with most clicks in each category, from daily counts of which few are shuffled.

Three rounds over (date, session, category) counts as a store of days holds them:

1. The first N sessions of every day and category, cut in each map task, give partial sums. The Nth best is a
   floor: no session below it can be among the first N.
2. A session on d days that reaches the floor has a day of at least floor / d clicks. So a row of c clicks
   goes on only if its session was on ceil(floor / c) days or more. Whether it was is asked of a broadcast filter
   that holds every chosen session once for each power of two up to its days: a row asks one question. The sums
   of what was sent give a higher floor, and with floor / d for every day not sent the most a pair can have;
   pairs that cannot reach the higher floor end here.
3. All rows of the pairs left are summed; those of other pairs are never shuffled.

Ties at the floor go on, so the result is that of sorting everything. Where the filter would be too large to
broadcast, rows pass it unasked and only the exact joins decide.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlens.operators.bounds import broadcast_if, reshuffled
from visitlens.operators.categories import TOP_N, top_sessions
from visitlens.operators.membership import filter_of, fits, may_be_in

Keep = Callable[[DataFrame, str], DataFrame]

PAIR = ["category_id", "session_id"]


def doublings(days: Column) -> Column:
    """How often 1 must be doubled to reach ``days`` (at least 1): 0 for 1, 1 for 2, 2 for 3 and 4, ..."""
    return F.when(days <= 1, 0).otherwise(F.length(F.bin(days - 1))).cast("int")


class Rounds:
    """``top``: the result; ``floors``, ``candidates`` (kept) and ``last``: what the rounds sent on.

    ``daily``: date, session_id, category_id, click_count above 0, one row each; ``sessions``: the chosen ones,
    session_id and n_days (days in ``daily`` or more), ``n_sessions`` of them; ``categories``: at most
    ``n_categories`` category_ids. Sessions without an id are in no category.
    """

    def __init__(self, daily: DataFrame, sessions: DataFrame, n_sessions: int, categories: DataFrame, keep: Keep,
                 n: int = TOP_N, n_categories: int = TOP_N):
        sessions = sessions.where("session_id is not null")
        wanted = broadcast_if(categories.select("category_id"), n_categories)
        rows = daily.where("session_id is not null").join(wanted, "category_id", "left_semi")
        member = self._asked(sessions, n_sessions, keep)

        local = member(rows, F.lit(0)).withColumn("_rank", F.row_number().over(
            Window.partitionBy("date", "category_id").orderBy(F.desc("click_count"), "session_id"))).where(F.col("_rank") <= n)
        local = local.join(reshuffled(sessions.select("session_id")), "session_id", "left_semi")
        partial = local.groupBy(*PAIR).agg(F.sum("click_count").alias("click_count"))
        best = top_sessions(partial, n)
        floor = F.when(F.count(F.lit(1)) >= n, F.min("click_count")).otherwise(1)
        self.floors = keep(best.groupBy("category_id").agg(floor.alias("floor")), "floors")

        # Categories without any local top have no chosen session at all.
        floored = rows.join(broadcast_if(self.floors, n_categories), "category_id")
        days_needed = F.ceil(F.col("floor") / F.col("click_count"))
        sent = member(floored, doublings(days_needed)).groupBy(*PAIR).agg(
            F.sum("click_count").alias("click_count"), F.count(F.lit(1)).alias("days"))
        sent = keep(sent.join(reshuffled(sessions.select("session_id", "n_days")), "session_id"), "sent")
        higher = top_sessions(sent.select(*PAIR, "click_count"), n).groupBy("category_id").agg(
            F.when(F.count(F.lit(1)) >= n, F.min("click_count")).otherwise(1).alias("higher"))
        self.floors = keep(self.floors.join(higher, "category_id", "left").select(
            "category_id", "floor", F.greatest("floor", "higher").alias("higher")), "higher")

        # What was not sent of a pair is below its session's share of the floor, on each of the other days.
        share = F.ceil(F.col("floor") / F.call_function("shiftleft", F.lit(1).cast("bigint"), doublings(F.col("n_days")))) - 1
        most = F.col("click_count") + (F.col("n_days") - F.col("days")) * share
        self.candidates = keep(sent.join(broadcast_if(self.floors, n_categories), "category_id").where(most >= F.col("higher")).select(*PAIR), "candidates")
        n_candidates = self.candidates.count()

        if fits(n_candidates):
            rows = may_be_in(rows, filter_of(self.candidates, n_candidates, PAIR), n_candidates, PAIR)
        self.last = rows
        totals = rows.groupBy(*PAIR).agg(F.sum("click_count").alias("click_count"))
        # Pairs below the floor came by the filter's error alone.
        totals = totals.join(broadcast_if(self.floors, n_categories), "category_id").where("click_count >= higher").select(*PAIR, "click_count")
        self.top = top_sessions(totals.join(reshuffled(sessions.select("session_id")), "session_id", "left_semi"), n)

    @staticmethod
    def _asked(sessions: DataFrame, n_sessions: int, keep: Keep) -> Callable[[DataFrame, Column], DataFrame]:
        """Lets rows pass whose session is chosen and was on 2^(level - 1) + 1 days or more (level 0: on any)."""
        if not fits(n_sessions):
            return lambda rows, level: rows
        keys = ["session_id", "_level"]
        levels = sessions.select("session_id", F.explode(F.sequence(F.lit(0), doublings(F.col("n_days")))).alias("_level"))
        levels = keep(levels, "levels")
        count = levels.count()
        if not fits(count):
            return lambda rows, level: rows
        blocks = keep(filter_of(levels, count, keys), "filter")
        return lambda rows, level: may_be_in(rows.withColumn("_level", level), blocks, count, keys).drop("_level")
