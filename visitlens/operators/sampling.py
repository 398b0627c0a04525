"""A repeatable random sample of sessions in proportion to hourly traffic.

Sessions draw a ticket, md5 of seed and id; in each hour the lowest tickets win. Finding the lowest
k of a group normally means sorting the group in one task. Here the tickets' first hex digits are
counted per hour first (small, combined map-side), which tells exactly how far down each hour's
winners reach; only sessions above that mark are shuffled and ranked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlens.functions.times import day_hour
from visitlens.operators.bounds import broadcast_if

# Fixed value: sessions to sample per task unless asked otherwise.
DEFAULT_TOTAL = 100
DEFAULT_SEED = 42

# Leading hex digits counted per hour: 16**3 = 4096 bands.
BAND_DIGITS = 3


def _by_hour(sessions: DataFrame) -> DataFrame:
    """Sessions with the hour of their start; those without a readable time have none."""
    return sessions.withColumn("day_hour", day_hour(F.col("start_time"))).where("day_hour is not null")


def hour_counts(sessions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sessions per hour of their start, keyed ``yyyy-MM-dd_HH``."""
    return (
        _by_hour(sessions)
        .groupBy(*by, "day_hour")
        .agg(F.count(F.lit(1)).alias("session_count"))
    )


def hour_quotas(hours: DataFrame, total: int = DEFAULT_TOTAL, by: Sequence[str] = ()) -> DataFrame:
    """How many sessions each hour gives: every day gets ``total div days``, every hour its share of
    that, truncated and never more than it has.

    Works on at most 24 rows per day, whatever the number of sessions.
    """
    with_day = hours.withColumn("day", F.substring("day_hour", 1, 10))
    of_day = Window.partitionBy(*by, "day")
    is_first = (F.col("day_hour") == F.min("day_hour").over(of_day)).cast("bigint")
    counted = with_day.withColumn("day_count", F.sum("session_count").over(of_day)).withColumn("_first", is_first)
    days = F.sum("_first").over(Window.partitionBy(*by))
    day_quota = (F.lit(total) - F.pmod(F.lit(total), days)) / days
    share = F.col("session_count").cast("double") / F.col("day_count").cast("double")
    return counted.withColumn("day_quota", day_quota.cast("bigint")).select(
        *by, "day_hour", "session_count", "day_count", "day_quota",
        F.least((share * F.col("day_quota")).cast("bigint"), F.col("session_count")).alias("hour_quota"),
    )


def ticket(seed: int) -> Column:
    """A missing id draws like the empty one."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce("session_id", F.lit(""))).cast("binary"))


def sample_sessions(
    sessions: DataFrame, total: int = DEFAULT_TOTAL, seed: int = DEFAULT_SEED,
    by: Sequence[str] = (), groups: int = 1,
) -> DataFrame:
    """The winners: session_id, start_time, day_hour. At most ``total`` for each of the ``groups``
    values of ``by``."""
    hour = [*by, "day_hour"]
    tickets = (
        _by_hour(sessions)
        .select(*by, "session_id", "start_time", "day_hour", ticket(seed).alias("ticket"))
        .withColumn("band", F.conv(F.substring("ticket", 1, BAND_DIGITS), 16, 10).cast("int"))
    )

    bands = tickets.groupBy(*hour, "band").agg(F.count(F.lit(1)).alias("n"))
    hours = bands.groupBy(*hour).agg(F.sum("n").alias("session_count"))
    quotas = hour_quotas(hours, total, by).where("hour_quota > 0").select(*hour, "hour_quota")
    # Every hour in ``quotas`` gives at least one session, so there are at most ``total`` of them.
    # ``marks`` has the same hours.
    most = total * groups
    up_to_band = F.sum("n").over(Window.partitionBy(*hour).orderBy("band"))
    marks = (
        bands.withColumn("reached", up_to_band)
        .join(broadcast_if(quotas, most), hour)
        .where("reached >= hour_quota")
        .groupBy(*hour)
        .agg(F.min("band").alias("last_band"), F.min("hour_quota").alias("hour_quota"))
    )
    place = F.row_number().over(Window.partitionBy(*hour).orderBy("ticket", "session_id"))
    return (
        tickets.join(broadcast_if(marks, most), hour)
        .where("band <= last_band")
        .withColumn("place", place)
        .where("place <= hour_quota")
        .select(*by, "session_id", "start_time", "day_hour")
    )
