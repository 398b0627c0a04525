"""Explicit skew handling: finding heavy keys, salted counts, salted and split joins.

Adaptive execution already splits skewed join partitions, and partial aggregation already flattens
skewed counts. These are for plans where it cannot help, such as one heavy key in a partition below
its size threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.operators.bounds import broadcast_if
from visitlens.operators.ranking import first_rows
from visitlens.operators.users import attributes

# Salts of a join, salts of a count, share of rows the probe reads.
JOIN_SALTS = 100
COUNT_SALTS = 10
PROBE_SHARE = 0.1
HOT_PARTS = 200  # a key is heavy from one such part of all rows on


def salt_of(column: Column, salts: int) -> Column:
    """A salt from the row itself: a retried task gives every row the same one again."""
    return F.pmod(F.xxhash64(column), F.lit(salts)).cast("int")


def heavy_keys(df: DataFrame, key: str, row_id: str, n: int = 1, share: float = PROBE_SHARE) -> DataFrame:
    """The ``n`` keys with most rows, by counting a share of the rows (all of them for 1.0).

    Rows are chosen by a hash of ``row_id``, not at random, so every evaluation finds the same keys.
    Null keys join nothing and are left out.
    """
    probe = df.where(F.col(key).isNotNull())
    if share < 1.0:
        probe = probe.where(salt_of(F.col(row_id), 1000) < int(share * 1000))
    counts = probe.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    return first_rows(counts, [F.desc("row_count"), F.asc(key)], n)


def keys_above(df: DataFrame, key: str, parts: int = HOT_PARTS) -> DataFrame:
    """The keys that hold more than one in ``parts`` rows, their rows, and ``salts`` that leave each salt no more.

    Exact, and no more than ``parts`` keys. A mergeable sketch of frequent items goes over the rows
    once, kept per task and merged; only its candidates are counted again. It tracks eight times
    ``parts`` items, with which its error stays below a third of such a part, so no heavy key is
    missing among them. Rows with a null key are no part of this. No key is shuffled for its rows.
    """
    tracked = 8 * parts
    rows = df.where(F.col(key).isNotNull())
    items = F.call_function("approx_top_k", F.col(key), F.lit(tracked), F.lit(tracked))
    seen = rows.agg(items.alias("items"), F.count(F.lit(1)).alias("all_rows"))
    candidates = seen.select("all_rows", F.explode("items").alias("i")).select(F.col("i.item").alias(key), "all_rows")
    counts = (
        rows.select(key).join(broadcast_if(candidates, tracked), key)
        .groupBy(key).agg(F.count(F.lit(1)).alias("row_count"), F.first("all_rows").alias("all_rows"))
    )
    return counts.where(F.col("row_count") * parts > F.col("all_rows")).select(
        key, "row_count", F.ceil(F.col("row_count") * parts / F.col("all_rows")).cast("int").alias("salts"))


def salted_count(df: DataFrame, key: str, salt_by: str, salts: int = COUNT_SALTS) -> DataFrame:
    """Rows per key in two rounds: per (key, salt), then per key."""
    first = (
        df.where(F.col(key).isNotNull())
        .groupBy(key, salt_of(F.col(salt_by), salts).alias("salt"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return first.groupBy(key).agg(F.sum("n").alias("row_count"))


def salted_join_users(
    sessions: DataFrame, users: DataFrame, hot: int = 1, salts: int = JOIN_SALTS, share: float = PROBE_SHARE
) -> DataFrame:
    """Inner join with users on (user, salt), where only heavy users are salted.

    Sessions of a heavy user spread over ``salts`` reducers and that user's row is copied there;
    everybody else has salt 0 and one copy. The heavy users are at most ``hot`` rows.
    """
    heavy = heavy_keys(sessions, "user_id", "session_id", hot, share)
    keys = broadcast_if(heavy.select("user_id", F.lit(True).alias("_hot")), hot)
    spread = F.when(F.col("_hot"), salt_of(F.col("session_id"), salts)).otherwise(0)
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    left = sessions.join(keys, "user_id", "left").withColumn("_salt", spread).drop("_hot")
    right = (
        attributes(users).join(keys, "user_id", "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    )
    return left.join(right, ["user_id", "_salt"]).drop("_salt")


def balanced_join_users(sessions: DataFrame, users: DataFrame, parts: int = HOT_PARTS) -> DataFrame:
    """Inner join with users on (user, salt), with salts in proportion to the sessions of each heavy user.

    Of any user, one reducer gets about one in ``parts`` of the sessions. A heavy user's row is copied once
    a salt; all copies together are at most twice ``parts``. Reads the sessions three times: store them.
    """
    heavy = keys_above(sessions, "user_id", parts)
    keys = broadcast_if(heavy.select("user_id", F.col("salts").alias("_salts")), parts)
    spread = F.pmod(F.xxhash64("session_id"), F.coalesce("_salts", F.lit(1))).cast("int")
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    left = sessions.join(keys, "user_id", "left").withColumn("_salt", spread).drop("_salts")
    right = attributes(users).join(keys, "user_id", "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    return left.join(right, ["user_id", "_salt"]).drop("_salt")


def split_join_users(
    sessions: DataFrame, users: DataFrame, hot: int = 1, salts: int = JOIN_SALTS, share: float = PROBE_SHARE
) -> DataFrame:
    """The same join as two halves: heavy users salted, all others plain, then a union.

    For sessions already stored or persisted: each half reads them once.
    """
    keys = broadcast_if(heavy_keys(sessions, "user_id", "session_id", hot, share).select("user_id"), hot)
    people = attributes(users)
    heavy = sessions.join(keys, "user_id", "left_semi").withColumn("_salt", salt_of(F.col("session_id"), salts))
    heavy_people = people.join(keys, "user_id", "left_semi").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    rest = sessions.join(keys, "user_id", "left_anti")
    return (
        heavy.join(heavy_people, ["user_id", "_salt"]).drop("_salt")
        .unionByName(rest.join(people, "user_id"))
    )
