"""Clicks, orders and payments per category, and who clicked most.

Everything starts from counts per (session, category): small integers that combine map-side, after
which the session filter and all rankings work on far fewer rows than there are actions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.functions.lists import split_ids, to_id
from visitlens.operators.bounds import broadcast_if
from visitlens.operators.ranking import first_rows

# Fixed value: how many categories and how many sessions per category are reported.
TOP_N = 10

COUNTS = ["click_count", "order_count", "pay_count"]
_PAYLOAD = ["click_category_id", "order_category_ids", "pay_category_ids"]


def category_events(actions: DataFrame, keys: Sequence[str] = ("session_id",)) -> DataFrame:
    """One row per category touched by an action: keys, category_id, kind.

    A single scan for all three kinds. Every occurrence in an id list is a row; what is not a
    number is skipped.
    """
    touched = actions.where(" or ".join(f"{name} is not null" for name in _PAYLOAD))
    return (
        touched.select(
            *keys,
            F.stack(
                F.lit(3),
                F.lit("click"), F.col("click_category_id").cast("string"),
                F.lit("order"), F.col("order_category_ids"),
                F.lit("pay"), F.col("pay_category_ids"),
            ).alias("kind", "ids"),
        )
        .where("ids is not null")
        .select(*keys, "kind", F.explode(split_ids(F.col("ids"))).alias("item"))
        .select(*keys, "kind", to_id(F.col("item")).alias("category_id"))
        .where("category_id is not null")
    )


def session_categories(actions: DataFrame, keys: Sequence[str] = ("session_id",)) -> DataFrame:
    """Counts per (session, category)."""
    kind = F.col("kind")
    return (
        category_events(actions, keys)
        .groupBy(*keys, "category_id")
        .agg(
            F.count_if(kind == "click").alias("click_count"),
            F.count_if(kind == "order").alias("order_count"),
            F.count_if(kind == "pay").alias("pay_count"),
        )
    )


def only_sessions(rows: DataFrame, sessions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows whose session is among ``sessions``."""
    keys = [*by, "session_id"]
    return rows.join(sessions.select(*keys), keys, "left_semi")


def session_counts_of_kind(actions: DataFrame, kind: str) -> DataFrame:
    """Counts per (session, category) of one kind only, from that kind's column only."""
    column = {"click": "click_category_id", "order": "order_category_ids", "pay": "pay_category_ids"}[kind]
    present = actions.where(F.col(column).isNotNull())
    if kind == "click":
        events = present.select("session_id", F.col(column).alias("category_id"))
    else:
        events = (
            present.select("session_id", F.explode(split_ids(F.col(column))).alias("item"))
            .select("session_id", to_id(F.col("item")).alias("category_id"))
            .where("category_id is not null")
        )
    return events.groupBy("session_id", "category_id").agg(F.count(F.lit(1)).alias(f"{kind}_count"))


def category_count(actions: DataFrame, sessions: DataFrame, kind: str) -> DataFrame:
    """Clicks, orders or payments per category of the given sessions."""
    name = f"{kind}_count"
    per_session = only_sessions(session_counts_of_kind(actions, kind), sessions)
    return per_session.groupBy("category_id").agg(F.sum(name).alias(name))


def category_totals(per_session: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts per category. All three at once: every category seen in any kind has a row, and a
    kind it never had is 0, without one join."""
    return per_session.groupBy(*by, "category_id").agg(*[F.sum(c).alias(c) for c in COUNTS])


def distinct_categories(per_session: DataFrame) -> DataFrame:
    return per_session.select("category_id").distinct()


def top_categories(totals: DataFrame, n: int = TOP_N, by: Sequence[str] = ()) -> DataFrame:
    """By clicks, then orders, then payments, descending; equal ones by id."""
    order = [F.desc(c) for c in COUNTS] + [F.asc("category_id")]
    return first_rows(totals, order, n, by)


def clicks_in_top(
    per_session: DataFrame, top: DataFrame, n: int = TOP_N, by: Sequence[str] = (), groups: int = 1
) -> DataFrame:
    """Clicks per (category, session) for the top categories, of which there are at most ``n`` for
    each of the ``groups`` values of ``by``."""
    keys = [*by, "category_id"]
    return (
        per_session.where("click_count > 0")
        .join(broadcast_if(top.select(*keys), n * groups), keys, "left_semi")
        .select(*by, "category_id", "session_id", "click_count")
    )


def top_sessions(clicks: DataFrame, n: int = TOP_N, by: Sequence[str] = ()) -> DataFrame:
    """The N sessions with most clicks in each category; equal ones by session id."""
    return first_rows(clicks, [F.desc("click_count"), F.asc("session_id")], n, [*by, "category_id"])
