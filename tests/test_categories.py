import random
from collections import Counter

import pytest

from tests.rows import action, actions, values
from visitlens.operators.categories import (
    category_count, category_totals, clicks_in_top, distinct_categories, only_sessions, session_categories,
    top_categories, top_sessions,
)


def test_every_occurrence_counts_and_bad_ids_are_skipped(spark):
    df = actions(spark, [
        action("a", order="3,3"), action("a", order="3,"), action("a", order=""), action("b", order="x,4"),
        action("b", pay="4"), action("b", click=5), action("c", click=5),
    ])
    totals = category_totals(session_categories(df))
    assert values(totals) == [(3, 0, 3, 0), (4, 0, 1, 1), (5, 2, 0, 0)]
    assert values(distinct_categories(session_categories(df))) == [(3,), (4,), (5,)]
    everyone = df.select("session_id").distinct()
    assert values(category_count(df, everyone, "order")) == [(3, 3), (4, 1)]
    assert values(category_count(df, everyone, "click")) == [(5, 2)]
    assert values(category_count(df, everyone, "pay")) == [(4, 1)]


def test_only_filtered_sessions_count(spark):
    df = actions(spark, [action("a", click=1), action("b", click=1), action("b", click=2)])
    some = spark.createDataFrame([("b",)], "session_id string")
    assert values(category_totals(only_sessions(session_categories(df), some))) == [(1, 1, 0, 0), (2, 1, 0, 0)]


def test_three_key_order_and_ties(spark):
    totals = spark.createDataFrame(
        [(1, 5, 1, 1), (2, 5, 2, 0), (3, 6, 0, 0), (4, 5, 1, 2), (9, 5, 1, 1), (5, 0, 9, 9)],
        "category_id bigint, click_count bigint, order_count bigint, pay_count bigint")
    assert [r.category_id for r in top_categories(totals, 5).collect()] == [3, 2, 4, 1, 9]


@pytest.mark.parametrize("seed", [1, 2])
def test_top_sessions_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    # one session holds a third of all clicks
    rows = [action("hot" if rng.random() < 1 / 3 else f"s{rng.randrange(60)}", click=min(rng.randrange(40), rng.randrange(40)))
            for _ in range(3000)]
    per_session = session_categories(actions(spark, rows))
    top = top_categories(category_totals(per_session))
    got = top_sessions(clicks_in_top(per_session, top))

    clicks = Counter(r[6] for r in rows)
    best = sorted(clicks, key=lambda c: (-clicks[c], c))[:10]
    expected = []
    for c in best:
        per = Counter(r[2] for r in rows if r[6] == c)
        expected += [(c, s, per[s]) for s in sorted(per, key=lambda s: (-per[s], s))[:10]]
    assert values(got, "category_id", "session_id", "click_count") == sorted(expected, key=repr)
