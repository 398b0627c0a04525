import pytest

from tests.rows import action, actions, users, values, visit
from visitlens.operators.rollup import roll_up, roll_up_with_lists
from visitlens.operators.users import broadcast_join_users, join_users, measured_bytes
from visitlens.sources.tasks import Task


def test_lengths_and_times(spark):
    df = actions(spark, [
        action("a", "2024-01-01 10:00:05"), action("a", "2024-01-01 9:59:03"), action("a", "2024-01-01 10:00:01"),
        action("b", "2024-01-01 23:59:59"),
    ])
    got = roll_up_with_lists(df).selectExpr("session_id", "cast(start_time as string) s", "cast(end_time as string) e",
                                            "visit_length", "step_length")
    assert values(got) == [
        ("a", "2024-01-01 09:59:03", "2024-01-01 10:00:05", 62, 3),
        ("b", "2024-01-01 23:59:59", "2024-01-01 23:59:59", 0, 1),
    ]


def test_bad_and_missing_times_count_as_steps_only(spark):
    df = actions(spark, [
        action("a", "2024-01-01 10:00:00"), action("a", "soon"), action("a", None), action("a", "2024-01-01 10:00:07"),
        action("b", "never"),
    ])
    assert values(roll_up(df), "session_id", "visit_length", "step_length") == [("a", 7, 4), ("b", None, 1)]


def test_lists_are_true_sets(spark):
    df = actions(spark, [
        action("a", keyword="fish hotpot"), action("a", keyword="hotpot"), action("a", keyword="hotpot"),
        action("a", keyword=""), action("a", keyword="room 7"), action("a", click=7), action("a", click=10),
        action("a", click=7), action("b"),
    ])
    assert values(roll_up_with_lists(df), "session_id", "search_keywords", "click_category_ids") == [
        ("a", "fish hotpot,hotpot,room 7", "7,10"), ("b", None, None),
    ]


def test_two_users_in_one_session_give_the_lower_id(spark):
    df = actions(spark, [action("a", user=9), action("a", user=4)])
    assert values(roll_up(df), "user_id", "step_length") == [(4, 2)]


def test_hit_flags_equal_list_membership(spark):
    df = actions(spark, [
        action("a", keyword="fish hotpot"), action("b", keyword="hotpot"), action("c", click=0), action("d", click=7),
        action("d", keyword="hotpot"), action("e"),
    ])
    task = Task(1, keywords=("hotpot", "tea"), category_ids=(7,))
    assert values(roll_up(df, task), "session_id", "keyword_hit", "category_hit") == [
        ("a", False, False), ("b", True, False), ("c", False, False), ("d", True, True), ("e", False, False),
    ]


@pytest.mark.parametrize("how, expected", [
    ("inner", [("a", 1, 30)]), ("left", [("a", 1, 30), ("b", 2, None)]),
])
def test_user_join(spark, how, expected):
    sessions = roll_up(actions(spark, visit("a", 5, 3, user=1) + visit("b", 5, 3, user=2)))
    people = users(spark, [(1, 30, "p", "c", "male"), (3, 40, "p", "c", "male")])
    assert values(join_users(sessions, people, how), "session_id", "user_id", "age") == expected


@pytest.mark.parametrize("limit, hinted", [(10_000, True), (10, False)])
def test_users_are_broadcast_only_when_measured_small(spark, conf, limit, hinted):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    sessions = roll_up(actions(spark, visit("a", 5, 3, user=1) + visit("b", 5, 3, user=2)))
    people = users(spark, [(1, 30, "p", "c", "male"), (3, 40, "p", "c", "male")])
    joined = broadcast_join_users(sessions, people, limit)
    assert values(joined, "session_id", "age") == [("a", 30)]
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in plan) == hinted


def test_measured_bytes(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None)], "i bigint, s string")
    assert measured_bytes(df) == 2 * 32 + 2 * 8 + (3 + 8) + 8
    assert measured_bytes(df.limit(0)) == 0
