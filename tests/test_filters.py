import pytest

from tests.rows import action, actions, users, values
from visitlens.operators.filters import filter_sessions
from visitlens.operators.rollup import roll_up
from visitlens.operators.users import join_users
from visitlens.sources.tasks import Task


@pytest.fixture(scope="module")
def world(spark):
    rows = [
        action("s1", user=1, keyword="tea"), action("s1", user=1, click=7),
        action("s2", user=2, keyword="green tea"), action("s2", user=2, click=70),
        action("s3", user=3), action("s4", user=4, click=7), action("s4", user=4, keyword="hotpot"),
    ]
    people = [(1, 10, "cook", "Rome", "male"), (2, 20, "cook,chef", "Oslo", "female"),
              (3, 30, "smith", "Rome", "female"), (4, None, None, None, None)]
    return actions(spark, rows), users(spark, people)


@pytest.mark.parametrize("params, kept", [
    ({}, "1234"),
    ({"start_age": 10, "end_age": 20}, "12"),
    ({"start_age": 11, "end_age": 29}, "2"),
    ({"start_age": 30}, "1234"),
    ({"end_age": 5}, "1234"),
    ({"professionals": ("cook",)}, "1"),
    ({"professionals": ("cook", "smith")}, "13"),
    ({"professionals": ()}, ""),
    ({"cities": ("Rome",)}, "13"),
    ({"sex": "female"}, "23"),
    ({"keywords": ("tea",)}, "1"),
    ({"keywords": ("tea", "hotpot")}, "14"),
    ({"keywords": ("cake",)}, ""),
    ({"category_ids": (7,)}, "14"),
    ({"category_ids": (70, 8)}, "2"),
    ({"category_ids": ()}, ""),
    ({"cities": ("Rome",), "sex": "female", "start_age": 0, "end_age": 99}, "3"),
    ({"keywords": ("tea",), "category_ids": (7,), "cities": ("Rome",)}, "1"),
])
def test_filters(world, params, kept):
    acts, people = world
    task = Task(1, **params)
    got = filter_sessions(join_users(roll_up(acts, task), people), task)
    assert "".join(s[0][1:] for s in values(got, "session_id")) == kept
