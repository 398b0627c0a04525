"""The index of tasks and the dyadic day blocks against plain Python; many tasks against each alone."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.rows import action, actions, users, values
from visitlens.operators.day_blocks import levels, merged
from visitlens.operators.task_index import TaskIndex, bitmap, has, numbers_in, steps
from visitlens.plans.many import ManyTasksPlan
from visitlens.plans.single import TaskPlan
from visitlens.sources.tasks import Task


def made_tasks(rng, count):
    first = date(2024, 1, 1)
    tasks = []
    for i in range(count):
        a, b = (first + timedelta(rng.randrange(-3, 40)) for _ in range(2))
        maybe = lambda value: value if rng.random() < 0.5 else None
        tasks.append(Task(
            100 + i, maybe(min(a, b)), maybe(max(a, b)), rng.choice([None, 18, 30]), rng.choice([None, 25, 60]),
            maybe(tuple(rng.sample("pqr", 2))), maybe(rng.choice([("x",), ("x", "y"), ()])), maybe(rng.choice(["male", "female"])),
            maybe(rng.choice([("tea",), ("hotpot", "tea"), ()])), maybe(rng.choice([(7,), (-1, 5), tuple(range(70))]))))
    return tasks


def fits(task, person):
    _, age, job, city, sex = person
    return (
        (task.ages is None or age is not None and task.ages[0] <= age <= task.ages[1])
        and (task.professionals is None or job in task.professionals) and (task.cities is None or city in task.cities)
        and (task.sex is None or sex == task.sex))


PEOPLE = [(1, 17, "p", "x", "male"), (2, 18, "q", "y", "female"), (3, 25, "p", "y", "male"), (4, 26, None, None, None),
          (5, None, "r", "z", "male"), (6, 60, "q", "x", "other"), (7, 61, "s", "x", "female")]


@pytest.mark.parametrize("count", [1, 63, 64, 65, 200])
def test_users_have_the_tasks_they_fit(spark, count):
    tasks = made_tasks(random.Random(count), count)
    index = TaskIndex(spark, tasks)
    got = {r["user_id"]: r["numbers"] for r in index.of_users(users(spark, PEOPLE)).select("user_id", numbers_in(F.col("tasks")).alias("numbers")).collect()}
    assert got == {p[0]: [i for i, t in enumerate(tasks) if fits(t, p)] for p in PEOPLE}


@pytest.mark.parametrize("listed", [True, False])
def test_days_have_the_tasks_that_hold_them(spark, monkeypatch, listed):
    if not listed:
        monkeypatch.setattr("visitlens.operators.task_index.LISTED_DAYS", 0)
    tasks = made_tasks(random.Random(9), 80) + [Task(1, date(2024, 1, 5), date(2024, 1, 4)), Task(2, date(2024, 1, 9), date.max)]
    days = [date(2023, 12, 1) + timedelta(i) for i in range(90)] + [date(1, 1, 1), date(9999, 12, 31)]
    rows = spark.createDataFrame([(d,) for d in days], "date date")
    found = TaskIndex(spark, tasks).of_days(rows, "held").select("date", numbers_in(F.col("held")).alias("n")).collect()
    inside = lambda t, d: (t.start_date is None or t.start_date <= d) and (t.end_date is None or d <= t.end_date)
    assert {r["date"]: r["n"] for r in found} == {d: [i for i, t in enumerate(tasks) if inside(t, d)] for d in days}


def test_bits():
    assert bitmap([], 1) == [0] and bitmap([0, 63], 64) == [1 - 2**63] and bitmap([64], 65) == [0, 1]
    assert steps([(None, None), (3, 5), (None, 3), (5, 5), (7, 6)]) == ([3, 5, 6, 7], [[0, 2], [0, 1], [0], [0], [0]])


def test_has(spark):
    row = spark.range(1).select(F.array(F.lit(5).cast("bigint"), F.lit(-2**63).cast("bigint")).alias("w"))
    got = row.select(*[has(F.col("w"), F.lit(n)).alias(f"n{n}") for n in (0, 1, 2, 63, 64, 127, 128)]).first()
    assert list(got) == [True, False, True, False, False, True, False]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 8, 9, 30])
def test_ranges_of_days_are_merged_from_few_blocks(spark, size):
    """Words show order, and how many merges a range takes: at most one for each level."""
    def merge(x, y):
        return F.struct(F.concat(x["w"], y["w"]).alias("w"), (x["n"] + F.lit(1)).alias("n"))

    days = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.struct(F.format_string("%02d", i).alias("w"), F.lit(0).alias("n")))
    ranges = [(a, b) for a in range(size) for b in range(a + 1, size + 1)]
    rows = spark.createDataFrame(ranges, "a int, b int").withColumn("blocks", levels(days, merge))
    nothing = F.struct(F.lit("").alias("w"), F.lit(0).alias("n"))
    for row in rows.select("a", "b", merged(F.col("blocks"), F.col("a"), F.col("b") - F.col("a"), merge, nothing).alias("m"), F.size("blocks").alias("levels")).collect():
        assert row["m"]["w"] == "".join(f"{i:02d}" for i in range(row["a"], row["b"]))
        assert row["m"]["n"] <= row["levels"] == size.bit_length()


def test_sessions_of_many_days_and_users_equal_each_task_alone(spark):
    """Sessions over 30 days, of which some have several users, some of them unknown."""
    rng = random.Random(4)
    rows = []
    for session in ["s1", "s2", "s3", "s4", None]:
        people = rng.sample([1, 2, 3, 4, 5, 6, 7, 99], rng.choice([1, 1, 2, 3]))
        for day in range(30):
            for _ in range(rng.randrange(3)):
                at = (date(2024, 1, 1) + timedelta(day)).isoformat() + f" {rng.randrange(10, 24)}:00:{rng.randrange(10, 60)}"
                rows.append(action(session, at, rng.choice(people), keyword=rng.choice([None, "tea", "hotpot", "x"]), click=rng.choice([None, 5, 7, 69])))
    stream, people = actions(spark, rows).cache(), users(spark, PEOPLE).cache()
    tasks = made_tasks(random.Random(11), 70)[:12]
    tasks += [Task(900 + i, date(2024, 1, 1 + i), date(2024, 1, 5 + 2 * i), sex=(None, "male")[i % 2]) for i in range(10)]
    many = ManyTasksPlan(spark, stream, people, tasks)
    got = values(many.sessions, "task_id", "session_id", "user_id", "start_time", "step_length", "visit_length")
    counts = values(many.per_session, "task_id", "session_id", "category_id", "click_count")
    want, want_counts = [], []
    for task in tasks:
        alone = TaskPlan(stream, people, task)
        want += [(task.task_id, *r) for r in values(alone.sessions, "session_id", "user_id", "start_time", "step_length", "visit_length")]
        want_counts += [(task.task_id, *r) for r in values(alone.per_session, "session_id", "category_id", "click_count")]
    assert got == sorted(want, key=repr) and len({r[0] for r in got}) > 5
    assert counts == sorted(want_counts, key=repr)


def test_only_tasks_with_empty_lists(spark):
    stream = actions(spark, [action("a", keyword="tea", click=1)])
    plan = ManyTasksPlan(spark, stream, users(spark, PEOPLE), [Task(1, keywords=()), Task(2, category_ids=()), Task(3)])
    assert values(plan.sessions, "task_id", "session_id") == [(3, "a")]
