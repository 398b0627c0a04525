from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.rows import action, actions, executed, users, values
from visitlens.operators.bounds import reshuffled
from visitlens.operators.rollup import roll_up
from visitlens.operators.skew import balanced_join_users, heavy_keys, keys_above, salted_count, salted_join_users, split_join_users
from visitlens.operators.users import join_users


@pytest.fixture(scope="module")
def world(spark):
    """User 7 owns a third of the sessions, two sessions have no user, one user id is null."""
    rows = [action(f"hot{i}", user=7) for i in range(200)]
    rows += [action(f"s{i}", user=i % 40 + 10) for i in range(400)]
    rows += [action("lost1", user=999), action("lost2", user=998), action("none", user=None)]
    return actions(spark, rows), users(spark, [(i, i, "p", "c", "male") for i in range(0, 60)])


def test_heavy_keys(spark, world):
    sessions = roll_up(world[0])
    assert values(heavy_keys(sessions, "user_id", "session_id", n=1, share=1.0)) == [(7, 200)]
    assert heavy_keys(sessions, "user_id", "session_id", n=1).first().user_id == 7
    assert values(heavy_keys(sessions, "user_id", "session_id", n=3, share=1.0), "user_id") == [(10,), (11,), (7,)]


@pytest.mark.parametrize("join", [salted_join_users, split_join_users])
@pytest.mark.parametrize("hot, share", [(1, 0.1), (5, 1.0), (1, 0.0)])
def test_salted_and_split_joins_equal_the_plain_one(spark, conf, world, join, hot, share):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    acts, people = world
    sessions = roll_up(acts)
    plain = join_users(sessions, people)
    got = join(sessions, people, hot=hot, salts=8, share=share)
    columns = ["session_id", "user_id", "age", "step_length"]
    assert sorted(got.columns) == sorted(plain.columns)
    assert values(got, *columns) == values(plain, *columns)
    assert plain.count() == 600


def test_salted_join_spreads_the_heavy_user(spark, conf, world):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    acts, people = world
    plan = executed(salted_join_users(roll_up(acts), people, salts=8))
    assert "hashpartitioning(user_id" in plan and "_salt" in plan


def test_salted_count(spark):
    df = actions(spark, [action(f"s{i}", click=i % 3) for i in range(100)] + [action("x")])
    assert values(salted_count(df, "click_category_id", "session_id")) == [(0, 34), (1, 33), (2, 33)]


def test_skewed_partitions_are_split_even_under_an_aggregate(spark, conf, tmp_path):
    """One session with most rows, joined on session_id and then grouped by it."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "40KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    conf("spark.sql.files.maxPartitionBytes", "200KB")
    left = spark.range(60000, numPartitions=8).selectExpr(
        "if(id % 3 > 0, 'hot', concat('s', id)) as session_id", "md5(cast(id as string)) as payload")
    right = left.select("session_id").distinct()
    counted = left.join(reshuffled(right), "session_id").groupBy("session_id").agg(F.max("payload"), F.count("*").alias("n"))
    assert "skew=true" in executed(counted)
    assert values(counted.where("n > 1"), "session_id", "n") == [("hot", 40000)]


def brute_heavy(keys, parts):
    counts = Counter(k for k in keys if k is not None)
    total = sum(counts.values())
    return sorted((k, n, -(-n * parts // total)) for k, n in counts.items() if n * parts > total)


@pytest.mark.parametrize("parts", [1, 3, 8, 20])
def test_heavy_keys_are_exact_on_adversarial_rows(spark, parts):
    """Keys just above and just below the bound, among light ones that come first, last and between."""
    light = [1_000_000 + i for i in range(6000)]
    bound = 10_000 // parts
    cases = [
        [*light, *[7] * (bound + 200), *[8] * (bound - 200)],
        [x for i, key in enumerate(light) for x in ((key, 7, i % 5) if i % 2 else (key,))],
        [*[k for k in range(20) for _ in range(500)], None, None],
        [k for k in range(100) for _ in range(k * k // 10)],
        light, [5] * 100, [None], [],
    ]
    for keys in cases:
        df = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(5)
        assert values(keys_above(df, "k", parts)) == brute_heavy(keys, parts)
    words = spark.createDataFrame([(f"w{k % 7 if k % 2 else k}",) for k in range(5000)], "k string")
    assert values(keys_above(words, "k", parts)) == brute_heavy([r.k for r in words.collect()], parts)


@pytest.mark.parametrize("parts", [1, 4, 200])
def test_balanced_join_equals_the_plain_one(spark, conf, world, parts):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    acts, people = world
    sessions = roll_up(acts)
    plain, got = join_users(sessions, people), balanced_join_users(sessions, people, parts)
    assert sorted(got.columns) == sorted(plain.columns)
    assert values(got, *sorted(got.columns)) == values(plain, *sorted(plain.columns))


def test_salts_follow_the_rows(spark):
    df = spark.range(6000).selectExpr("case when id % 2 = 0 then 1 when id % 6 = 1 then 2 else id end as k", "id as session")
    found = {r.k: (r.row_count, r.salts) for r in keys_above(df, "k", 60).collect()}
    assert found == {1: (3000, 30), 2: (1000, 10)}


def test_joins_of_stored_sessions_scan_the_events_no_more(spark):
    """The sessions are rolled up once: what is left in the plan reads the stored table and the users."""
    from checks.queries import QUERIES

    for name in ("salted_user_join", "split_user_join", "balanced_user_join"):
        df = QUERIES[name](spark, "/root/testdata/sf0.001")
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "event_type" not in plan and df.count() > 0
