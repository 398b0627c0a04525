import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from visitlens.operators.sampling import hour_counts, hour_quotas, sample_sessions


def brute_force(rows, total, seed):
    """From the definition, group by group."""
    hours = defaultdict(list)
    for sid, start in rows:
        if start is not None:
            hours[start[:13]].append(sid)
    days = defaultdict(int)
    for hour, ids in hours.items():
        days[hour[:10]] += len(ids)
    chosen = set()
    for hour, ids in hours.items():
        quota = min(int(len(ids) / days[hour[:10]] * (total // len(days))), len(ids))
        ids.sort(key=lambda s: (hashlib.md5(f"{seed}:{s}".encode()).hexdigest(), s))
        chosen |= set(ids[:quota])
    return chosen


def sessions(spark, rows):
    return spark.createDataFrame(rows, "session_id string, start text".replace("text", "string")).select(
        "session_id", F.col("start").cast("timestamp").alias("start_time"))


ROWS = (
    [(f"hot{i}", "2024-01-01 10:15:00") for i in range(3000)]  # one hour holds most sessions
    + [(f"h{h}_{i}", f"2024-01-01 {h:02d}:00:00") for h in range(24) for i in range(h * 3 + 1)]
    + [(f"d{d}_{i}", f"2024-01-{d:02d} {i % 7:02d}:30:00") for d in range(2, 6) for i in range(40 * d)]
    + [("no time", None)]
)


@pytest.mark.parametrize("total, seed", [(1000, 42), (1000, 7), (100, 42), (4, 42), (100000, 42)])
def test_sample_equals_brute_force(spark, total, seed):
    got = [r.session_id for r in sample_sessions(sessions(spark, ROWS), total, seed).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute_force(ROWS, total, seed)


def test_partitioning_does_not_change_the_sample(spark):
    df = sessions(spark, ROWS)
    first = {r.session_id for r in sample_sessions(df.repartition(1), 500).collect()}
    assert first == {r.session_id for r in sample_sessions(df.repartition(13, "session_id"), 500).collect()}


def test_sample_without_broadcast(spark, monkeypatch):
    from visitlens.operators import bounds

    monkeypatch.setattr(bounds, "BROADCAST_ROWS", 0)
    got = {r.session_id for r in sample_sessions(sessions(spark, ROWS), 1000, 42).collect()}
    assert got == brute_force(ROWS, 1000, 42)


def test_quotas_never_exceed_hours_days_or_total(spark):
    df = hour_quotas(hour_counts(sessions(spark, ROWS)), 1000)
    rows = df.collect()
    assert {r.day_quota for r in rows} == {200}
    assert all(r.hour_quota <= r.session_count for r in rows)
    by_day = defaultdict(int)
    for r in rows:
        by_day[r.day_hour[:10]] += r.hour_quota
    assert all(n <= 200 for n in by_day.values())


def test_by_task_equals_each_alone(spark):
    df = sessions(spark, ROWS).withColumn("task_id", F.lit(1))
    other = sessions(spark, ROWS[::3]).withColumn("task_id", F.lit(2))
    got = sample_sessions(df.unionByName(other), 300, by=("task_id",), groups=2).collect()
    for task, rows in ((1, ROWS), (2, ROWS[::3])):
        assert {r.session_id for r in got if r.task_id == task} == brute_force(rows, 300, 42)


def test_empty(spark):
    assert sample_sessions(sessions(spark, []), 100).count() == 0


@pytest.mark.parametrize("total", [1, 5, 10])
def test_a_session_without_id_is_drawn_like_any_other(spark, total):
    rows = [(f"s{i}" if i else None, "2024-01-01 10:00:00") for i in range(10)]
    assert sample_sessions(sessions(spark, rows), total).count() == total
