from fractions import Fraction
from math import floor

from tests.rows import actions, visit
from visitlens.functions.ratios import share
from visitlens.operators.rollup import roll_up
from visitlens.operators.stats import session_shares, step_length_hist, visit_length_hist

SECONDS = [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]
STEPS = [1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61]


def test_visit_bucket_limits(spark):
    rows = [r for s in SECONDS for r in visit(f"s{s}", s, 2)]
    got = visit_length_hist(roll_up(actions(spark, rows))).first()
    assert list(got) == [2, 2, 2, 2, 2, 2, 2, 2, 1]  # 0 seconds are in no bucket


def test_step_bucket_limits(spark):
    rows = [r for n in STEPS for r in visit(f"s{n}", 5, n)]
    got = step_length_hist(roll_up(actions(spark, rows))).first()
    assert list(got) == [2, 2, 2, 2, 2, 1]


def test_shares(spark):
    rows = visit("a", 0, 2) + visit("b", 2, 2) + visit("c", 3, 5)
    got = session_shares(roll_up(actions(spark, rows))).first()
    assert got["session_count"] == 3
    assert got["visit_length_1s_3s_ratio"] == 0.67
    assert got["step_length_1_3_ratio"] == 0.67
    assert got["step_length_4_6_ratio"] == 0.33
    assert got["visit_length_30m_ratio"] == 0.0


def test_no_sessions(spark):
    got = session_shares(roll_up(actions(spark, []))).first().asDict()
    assert got.pop("session_count") == 0
    assert set(got.values()) == {None}


def test_share_is_exact_half_up(spark):
    pairs = [(n, c) for c in (1, 3, 7, 8, 200, 1000, 1584) for n in range(0, c + 1, max(1, c // 40))] + [(3, 200), (29, 200)]
    df = spark.createDataFrame(pairs, "n bigint, c bigint")
    for n, c, got in df.select("n", "c", share("n", "c")).collect():
        assert got == floor(Fraction(n, c) * 100 + Fraction(1, 2)) / 100
    assert spark.createDataFrame([(3, 200), (29, 200)], "n bigint, c bigint").select(
        share("n", "c").alias("r")).toPandas().r.tolist() == [0.02, 0.15]
