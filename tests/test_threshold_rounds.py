"""Top sessions by rounds: the same as sorting everything, with few rows sent."""

import pytest
from pyspark.sql import functions as F

from tests.rows import executed, values
from visitlens.operators import membership
from visitlens.operators.categories import top_sessions
from visitlens.operators.threshold_rounds import Rounds, doublings

DAYS = 30


def keep(df, name):
    return df.cache()


def plain(daily, sessions, categories, n):
    rows = daily.join(sessions, "session_id", "left_semi").join(categories, "category_id", "left_semi")
    totals = rows.groupBy("category_id", "session_id").agg(F.sum("click_count").alias("click_count"))
    return values(top_sessions(totals, n), "category_id", "session_id", "click_count")


def world(spark, sessions, heavy=0):
    """Some sessions of one day, some of up to DAYS; every ``heavy``th has counts far above the others."""
    ids = spark.range(sessions).withColumn("span", F.when(F.col("id") % 10 == 0, DAYS).when(F.col("id") % 10 == 5, 7).otherwise(1))
    rows = ids.select("id", F.explode(F.expr("sequence(0, cast(span - 1 as int))")).alias("at"), F.explode(F.expr("sequence(0, 4)")).alias("category_id"))
    draw = F.pmod(F.xxhash64("id", "at", "category_id"), F.lit(6))
    count = draw if not heavy else F.when(F.col("id") % heavy == 0, draw + 40).otherwise(draw)
    rows = rows.select(
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("id") + F.col("at"), F.lit(DAYS)).cast("int")).alias("date"),
        F.concat(F.lit("s"), "id").alias("session_id"), F.col("category_id").cast("bigint").alias("category_id"), count.alias("click_count"))
    rows = rows.where("click_count > 0").cache()
    chosen = rows.where("cast(substring(session_id, 2) as int) % 3 < 2").groupBy("session_id").agg(F.countDistinct("date").alias("n_days")).cache()
    return rows, chosen, spark.range(4).select(F.col("id").alias("category_id"))


def test_doublings(spark):
    got = spark.range(1, 10).select(doublings(F.col("id")).alias("d")).collect()
    assert [r["d"] for r in got] == [0, 1, 2, 2, 3, 3, 3, 3, 4]


@pytest.mark.parametrize("sessions, heavy, n", [(0, 0, 3), (2, 0, 3), (300, 0, 1), (300, 0, 10), (300, 7, 10), (300, 100, 10)])
def test_equal_to_sorting_everything(spark, sessions, heavy, n):
    daily, chosen, categories = world(spark, sessions, heavy)
    got = Rounds(daily, chosen, chosen.count(), categories, keep, n, 4)
    assert values(got.top, "category_id", "session_id", "click_count") == plain(daily, chosen, categories, n)


def test_ties_at_the_floor(spark):
    """All pairs have the same total, on one day or spread over several."""
    rows = [("2024-01-01", f"a{i}", 1, 6) for i in range(20)] + [(f"2024-01-0{d}", f"b{i}", 1, 2) for i in range(20) for d in (1, 2, 3)]
    rows += [(f"2024-01-0{d}", "0", 1, 1) for d in range(1, 7)]
    daily = spark.createDataFrame(rows, "date string, session_id string, category_id bigint, click_count bigint").withColumn("date", F.col("date").cast("date"))
    chosen = daily.groupBy("session_id").agg(F.count("*").alias("n_days"))
    one = spark.createDataFrame([(1,)], "category_id bigint")
    got = Rounds(daily, chosen, 41, one, keep, 5, 1)
    assert [v[0] for v in values(got.top, "session_id")] == ["0", "a0", "a1", "a10", "a11"]
    assert values(got.top, "category_id", "session_id", "click_count") == plain(daily, chosen, one, 5)


def test_a_session_without_id_is_in_no_category(spark):
    daily = spark.createDataFrame([("2024-01-01", None, 1, 9), ("2024-01-01", "a", 1, 1)], "date string, session_id string, category_id bigint, click_count bigint")
    chosen = spark.createDataFrame([(None, 1), ("a", 1)], "session_id string, n_days bigint")
    got = Rounds(daily, chosen, 2, spark.createDataFrame([(1,)], "category_id bigint"), keep, 5, 1)
    assert values(got.top, "session_id", "click_count") == [("a", 1)]


def test_few_rows_are_sent(spark):
    daily, chosen, categories = world(spark, 3000, 100)
    got = Rounds(daily, chosen, chosen.count(), categories, keep, 10, 4)
    assert values(got.top, "category_id", "session_id", "click_count") == plain(daily, chosen, categories, 10)
    wanted = daily.join(chosen, "session_id", "left_semi").join(categories, "category_id", "left_semi").count()
    assert got.candidates.count() < 0.05 * wanted and got.last.count() < 0.1 * wanted
    text = executed(got.top)
    assert "WindowGroupLimit" in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_without_a_filter_the_result_is_the_same(spark, monkeypatch):
    monkeypatch.setattr(membership, "MOST_BLOCKS", 0)
    daily, chosen, categories = world(spark, 200, 9)
    got = Rounds(daily, chosen, chosen.count(), categories, keep, 10, 4)
    assert values(got.top, "category_id", "session_id", "click_count") == plain(daily, chosen, categories, 10)
