import pytest
from pyspark.sql import functions as F

from datetime import date

from tests.rows import action, executed, planned, stored, users, values
from visitlens.operators.rollup import roll_up
from visitlens.operators.scan import actions_between
from visitlens.schemas import ACTION_COLUMNS
from visitlens.sources.tables import as_actions, read_actions, read_users

ROWS = [action(f"s{d}", f"2024-01-{d:02d} 9:05:03", click=d) for d in range(1, 11)]


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_files_and_bounds(spark, tmp_path, fmt):
    path = str(tmp_path / "actions")
    stored(spark, ROWS).write.format(fmt).save(path)
    df = read_actions(spark, path, fmt)
    assert df.columns == list(ACTION_COLUMNS)
    got = actions_between(df, date(2024, 1, 3), date(2024, 1, 5))
    assert values(got, "session_id") == [("s3",), ("s4",), ("s5",)]
    assert got.first().action_time.hour == 9
    assert actions_between(df, None, date(2024, 1, 2)).count() == 2
    assert actions_between(df, date(2024, 1, 9), None).count() == 2
    assert actions_between(df, None, None).count() == 10


def test_views_and_typed_tables(spark):
    stored(spark, ROWS).createOrReplaceTempView("user_visit_action")
    users(spark, [(1, 20, "p", "c", "male")]).createOrReplaceTempView("user_info")
    assert read_actions(spark).count() == 10
    assert read_users(spark).first().age == 20
    typed = as_actions(stored(spark, ROWS)).withColumn("date", F.col("date").cast("date"))
    typed.createOrReplaceTempView("typed")
    again = read_actions(spark, "typed")
    assert dict(again.dtypes) == ACTION_COLUMNS
    assert actions_between(again, date(2024, 1, 3), date(2024, 1, 3)).count() == 1


def test_text_ages_are_read(spark):
    df = users(spark, [(1, 20, "p", "c", "male")]).withColumn("age", F.lit("x"))
    df.createOrReplaceTempView("people")
    assert read_users(spark, "people").first().age is None


def test_date_bounds_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "plain")
    stored(spark, ROWS).write.parquet(path)
    plan = planned(roll_up(actions_between(read_actions(spark, path, "parquet"), date(2024, 1, 3), date(2024, 1, 5))))
    assert "GreaterThanOrEqual(date,2024-01-03), LessThanOrEqual(date,2024-01-05)" in plan
    assert "ReadSchema: struct<date:string,user_id:bigint,session_id:string,action_time:string>" in plan


@pytest.mark.parametrize("kind", ["string", "date"])
def test_partitioned_tables_are_pruned(spark, tmp_path, kind):
    path = str(tmp_path / "by_date")
    stored(spark, ROWS).withColumn("date", F.col("date").cast(kind)).write.partitionBy("date").parquet(path)
    got = actions_between(read_actions(spark, path, "parquet"), date(2024, 1, 3), date(2024, 1, 4))
    plan = executed(got)
    assert "date" in plan.split("PartitionFilters: [")[1].split("]")[0] and "PushedFilters: []" in plan
    assert {f.split("date=")[1].split("/")[0] for f in got.inputFiles()} == {"2024-01-03", "2024-01-04"} or got.count() == 2


def test_bucketed_table_rolls_up_without_a_shuffle(spark):
    stored(spark, ROWS).write.bucketBy(4, "session_id").mode("overwrite").saveAsTable("bucketed_actions")
    plan = planned(roll_up(read_actions(spark, "bucketed_actions")))
    assert "Exchange" not in plan
    spark.sql("DROP TABLE bucketed_actions")
