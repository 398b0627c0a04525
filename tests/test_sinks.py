from pyspark.sql import functions as F

from tests.rows import values
from visitlens.sinks.files import write_by_task
from visitlens.sinks.jdbc import jdbc_options


def table(spark, rows):
    return spark.createDataFrame(rows, "task_id bigint, session_id string, n bigint")


def test_rewriting_a_task_replaces_it_and_only_it(spark, tmp_path):
    path = str(tmp_path / "out")
    write_by_task(table(spark, [(1, "a", 1), (1, "b", 2)]), path, [1])
    write_by_task(table(spark, [(2, "c", 3)]), path, [2])
    write_by_task(table(spark, [(1, "a", 9)]), path, [1])
    write_by_task(table(spark, [(1, "a", 9)]), path, [1])
    got = spark.read.parquet(path).withColumn("task_id", F.col("task_id").cast("bigint"))
    assert values(got, "task_id", "session_id", "n") == [(1, "a", 9), (2, "c", 3)]


def test_a_task_without_rows_loses_its_old_ones(spark, tmp_path):
    path = str(tmp_path / "out")
    write_by_task(table(spark, [(1, "a", 1), (2, "b", 2), (3, "c", 3)]), path, [1, 2, 3])
    write_by_task(table(spark, [(2, "d", 4)]), path, [1, 2])
    assert values(spark.read.parquet(path), "task_id", "session_id") == [(2, "d"), (3, "c")]
    write_by_task(table(spark, []), path, [2])
    assert values(spark.read.parquet(path), "task_id", "session_id") == [(3, "c")]


def test_first_write_without_rows(spark, tmp_path):
    path = str(tmp_path / "out")
    write_by_task(table(spark, []), path, [5])
    assert spark.read.parquet(path).count() == 0


def test_jdbc_options():
    got = jdbc_options("jdbc:x://host/db", "top10_category", 4, user="me")
    assert got == {"url": "jdbc:x://host/db", "dbtable": "top10_category", "batchsize": "1000",
                   "numPartitions": "4", "user": "me"}


def test_no_job_per_task_without_rows(spark, tmp_path):
    path = str(tmp_path / "out")
    many = list(range(300))
    write_by_task(table(spark, [(i, "a", i) for i in range(0, 300, 100)]), path, many)
    write_by_task(table(spark, [(7, "b", 1)]), path, many)
    assert values(spark.read.parquet(path), "task_id", "session_id") == [(7, "b")]
