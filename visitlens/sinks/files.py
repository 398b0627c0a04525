"""Result tables as files, one folder per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_by_task(df: DataFrame, path: str, task_ids: Sequence[int], fmt: str = "parquet") -> None:
    """Replace these tasks' rows of the table at ``path``; other tasks' rows stay.

    Writing again gives the same table: a task's folder is overwritten as a whole. Dynamic
    overwrite leaves the folder of a task without rows as it was; the tasks that had rows are
    noticed during the write, and the others' folders are emptied without further jobs.
    """
    seen = Observation()
    (
        df.observe(seen, F.collect_set("task_id").alias("tasks"))
        .write.format(fmt).mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("task_id")
        .save(path)
    )
    missing = sorted(set(task_ids) - set(seen.get["tasks"]))
    if not missing:
        return
    # One file without rows keeps the table readable, should no task have any.
    empty = df.sparkSession.createDataFrame([], df.drop("task_id").schema)
    empty.coalesce(1).write.format(fmt).mode("overwrite").save(f"{path}/task_id={missing[0]}")
    context = df.sparkSession.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs
    for i in missing[1:]:
        folder = hadoop.Path(f"{path}/task_id={i}")
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def rebalanced(df: DataFrame) -> DataFrame:
    """For results filtered from a huge scan: few well-sized files per task instead of one per scan
    partition. Adaptive execution splits a task with many rows over several writers."""
    return df.hint("rebalance", "task_id")
