"""Intermediate results several outputs read."""

from __future__ import annotations

import uuid
import warnings

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def _set_on_context(spark: SparkSession) -> str | None:
    """The folder given to ``SparkContext.setCheckpointDir``, where there is such a context."""
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # no context behind a remote session
        return None


class Kept:
    """``with Kept(spark) as kept: df = kept.keep(df, 'name')``.

    With ``spark.checkpoint.dir`` set (or else ``folder`` given), a kept result is a table in that shared folder: lost
    executors cost nothing, readers prune its columns, and the planner knows its size. Without it,
    the result is persisted on the executors, and Spark recomputes what a lost one held. Both end
    with the block.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self._spark = spark
        root = spark.conf.get("spark.checkpoint.dir", None) or folder or _set_on_context(spark)
        if root is None:
            warnings.warn("neither spark.checkpoint.dir nor a work folder is set: intermediate results stay on "
                          "the executors, and what a lost one held is computed again", stacklevel=3)
        self._folder = f"{root.rstrip('/')}/visitlens-{uuid.uuid4().hex}" if root else None
        self._persisted: list[DataFrame] = []

    def __enter__(self) -> Kept:
        return self

    def path(self, name: str) -> str:
        """A place of that name in the folder, for a table the caller writes."""
        if self._folder is None:
            raise ValueError("no shared folder is set")
        return f"{self._folder}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        if self._folder is None:
            df = df.persist(StorageLevel.MEMORY_AND_DISK)
            self._persisted.append(df)
            return df
        path = f"{self._folder}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *exc) -> None:
        for df in self._persisted:
            df.unpersist()
        if self._folder is not None:
            hadoop = self._spark.sparkContext._jvm.org.apache.hadoop.fs
            path = hadoop.Path(self._folder)
            path.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
