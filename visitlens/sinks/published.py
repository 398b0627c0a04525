"""All result tables of a run become visible together, or not at all.

A run writes its tables under ``<root>/<table>/run=<run>/task_id=<task>``, where no reader looks yet. One
small manifest then says for every task which run its results are of: ``<root>/_manifests/<version>``, of which
the greatest complete version counts. Readers go by the manifest, so that they see the five tables of one
run. A run that fails leaves the last manifest as it was. Runs of different tasks may go on side by side: a
version is made by creating its file, which only one of them can; the other reads what the first has
published and adds its own tasks in the next version.

The file system must refuse to create a file that exists (HDFS and local ones do). A manifest that a
writer did not finish is no JSON of ours and is passed over.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from py4j.protocol import Py4JJavaError

MANIFESTS = "_manifests"
ATTEMPTS = 100


def new_run() -> str:
    """A name that partition discovery takes for text."""
    return f"r{uuid.uuid4().hex}"


def table_path(root: str, name: str, run: str | None) -> str:
    return f"{root}/{name}" if run is None else f"{root}/{name}/run={run}"


class Manifests:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self._folder = f"{root.rstrip('/')}/{MANIFESTS}"
        self._fs = self._path(self._folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def versions(self) -> list[int]:
        """All that exist, the last first."""
        if not self._fs.exists(self._path(self._folder)):
            return []
        names = [status.getPath().getName() for status in self._fs.listStatus(self._path(self._folder))]
        return sorted((int(n) for n in names if n.isdigit()), reverse=True)

    def read(self, version: int) -> dict[int, str] | None:
        """Task -> run; None if the file is not complete."""
        stream = self._fs.open(self._path(f"{self._folder}/{version:012d}"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return {int(task): run for task, run in json.loads(text)["tasks"].items()}
        except (ValueError, KeyError, TypeError, AttributeError):
            return None

    def last(self) -> dict[int, str]:
        return next((tasks for v in self.versions() if (tasks := self.read(v)) is not None), {})

    def create(self, version: int, tasks: dict[int, str]) -> bool:
        """False if the version exists already."""
        path = self._path(f"{self._folder}/{version:012d}")
        try:
            stream = self._fs.create(path, False)
        except Py4JJavaError as error:
            if self._fs.exists(path):
                return False
            raise error
        try:
            stream.write(bytearray(json.dumps({"tasks": {str(t): r for t, r in sorted(tasks.items())}}).encode()))
        finally:
            stream.close()
        return True

    def publish(self, run: str, task_ids: Sequence[int], gone: Sequence[int] = ()) -> int:
        """From now on these tasks' results are those of ``run``; those of ``gone`` have none; others stay as they are."""
        for _ in range(ATTEMPTS):
            version = next(iter(self.versions()), 0) + 1
            stay = {task: of for task, of in self.last().items() if task not in gone}
            if self.create(version, stay | {int(i): run for i in task_ids}):
                return version
        raise RuntimeError(f"other runs published {ATTEMPTS} times meanwhile")

    def expire(self, root: str, names: Sequence[str], keep: int = 2) -> list[str]:
        """Delete runs that none of the last ``keep`` complete manifests names, and older manifests.

        Runs that have not published yet look the same: not to be called while any is at work.
        """
        complete = [(v, tasks) for v in self.versions() if (tasks := self.read(v)) is not None][:keep]
        used = {run for _, tasks in complete for run in tasks.values()}
        gone = set()
        for name in names:
            if not self._fs.exists(self._path(f"{root}/{name}")):
                continue
            for status in self._fs.listStatus(self._path(f"{root}/{name}")):
                run = status.getPath().getName().removeprefix("run=")
                if status.isDirectory() and run != status.getPath().getName() and run not in used:
                    self._fs.delete(status.getPath(), True)
                    gone.add(run)
        for version in self.versions():
            if complete and version < complete[-1][0]:
                self._fs.delete(self._path(f"{self._folder}/{version:012d}"), False)
        return sorted(gone)


def read_published(spark: SparkSession, root: str, name: str, task_ids: Sequence[int] | None = None) -> DataFrame | None:
    """The table as last published, of all tasks or of some; None if nothing is published of them.

    Which run a task's rows are of is a filter on partition folders: others are not read.
    """
    runs: dict[str, list[int]] = {}
    for task, run in Manifests(spark, root).last().items():
        if task_ids is None or task in task_ids:
            runs.setdefault(run, []).append(task)
    if not runs:
        return None
    rows = spark.read.option("basePath", f"{root}/{name}").parquet(*[table_path(root, name, run) for run in sorted(runs)])
    mine = [(F.col("run") == run) & F.col("task_id").isin(tasks) for run, tasks in sorted(runs.items())]
    rows = rows.where(reduce(lambda x, y: x | y, mine))
    return rows.withColumn("task_id", F.col("task_id").cast("bigint")).drop("run")
