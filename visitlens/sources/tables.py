"""Actions and users from catalog tables, temp views or files of any Spark format."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.functions.times import parse_time
from visitlens.schemas import ACTION_COLUMNS, TASK_COLUMNS, USER_COLUMNS


def _read(spark: SparkSession, columns: dict[str, str], source: str, fmt: str | None, options: dict) -> DataFrame:
    """``fmt`` None: a catalog table or view name. Else a path (or, for jdbc, a table name).

    csv and json carry no types: they get the schema, since inferring it would read them twice.
    """
    if fmt is None:
        return spark.table(source)
    reader = spark.read.format(fmt).options(**options)
    if fmt == "jdbc":
        return reader.option("dbtable", source).load()
    if fmt in ("csv", "json"):
        as_text = {"date", "action_time"}
        reader = reader.schema(", ".join(f"{n} {'string' if n in as_text else t}" for n, t in columns.items()))
    return reader.load(source)


def _conform(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The named columns, in order, cast only where the stored type differs.

    A column that already has its type stays a bare reference, so filters on it reach the scan.
    """
    stored = dict(df.dtypes)
    picked = []
    for name, wanted in columns.items():
        column = F.col(name)
        if stored[name] == wanted:
            picked.append(column)
        elif name == "action_time" and stored[name] == "string":
            picked.append(parse_time(column).alias(name))
        else:
            picked.append(column.try_cast(wanted).alias(name))
    return df.select(*picked)


def as_actions(df: DataFrame) -> DataFrame:
    """Any table with the action columns -> typed actions. A ``date`` stored as ``yyyy-MM-dd``
    text stays text: it compares like a date, and the comparison can then prune files."""
    columns = dict(ACTION_COLUMNS)
    if dict(df.dtypes)["date"] == "string":
        columns["date"] = "string"
    return _conform(df, columns)


def as_users(df: DataFrame) -> DataFrame:
    return _conform(df, USER_COLUMNS)


def as_tasks(df: DataFrame) -> DataFrame:
    return _conform(df, TASK_COLUMNS)


def read_actions(spark: SparkSession, source: str = "user_visit_action", fmt: str | None = None, **options: str) -> DataFrame:
    return as_actions(_read(spark, ACTION_COLUMNS, source, fmt, options))


def read_users(spark: SparkSession, source: str = "user_info", fmt: str | None = None, **options: str) -> DataFrame:
    return as_users(_read(spark, USER_COLUMNS, source, fmt, options))


def read_tasks(spark: SparkSession, source: str = "task", fmt: str | None = None, **options: str) -> DataFrame:
    return as_tasks(_read(spark, TASK_COLUMNS, source, fmt, options))
