"""Task rows and their filter parameters."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CATEGORY_ID = re.compile("-?[1-9][0-9]{0,18}|0")

# Parameter key -> our column.
PARAM_KEYS = {
    "startDate": "start_date",
    "endDate": "end_date",
    "startAge": "start_age",
    "endAge": "end_age",
    "professionals": "professionals",
    "cities": "cities",
    "sex": "sex",
    "keywords": "keywords",
    "categoryIds": "category_ids",
}


def decode_params(tasks: DataFrame) -> DataFrame:
    """``task_param`` JSON -> one text column per key.

    Each value is a JSON array of which the first element counts; absent, empty array and empty
    text all mean "no such parameter".
    """
    params = F.from_json("task_param", "map<string,array<string>>")
    first = [
        F.nullif(F.get(F.col("_params")[key], F.lit(0)), F.lit("")).alias(column)
        for key, column in PARAM_KEYS.items()
    ]
    return tasks.withColumn("_params", params).select("task_id", *first)


def _items(text: str | None) -> tuple[str, ...] | None:
    if text is None:
        return None
    return tuple(item for item in text.split(",") if item)


@dataclass(frozen=True)
class Task:
    """One task's parameters as plain values; None means "not given"."""

    task_id: int
    start_date: date | None = None
    end_date: date | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] | None = None
    cities: tuple[str, ...] | None = None
    sex: str | None = None
    keywords: tuple[str, ...] | None = None
    category_ids: tuple[int, ...] | None = None

    @classmethod
    def from_texts(cls, task_id: int, texts: dict[str, str | None]) -> Task:
        """From the columns of :func:`decode_params`."""

        def number(name):
            return None if texts[name] is None else int(texts[name])

        def day(name):
            return None if texts[name] is None else date.fromisoformat(texts[name])

        categories = _items(texts["category_ids"])
        if categories is not None:
            # Ids match as text, so '07' is not 7; what no bigint can be, no action can hold.
            categories = tuple(int(c) for c in categories if CATEGORY_ID.fullmatch(c) and -(2**63) <= int(c) < 2**63)
        return cls(
            task_id=task_id,
            start_date=day("start_date"),
            end_date=day("end_date"),
            start_age=number("start_age"),
            end_age=number("end_age"),
            professionals=_items(texts["professionals"]),
            cities=_items(texts["cities"]),
            sex=texts["sex"],
            keywords=_items(texts["keywords"]),
            category_ids=categories,
        )

    @classmethod
    def from_json(cls, task_id: int, task_param: str) -> Task:
        """From the JSON text itself, when there is no task table to read."""
        given = json.loads(task_param)
        texts = {}
        for key, column in PARAM_KEYS.items():
            values = given.get(key)
            first = values[0] if isinstance(values, list) and values else None
            texts[column] = None if first in (None, "") else str(first)
        return cls.from_texts(task_id, texts)

    @property
    def ages(self) -> tuple[int, int] | None:
        """The age range; one bound alone filters nothing."""
        if self.start_age is None or self.end_age is None:
            return None
        return self.start_age, self.end_age


def load_tasks(tasks: DataFrame, task_ids: Sequence[int], bad: dict[int, str] | None = None) -> list[Task]:
    """The rows with these ids, as values for building plans: parameters, not data.

    The ids are literals, so the filter reaches the source (a jdbc WHERE, a parquet filter).
    A task whose parameters cannot be read raises; given ``bad``, it is left out and noted there.
    """
    wanted = tasks.where(F.col("task_id").isin([int(i) for i in task_ids]))
    found: dict[int, Task] = {}
    for row in decode_params(wanted).collect():
        if row["task_id"] in found:
            raise ValueError(f"task {row['task_id']} is in the task table more than once")
        texts = row.asDict()
        try:
            found[row["task_id"]] = Task.from_texts(texts.pop("task_id"), texts)
        except ValueError as error:
            if bad is None:
                raise
            bad[row["task_id"]] = str(error)
    missing = sorted(set(task_ids) - set(found) - set(bad or ()))
    if missing:
        raise LookupError(f"no such task: {missing}")
    return [found[i] for i in dict.fromkeys(task_ids) if i in found]


def load_task(tasks: DataFrame, task_id: int) -> Task:
    return load_tasks(tasks, [task_id])[0]


def task_frame(spark, tasks: Iterable[Task]) -> DataFrame:
    """Tasks as a small table for plans that serve many at once."""
    return spark.createDataFrame(
        [
            (
                t.task_id, t.start_date, t.end_date,
                t.ages[0] if t.ages else None, t.ages[1] if t.ages else None,
                None if t.professionals is None else list(t.professionals),
                None if t.cities is None else list(t.cities),
                t.sex,
                None if t.keywords is None else list(t.keywords),
                None if t.category_ids is None else list(t.category_ids),
            )
            for t in tasks
        ],
        "task_id bigint, start_date date, end_date date, start_age int, end_age int, "
        "professionals array<string>, cities array<string>, task_sex string, "
        "keywords array<string>, category_ids array<bigint>",
    )
