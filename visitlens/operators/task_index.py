"""Which tasks a user, or a day, can be in: an inverted index from values to bitmaps of tasks.

Tasks are numbered; a bitmap is an array of 64-bit words. For each attribute the index has a bitmap for
every value some task asks for, and one for all others (the tasks that do not ask). A user's tasks are
the AND of at most four bitmaps: one lookup an attribute, whatever the number of tasks. Ages and days are
looked up by step: between two neighbouring bounds of any task, the tasks are the same.

The tables of the index grow with the tasks' parameters, never with the data.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.operators.bounds import broadcast_if
from visitlens.sources.tasks import Task

WORD_BITS = 64

# Days the index lists one by one; where the bounds lie further apart, steps are counted for every row.
LISTED_DAYS = 100_000

BITMAP = "array<bigint>"


def bitmap(numbers: Iterable[int], count: int) -> list[int]:
    """The words (as signed numbers) with these bits, of ``count`` tasks."""
    words = [0] * max(1, -(-count // WORD_BITS))
    for number in numbers:
        words[number // WORD_BITS] |= 1 << number % WORD_BITS
    return [w - (1 << WORD_BITS) if w >> WORD_BITS - 1 else w for w in words]


def both(x: Column, y: Column) -> Column:
    return F.zip_with(x, y, lambda a, b: a.bitwiseAND(b))


def either(x: Column, y: Column) -> Column:
    return F.zip_with(x, y, lambda a, b: a.bitwiseOR(b))


def has(words: Column, number: Column) -> Column:
    word = F.get(words, F.floor(number / WORD_BITS).cast("int"))
    return F.coalesce(F.call_function("shiftright", word, F.pmod(number, F.lit(WORD_BITS)).cast("int")).bitwiseAND(F.lit(1)) != 0, F.lit(False))


def numbers_in(words: Column) -> Column:
    """The numbers of the set bits. Words without any cost nothing more."""
    def bits(word: Column, at: Column) -> Column:
        every = F.filter(F.sequence(F.lit(0), F.lit(WORD_BITS - 1)), lambda b: F.call_function("shiftright", word, b).bitwiseAND(F.lit(1)) != 0)
        return F.when(word != 0, F.transform(every, lambda b: at * WORD_BITS + b)).otherwise(F.array().cast("array<int>"))

    return F.flatten(F.transform(words, bits))


def steps(ranges: Sequence[tuple]) -> tuple[list, list[list[int]]]:
    """Sorted bounds, and for every step (below the first bound, from it to the next, ...) the ranges that hold it.

    ``ranges``: (from, before) with None for no bound.
    """
    bounds = sorted({b for pair in ranges for b in pair if b is not None})
    inside = []
    for step in range(len(bounds) + 1):
        low = bounds[step - 1] if step else None
        inside.append([
            i for i, (start, stop) in enumerate(ranges)
            if (start is None or low is not None and start <= low) and (stop is None or low is None or low < stop)
            and not (start is not None and stop is not None and start >= stop)])
    return bounds, inside


class TaskIndex:
    def __init__(self, spark: SparkSession, tasks: Sequence[Task]):
        self._spark, self._tasks = spark, list(tasks)
        self.every = self._bitmap(range(len(self._tasks)))

    def _bitmap(self, numbers: Iterable[int]) -> list[int]:
        return bitmap(numbers, len(self._tasks))

    def _table(self, rows: list[tuple], kind: str) -> DataFrame:
        table = self._spark.createDataFrame(rows, f"_value {kind}, _found {BITMAP}")
        return broadcast_if(table, len(rows) * max(1, len(self.every) // 4))

    @staticmethod
    def _literal(words: list[int]) -> Column:
        return F.array(*[F.lit(w).cast("bigint") for w in words])

    def _looked_up(self, rows: DataFrame, key: Column, table: list[tuple], kind: str, others: list[int], name: str) -> DataFrame:
        found = rows.join(self._table(table, kind), key == F.col("_value"), "left")
        return found.withColumn(name, F.coalesce("_found", self._literal(others))).drop("_value", "_found")

    def of_users(self, users: DataFrame) -> DataFrame:
        """user_id and ``tasks``: those whose conditions on users it meets."""
        rows, names = users.select("user_id", "age", "professional", "city", "sex"), []
        asked = {
            "professional": [t.professionals for t in self._tasks],
            "city": [t.cities for t in self._tasks],
            "sex": [None if t.sex is None else (t.sex,) for t in self._tasks],
        }
        for column, given in asked.items():
            if all(values is None for values in given):
                continue
            others = [i for i, values in enumerate(given) if values is None]
            wanted: dict = {}
            for i, values in enumerate(given):
                for value in set(values or ()):
                    wanted.setdefault(value, []).append(i)
            table = [(value, self._bitmap([*others, *numbers])) for value, numbers in wanted.items()]
            names.append(f"_{column}")
            rows = self._looked_up(rows, F.col(column), table, "string", self._bitmap(others), names[-1])
        if any(t.ages is not None for t in self._tasks):
            ranges = [(None, None) if t.ages is None else (t.ages[0], t.ages[1] + 1) for t in self._tasks]
            bounds, inside = steps(ranges)
            step = F.when(F.col("age").isNotNull(), F.size(F.filter(F.lit(bounds), lambda b: b <= F.col("age"))))
            names.append("_age")
            rows = self._looked_up(rows, step, [(n, self._bitmap(numbers)) for n, numbers in enumerate(inside)], "int",
                                   self._bitmap(i for i, t in enumerate(self._tasks) if t.ages is None), "_age")
        return rows.select("user_id", reduce(both, map(F.col, names), self._literal(self.every)).alias("tasks"))

    def of_days(self, rows: DataFrame, name: str) -> DataFrame:
        """Adds the tasks whose dates hold ``date``."""
        ranges = [(t.start_date, None if t.end_date is None or t.end_date == date.max else t.end_date + timedelta(1)) for t in self._tasks]
        bounds, inside = steps(ranges)
        if not bounds:
            return rows.withColumn(name, self._literal(self.every))
        first, last = bounds[0], bounds[-1]
        span = (last - first).days + 2
        if span <= LISTED_DAYS and first > date.min:  # before the first bound and after the last, all days are alike
            first -= timedelta(1)
            step, listed = 0, []
            for at in range(span):
                day = first + timedelta(at)
                step += step < len(bounds) and bounds[step] <= day
                listed.append((day, step))
            days = broadcast_if(self._spark.createDataFrame(listed, "_day date, _step int"), span)
            rows = rows.join(days, F.greatest(F.lit(first), F.least(F.lit(last), F.col("date"))) == F.col("_day"), "left").drop("_day")
        else:
            rows = rows.withColumn("_step", F.size(F.filter(F.lit(bounds), lambda b: b <= F.col("date"))))
        table = [(n, self._bitmap(numbers)) for n, numbers in enumerate(inside)]
        return self._looked_up(rows, F.col("_step"), table, "int", self._bitmap(()), name).drop("_step")
