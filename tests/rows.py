"""Hand-made actions and users, and a look at plans."""

from datetime import datetime, timedelta

from visitlens.schemas import ACTION_COLUMNS, USER_COLUMNS
from visitlens.sources.tables import as_actions

STORED = ", ".join(
    f"{name} {'string' if name in ('date', 'action_time') else kind}" for name, kind in ACTION_COLUMNS.items()
)


def action(session, time="2024-01-01 10:00:00", user=1, page=0, keyword=None, click=None, order=None, pay=None, date=None):
    """One stored row: date and time are text, as delivered."""
    if date is None:
        date = time.split(" ")[0] if time and time[:1].isdigit() else "2024-01-01"
    return (date, user, session, page, time, keyword, click, click, order, order, pay, pay)


def stored(spark, rows):
    return spark.createDataFrame(rows, STORED)


def actions(spark, rows):
    return as_actions(stored(spark, rows))


def visit(session, seconds, steps, **more):
    """Rows of a session of this length in seconds and in steps."""
    start = datetime(2024, 1, 1, 10)
    at = [start] * (steps - 1) + [start + timedelta(seconds=seconds)]
    return [action(session, t.strftime("%Y-%m-%d %H:%M:%S"), **more) for t in at]


def users(spark, rows):
    """(user_id, age, professional, city, sex)"""
    full = [(i, f"user{i}", f"name{i}", age, job, city, sex) for i, age, job, city, sex in rows]
    return spark.createDataFrame(full, ", ".join(f"{n} {t}" for n, t in USER_COLUMNS.items()))


def values(df, *names):
    return sorted((tuple(row[n] for n in names or df.columns) for row in df.collect()), key=repr)


def executed(df):
    """The plan that ran (after adaptive changes)."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()
