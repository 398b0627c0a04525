"""A click stream, users and tasks derived from the ``events``, ``customer`` and ``nation`` tables.

Test and benchmark input only: those tables hold no sessions of their own. ``FIXTURES.md`` gives
the mapping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.schemas import ACTION_COLUMNS, TASK_COLUMNS, USER_COLUMNS

# Fixed values of the mapping.
FIRST_DAY = "2024-01-01"
KEYWORDS = ["hotpot", "cake", "fish hotpot", "noodles", "sushi", "mall", "tower", "hot spring", "bbq", "tea"]
UNKNOWN_USERS = 1_000_000_000
TIME_DIVISORS = [1, 20, 120, 900, 3000, 9000]


# Given, so that reading a table needs no look at its files before the plan runs.
_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _category(k: Column) -> Column:
    return F.floor(k * k / 500)


def _span(user_id: Column) -> Column:
    """Days a session lasts at most."""
    return F.when(user_id % 10 == 0, 30).when(user_id % 10 == 5, 15).otherwise(1)


def _part(ts: Column, user_id: Column) -> Column:
    """Number of the session among its user's."""
    return F.floor(F.datediff(ts.cast("date"), F.lit(FIRST_DAY).cast("date")) / _span(user_id))


def derived_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    user_id, ts, event_id = F.col("user_id"), F.col("ts"), F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")

    timed = events.select(
        user_id,
        _part(ts, user_id).alias("part"),
        F.unix_seconds(ts.cast("timestamp")).alias("s"),
        event_id, kind, F.floor("value").alias("product"), k.alias("k"),
    )
    # Times are compressed towards the first midnight of the session's days, which every row knows by
    # itself, and shifted by an hour that depends on user and part: no join, one scan.
    divisor = F.element_at(F.array(*map(F.lit, TIME_DIVISORS)), (user_id % 6 + 1).cast("int"))
    midnight = F.unix_seconds(F.lit(FIRST_DAY).cast("timestamp_ntz").cast("timestamp")) + F.col("part") * _span(user_id) * 86400
    hour = (user_id * 7 + F.col("part") * 5) % 24
    action_time = F.timestamp_seconds(midnight + hour * 3600 + F.floor((F.col("s") - midnight) / divisor))
    c1 = _category(F.col("k"))
    c2 = _category((F.col("k") + 7) % 100)
    ids = F.when(event_id % 3 == 0, F.concat_ws(",", c1.cast("string"), c2.cast("string"))).otherwise(c1.cast("string"))
    product = F.col("product").cast("bigint")
    keyword = F.element_at(F.array(*map(F.lit, KEYWORDS)), F.col("k") % 10 + 1)

    columns = {
        "session_id": F.concat(F.lit("u"), user_id.cast("string"), F.lit("_"), F.col("part").cast("string")),
        "date": action_time.cast("date"),
        "page_id": event_id % 10,
        "action_time": action_time,
        "search_keyword": F.when(kind == "view", keyword),
        "click_category_id": F.when(kind == "click", c1.cast("bigint")),
        "click_product_id": F.when(kind == "click", product),
        "order_category_ids": F.when(kind == "purchase", ids),
        "order_product_ids": F.when(kind == "purchase", product.cast("string")),
        "pay_category_ids": F.when(kind == "signup", ids),
        "pay_product_ids": F.when(kind == "signup", product.cast("string")),
    }
    # Some users are in no user table, so that joins have sessions to drop.
    unknown = F.when(user_id % 50 == 49, user_id + UNKNOWN_USERS).otherwise(user_id)
    return timed.withColumns(columns).withColumn("user_id", unknown).select(*ACTION_COLUMNS)


def derived_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    key = F.col("c_custkey")
    return (
        _table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            key.alias("user_id"),
            F.concat(F.lit("user"), key.cast("string")).alias("username"),
            F.col("c_name").alias("name"),
            (key * 7 % 60).cast("int").alias("age"),
            F.col("c_mktsegment").alias("professional"),
            F.col("n_name").alias("city"),
            F.when(key % 2 == 0, "male").otherwise("female").alias("sex"),
        )
        .select(*USER_COLUMNS)
    )


def derived_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One task per customer. ``c_custkey % 4`` decides which parameters it gives."""
    key = F.col("c_custkey")
    city = F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string"))

    def entry(name: str, *value) -> Column:
        text = F.concat(*[v if isinstance(v, Column) else F.lit(v) for v in value])
        return F.concat(F.lit(f'"{name}":["'), text, F.lit('"]'))

    first_day = F.lpad((key % 9 + 1).cast("string"), 2, "0")
    dates = [entry("startDate", "2024-01-", first_day), entry("endDate", "2024-01-31")]
    ages = [entry("startAge", (key % 30).cast("string")), entry("endAge", (key % 30 + 20).cast("string"))]
    work = [entry("sex", "male"), entry("professionals", F.col("c_mktsegment"), ",MACHINERY")]
    place = [entry("cities", city, ",NATION_3"), ages[0]]
    words = [entry("keywords", "hotpot,tea"), entry("categoryIds", (key % 20).cast("string"), ",7"), F.lit('"cities":[]')]

    def document(*entries: Column) -> Column:
        return F.concat(F.lit("{"), F.concat_ws(",", *entries), F.lit("}"))

    param = (
        F.when(key % 4 == 0, document(*dates, *ages))
        .when(key % 4 == 1, document(*dates, *work))
        .when(key % 4 == 2, document(*dates, *place))
        .otherwise(document(*dates, *words))
    )
    never = F.lit(None).cast("string")
    return (
        _table(spark, sf_dir, "customer")
        .select(
            (key + 1).alias("task_id"),
            F.concat(F.lit("task of "), F.col("c_name")).alias("task_name"),
            never.alias("create_time"), never.alias("start_time"), never.alias("finish_time"),
            F.lit("session").alias("task_type"),
            F.lit("new").alias("task_status"),
            param.alias("task_param"),
        )
        .select(*TASK_COLUMNS)
    )
