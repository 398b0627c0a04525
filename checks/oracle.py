"""SQL twins of the registered queries, for DuckDB, on the same tables.

Written from the definitions, not from the Spark plans: plain windows, joins and subqueries.
"""

from __future__ import annotations

# The task rows of FIXTURES.md.
_CONSTANT_TASKS = """  VALUES
    (1, DATE '2024-01-03', DATE '2024-01-25', 10, 50, NULL, NULL, NULL, NULL, NULL),
    (2, DATE '2024-01-01', DATE '2024-01-31', NULL, NULL, ['BUILDING', 'MACHINERY'], NULL, 'male', NULL, NULL),
    (3, DATE '2024-01-05', DATE '2024-01-12', NULL, NULL, NULL, ['NATION_1', 'NATION_2', 'NATION_3'], NULL, NULL, NULL),
    (4, DATE '2024-01-01', DATE '2024-01-31', NULL, NULL, NULL, NULL, NULL, ['hotpot', 'tea'], [0, 7])
"""

BASE = """
WITH stream AS (
  SELECT event_id, user_id, event_type,
         CAST(floor(value) AS BIGINT) AS product,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         epoch_us(ts) // 1000000 AS s,
         CASE WHEN user_id % 10 = 0 THEN 30 WHEN user_id % 10 = 5 THEN 15 ELSE 1 END AS span,
         date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // span AS part
  FROM events
), timed AS (
  SELECT *, 'u' || user_id || '_' || part AS session_id,
         epoch_us(TIMESTAMP '2024-01-01') // 1000000 + part * span * 86400 AS midnight,
         (user_id * 7 + part * 5) % 24 * 3600 AS shift,
         CASE user_id % 6 WHEN 0 THEN 1 WHEN 1 THEN 20 WHEN 2 THEN 120 WHEN 3 THEN 900 WHEN 4 THEN 3000 ELSE 9000 END AS d,
         (k * k) // 500 AS c1,
         (((k + 7) % 100) * ((k + 7) % 100)) // 500 AS c2
  FROM stream
), shaped AS (
  SELECT *, make_timestamp((midnight + shift + (s - midnight) // d) * 1000000) AS action_time,
         CASE WHEN event_id % 3 = 0 THEN c1 || ',' || c2 ELSE CAST(c1 AS VARCHAR) END AS ids
  FROM timed
), all_actions AS (
  SELECT CAST(action_time AS DATE) AS date, CASE WHEN user_id % 50 = 49 THEN user_id + 1000000000 ELSE user_id END AS user_id, session_id, event_id % 10 AS page_id, action_time,
         CASE WHEN event_type = 'view' THEN list_extract(['hotpot', 'cake', 'fish hotpot', 'noodles', 'sushi', 'mall',
           'tower', 'hot spring', 'bbq', 'tea'], k % 10 + 1) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN c1 END AS click_category_id,
         CASE WHEN event_type = 'click' THEN product END AS click_product_id,
         CASE WHEN event_type = 'purchase' THEN ids END AS order_category_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(product AS VARCHAR) END AS order_product_ids,
         CASE WHEN event_type = 'signup' THEN ids END AS pay_category_ids,
         CASE WHEN event_type = 'signup' THEN CAST(product AS VARCHAR) END AS pay_product_ids
  FROM shaped
), user_info AS (
  SELECT c_custkey AS user_id, c_custkey * 7 % 60 AS age, c_mktsegment AS professional, n_name AS city,
         CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer JOIN nation ON c_nationkey = n_nationkey
), params(task_id, start_date, end_date, start_age, end_age, professionals, cities, task_sex, keywords, categories) AS (
""" + _CONSTANT_TASKS + """), task_actions AS (
  SELECT CAST(task_id AS BIGINT) AS task_id, a.* FROM all_actions a JOIN params ON a.date BETWEEN start_date AND end_date
), task_rollup AS (
  SELECT task_id, session_id, min(user_id) AS user_id, min(action_time) AS start_at, max(action_time) AS end_at,
         count(*) AS step_length,
         epoch_us(max(action_time)) // 1000000 - epoch_us(min(action_time)) // 1000000 AS visit_length,
         coalesce(list_sort(list(DISTINCT search_keyword) FILTER (search_keyword <> '')), []) AS keyword_set,
         coalesce(list_sort(list(DISTINCT click_category_id) FILTER (click_category_id IS NOT NULL)), []) AS category_set
  FROM task_actions GROUP BY ALL
), task_joined AS (
  SELECT r.*, age, professional, city, sex, strftime(start_at, '%Y-%m-%d %H:%M:%S') AS start_time
  FROM task_rollup r JOIN user_info USING (user_id)
), task_filtered AS (
  SELECT j.* FROM task_joined j JOIN params p USING (task_id)
  WHERE (start_age IS NULL OR end_age IS NULL OR age BETWEEN start_age AND end_age)
    AND (professionals IS NULL OR list_contains(professionals, professional))
    AND (cities IS NULL OR list_contains(cities, city))
    AND (task_sex IS NULL OR sex = task_sex)
    AND (keywords IS NULL OR len(list_intersect(keywords, keyword_set)) > 0)
    AND (categories IS NULL OR len(list_intersect(categories, category_set)) > 0)
), task_events AS (
  SELECT task_id, session_id, 'click' AS kind, click_category_id AS category_id
  FROM task_actions WHERE click_category_id IS NOT NULL
  UNION ALL
  SELECT task_id, session_id, 'order', TRY_CAST(unnest(string_split(order_category_ids, ',')) AS BIGINT)
  FROM task_actions WHERE order_category_ids IS NOT NULL
  UNION ALL
  SELECT task_id, session_id, 'pay', TRY_CAST(unnest(string_split(pay_category_ids, ',')) AS BIGINT)
  FROM task_actions WHERE pay_category_ids IS NOT NULL
), filtered_events AS (
  SELECT e.* FROM task_events e JOIN (SELECT task_id, session_id FROM task_filtered) USING (task_id, session_id)
  WHERE category_id IS NOT NULL
), task_totals AS (
  SELECT task_id, category_id,
         count(*) FILTER (kind = 'click') AS click_count,
         count(*) FILTER (kind = 'order') AS order_count,
         count(*) FILTER (kind = 'pay') AS pay_count
  FROM filtered_events GROUP BY ALL
), task_top AS (
  SELECT * FROM task_totals
  QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id) <= 10
), task_clicks AS (
  SELECT task_id, category_id, session_id, count(*) AS click_count
  FROM filtered_events WHERE kind = 'click' AND (task_id, category_id) IN (SELECT task_id, category_id FROM task_top)
  GROUP BY ALL
), task_top_sessions AS (
  SELECT * FROM task_clicks
  QUALIFY row_number() OVER (PARTITION BY task_id, category_id ORDER BY click_count DESC, session_id) <= 10
), task_hours AS (
  SELECT task_id, strftime(start_at, '%Y-%m-%d') AS day, strftime(start_at, '%Y-%m-%d_%H') AS day_hour,
         count(*) AS session_count
  FROM task_filtered GROUP BY ALL
), task_quota AS (
  SELECT h.task_id, day_hour, session_count, day_count, 1000 // days AS day_quota,
         CAST(least(floor(CAST(session_count AS DOUBLE) / CAST(day_count AS DOUBLE) * (1000 // days)), session_count) AS BIGINT) AS hour_quota
  FROM task_hours h
  JOIN (SELECT task_id, day, CAST(sum(session_count) AS BIGINT) AS day_count FROM task_hours GROUP BY ALL) USING (task_id, day)
  JOIN (SELECT task_id, count(DISTINCT day) AS days FROM task_hours GROUP BY ALL) USING (task_id)
), task_sample AS (
  SELECT f.task_id, session_id, start_time,
         nullif(array_to_string(keyword_set, ','), '') AS search_keywords,
         nullif(array_to_string(category_set, ','), '') AS click_category_ids
  FROM task_filtered f JOIN task_quota q ON f.task_id = q.task_id AND strftime(start_at, '%Y-%m-%d_%H') = day_hour
  QUALIFY row_number() OVER (PARTITION BY f.task_id, day_hour ORDER BY md5('42:' || session_id), session_id) <= hour_quota
), detail AS (
  SELECT task_id, user_id, session_id, page_id, strftime(action_time, '%Y-%m-%d %H:%M:%S') AS action_time,
         search_keyword, click_category_id, click_product_id, order_category_ids, order_product_ids,
         pay_category_ids, pay_product_ids
  FROM task_actions
)
"""

_ACTION_TEXT = """strftime(date, '%Y-%m-%d') AS date, user_id, session_id, page_id,
  strftime(action_time, '%Y-%m-%d %H:%M:%S') AS action_time, search_keyword, click_category_id, click_product_id,
  order_category_ids, order_product_ids, pay_category_ids, pay_product_ids"""

_JOINED = "session_id, user_id, start_time, visit_length, step_length, age, professional, city, sex"

# Buckets, as in the definitions.
_VISIT = {
    "visit_length_1s_3s": "visit_length BETWEEN 1 AND 3",
    "visit_length_4s_6s": "visit_length BETWEEN 4 AND 6",
    "visit_length_7s_9s": "visit_length BETWEEN 7 AND 9",
    "visit_length_10s_30s": "visit_length BETWEEN 10 AND 30",
    "visit_length_30s_60s": "visit_length > 30 AND visit_length <= 60",
    "visit_length_1m_3m": "visit_length > 60 AND visit_length <= 180",
    "visit_length_3m_10m": "visit_length > 180 AND visit_length <= 600",
    "visit_length_10m_30m": "visit_length > 600 AND visit_length <= 1800",
    "visit_length_30m": "visit_length > 1800",
}
_STEP = {
    "step_length_1_3": "step_length BETWEEN 1 AND 3",
    "step_length_4_6": "step_length BETWEEN 4 AND 6",
    "step_length_7_9": "step_length BETWEEN 7 AND 9",
    "step_length_10_30": "step_length BETWEEN 10 AND 30",
    "step_length_30_60": "step_length > 30 AND step_length <= 60",
    "step_length_60": "step_length > 60",
}


def _hist(buckets: dict[str, str]) -> str:
    counts = ", ".join(f"count(*) FILTER ({cond}) AS {name}" for name, cond in buckets.items())
    return f"SELECT {counts} FROM task_filtered WHERE task_id = 1"


def _stat(group: str) -> str:
    ratios = ", ".join(
        f"floor((200 * count(*) FILTER ({cond}) + count(*)) // (2 * count(*))) / 100.0 AS {name}_ratio"
        for name, cond in {**_VISIT, **_STEP}.items()
    )
    return f"SELECT task_id, count(*) AS session_count, {ratios} FROM task_filtered {group} GROUP BY task_id"


def _one_filter(task_id: int, condition: str) -> str:
    return f"SELECT {_JOINED} FROM task_joined WHERE task_id = {task_id} AND {condition}"


def _kind_count(kind: str) -> str:
    return (
        f"SELECT category_id, count(*) AS {kind}_count FROM filtered_events "
        f"WHERE task_id = 1 AND kind = '{kind}' GROUP BY category_id"
    )


_SESSION_USER = f"SELECT {_JOINED} FROM task_joined WHERE task_id = 1"
_TOP_CATEGORY = "SELECT task_id, category_id, click_count, order_count, pay_count FROM task_top"
_TOP_SESSION = "SELECT task_id, category_id, session_id, click_count FROM task_top_sessions"
_SAMPLE = "SELECT task_id, session_id, start_time, search_keywords, click_category_ids FROM task_sample"

_TASK_TABLE = """
WITH numbered AS (
  SELECT c_custkey AS n, c_mktsegment AS segment, c_nationkey AS nation,
         '"startDate":["2024-01-' || lpad(CAST(c_custkey % 9 + 1 AS VARCHAR), 2, '0') || '"],"endDate":["2024-01-31"]' AS dates,
         '"startAge":["' || (c_custkey % 30) || '"]' AS low,
         '"endAge":["' || (c_custkey % 30 + 20) || '"]' AS high
  FROM customer
), task AS (
  SELECT n + 1 AS task_id, '{' || dates || ',' || CASE n % 4
    WHEN 0 THEN low || ',' || high
    WHEN 1 THEN '"sex":["male"],"professionals":["' || segment || ',MACHINERY"]'
    WHEN 2 THEN '"cities":["NATION_' || nation || ',NATION_3"],' || low
    ELSE '"keywords":["hotpot,tea"],"categoryIds":["' || (n % 20) || ',7"],"cities":[]' END || '}' AS task_param
  FROM numbered
)
SELECT task_id,
       json_extract_string(task_param, '$.startDate[0]') AS start_date,
       json_extract_string(task_param, '$.endDate[0]') AS end_date,
       json_extract_string(task_param, '$.startAge[0]') AS start_age,
       json_extract_string(task_param, '$.endAge[0]') AS end_age,
       json_extract_string(task_param, '$.professionals[0]') AS professionals,
       json_extract_string(task_param, '$.cities[0]') AS cities,
       json_extract_string(task_param, '$.sex[0]') AS sex,
       json_extract_string(task_param, '$.keywords[0]') AS keywords,
       json_extract_string(task_param, '$.categoryIds[0]') AS category_ids
FROM task
"""

_ON_BASE = {
    "action_range": f"SELECT {_ACTION_TEXT} FROM task_actions WHERE task_id = 1",
    "session_agg": """
      SELECT session_id, user_id, strftime(start_at, '%Y-%m-%d %H:%M:%S') AS start_time,
             strftime(end_at, '%Y-%m-%d %H:%M:%S') AS end_time, step_length, visit_length,
             nullif(array_to_string(keyword_set, ','), '') AS search_keywords,
             nullif(array_to_string(category_set, ','), '') AS click_category_ids
      FROM task_rollup WHERE task_id = 1""",
    "session_user_join": _SESSION_USER,
    "session_user_left_join": """
      SELECT session_id, user_id, strftime(start_at, '%Y-%m-%d %H:%M:%S') AS start_time, visit_length, step_length,
             age, professional, city, sex
      FROM task_rollup LEFT JOIN user_info USING (user_id) WHERE task_id = 1""",
    "broadcast_user_join": _SESSION_USER,
    "salted_user_join": _SESSION_USER,
    "split_user_join": _SESSION_USER,
    "balanced_user_join": _SESSION_USER,
    "heavy_categories": """
      SELECT click_category_id, row_count, CAST(ceil(row_count * 16 / all_rows) AS INTEGER) AS salts
      FROM (SELECT click_category_id, count(*) AS row_count, sum(count(*)) OVER () AS all_rows
            FROM all_actions WHERE click_category_id IS NOT NULL GROUP BY click_category_id)
      WHERE row_count * 16 > all_rows""",
    "skew_keys": """
      SELECT user_id, count(*) AS row_count FROM task_rollup WHERE task_id = 1
      GROUP BY user_id ORDER BY row_count DESC, user_id LIMIT 10""",
    "filter_age": _one_filter(1, "age BETWEEN 10 AND 50"),
    "filter_professional": _one_filter(2, "professional IN ('BUILDING', 'MACHINERY')"),
    "filter_city": _one_filter(3, "city IN ('NATION_1', 'NATION_2', 'NATION_3')"),
    "filter_sex": _one_filter(2, "sex = 'male'"),
    "filter_keyword": _one_filter(4, "(list_contains(keyword_set, 'hotpot') OR list_contains(keyword_set, 'tea'))"),
    "filter_category": _one_filter(4, "(list_contains(category_set, 0) OR list_contains(category_set, 7))"),
    "filter_session": """
      SELECT session_id, user_id, start_time, step_length, visit_length FROM task_filtered WHERE task_id = 4""",
    "filtered_actions": f"""
      SELECT {_ACTION_TEXT} FROM task_actions
      WHERE task_id = 1 AND session_id IN (SELECT session_id FROM task_filtered WHERE task_id = 1)""",
    "visit_length_hist": _hist(_VISIT),
    "step_length_hist": _hist(_STEP),
    "session_aggr_stat": _stat("WHERE task_id = 1"),
    "hour_counts": "SELECT day_hour, session_count FROM task_hours WHERE task_id = 1",
    "sample_quota": "SELECT day_hour, session_count, day_count, day_quota, hour_quota FROM task_quota WHERE task_id = 1",
    "sample_sessions": f"{_SAMPLE} WHERE task_id = 1",
    "sample_detail": """
      SELECT detail.* FROM detail
      WHERE task_id = 1 AND session_id IN (SELECT session_id FROM task_sample WHERE task_id = 1)""",
    "category_click_count": _kind_count("click"),
    "category_order_count": _kind_count("order"),
    "category_pay_count": _kind_count("pay"),
    "category_counts": "SELECT category_id, click_count, order_count, pay_count FROM task_totals WHERE task_id = 1",
    "distinct_categories": "SELECT DISTINCT category_id FROM filtered_events WHERE task_id = 1",
    "salted_category_count": _kind_count("click"),
    "top10_category": f"{_TOP_CATEGORY} WHERE task_id = 1",
    "category_session_counts": "SELECT category_id, session_id, click_count FROM task_clicks WHERE task_id = 1",
    "top10_session": f"{_TOP_SESSION} WHERE task_id = 1",
    "top10_session_detail": """
      SELECT detail.*, t.category_id FROM detail
      JOIN task_top_sessions t ON detail.task_id = t.task_id AND detail.session_id = t.session_id
      WHERE detail.task_id = 1""",
    "delivered_actions": f"SELECT {_ACTION_TEXT} FROM all_actions",
    "maintained_stat": _stat("WHERE task_id = 1"),
    "maintained_sample": f"{_SAMPLE} WHERE task_id = 1",
    "maintained_sessions": """
      SELECT session_id, user_id, start_time, step_length, visit_length FROM task_filtered WHERE task_id = 4""",
    "rounds_top10_session": f"{_TOP_SESSION} WHERE task_id = 1",
    "multi_task_stat": _stat(""),
    "multi_task_sample": _SAMPLE,
    "multi_task_top10_category": _TOP_CATEGORY,
    "multi_task_top10_session": _TOP_SESSION,
}

# The tasks of the many-task queries are rows of the task table.
_FROM_TABLE = f"""
  SELECT task_id, CAST(start_date AS DATE), CAST(end_date AS DATE), CAST(start_age AS INTEGER), CAST(end_age AS INTEGER),
         string_split(professionals, ','), string_split(cities, ','), sex, string_split(keywords, ','),
         CAST(string_split(category_ids, ',') AS BIGINT[])
  FROM ({_TASK_TABLE}) WHERE task_id IN (1, 2, 3, 4)
"""
MANY_BASE = BASE.replace(_CONSTANT_TASKS, _FROM_TABLE)

ORACLE = {name: (MANY_BASE if name.startswith("multi_task") else BASE) + text for name, text in _ON_BASE.items()} | {
    "task_params": _TASK_TABLE,
    "task_by_id": f"SELECT * FROM ({_TASK_TABLE}) WHERE task_id = 7",
}
