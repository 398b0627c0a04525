"""Column names of the input tables and of the five result tables."""

from __future__ import annotations

# Names and order of the input columns.
ACTION_COLUMNS = {
    "date": "date",
    "user_id": "bigint",
    "session_id": "string",
    "page_id": "bigint",
    "action_time": "timestamp",
    "search_keyword": "string",
    "click_category_id": "bigint",
    "click_product_id": "bigint",
    "order_category_ids": "string",
    "order_product_ids": "string",
    "pay_category_ids": "string",
    "pay_product_ids": "string",
}

USER_COLUMNS = {
    "user_id": "bigint",
    "username": "string",
    "name": "string",
    "age": "int",
    "professional": "string",
    "city": "string",
    "sex": "string",
}

TASK_COLUMNS = {
    "task_id": "bigint",
    "task_name": "string",
    "create_time": "string",
    "start_time": "string",
    "finish_time": "string",
    "task_type": "string",
    "task_status": "string",
    "task_param": "string",
}

# Length buckets, both ends inclusive, seconds and actions. A session of 0 seconds
# belongs to no visit bucket.
VISIT_BUCKETS = (
    ("visit_length_1s_3s", 1, 3),
    ("visit_length_4s_6s", 4, 6),
    ("visit_length_7s_9s", 7, 9),
    ("visit_length_10s_30s", 10, 30),
    ("visit_length_30s_60s", 31, 60),
    ("visit_length_1m_3m", 61, 180),
    ("visit_length_3m_10m", 181, 600),
    ("visit_length_10m_30m", 601, 1800),
    ("visit_length_30m", 1801, None),
)
STEP_BUCKETS = (
    ("step_length_1_3", 1, 3),
    ("step_length_4_6", 4, 6),
    ("step_length_7_9", 7, 9),
    ("step_length_10_30", 10, 30),
    ("step_length_30_60", 31, 60),
    ("step_length_60", 61, None),
)

# Column order of the result tables.
STAT_COLUMNS = ["task_id", "session_count"] + [
    f"{name}_ratio" for name, _, _ in VISIT_BUCKETS + STEP_BUCKETS
]
SAMPLE_COLUMNS = ["task_id", "session_id", "start_time", "search_keywords", "click_category_ids"]
TOP_CATEGORY_COLUMNS = ["task_id", "category_id", "click_count", "order_count", "pay_count"]
TOP_SESSION_COLUMNS = ["task_id", "category_id", "session_id", "click_count"]
DETAIL_COLUMNS = ["task_id"] + [c for c in ACTION_COLUMNS if c != "date"]
# ``session_detail`` holds two kinds of rows; these columns tell them apart.
DETAIL_TAGS = ["origin", "for_category_id"]
