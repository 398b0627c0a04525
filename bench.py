"""Time the registered queries; prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1), ``BENCH_CPUS`` (default 8). Each query runs once to warm up and is
then timed once, from building the plan to the last row.
"""

from __future__ import annotations

import json
import os
import time

from checks.queries import QUERIES
from visitlens.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def run(spark, name: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    spark = build_session("bench", **{
        "spark.master": f"local[{CPUS}]",
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    for name in QUERIES:
        run(spark, name)
    seconds = {name: round(run(spark, name), 3) for name in QUERIES}
    print(json.dumps({
        "metric": "session_analytics_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
