"""Run every query on Spark and its twin on DuckDB and compare whole results.

``python -m checks.compare [sf_dir] [query ...]``
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

from checks.oracle import ORACLE
from checks.queries import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def difference(df, relation) -> str | None:
    """None when both hold the same columns and the same rows, in any order."""
    names = sorted(df.columns)
    if names != sorted(relation.columns):
        return f"columns {names} vs {sorted(relation.columns)}"
    left = Counter(tuple(row[n] for n in names) for row in df.collect())
    order = [relation.columns.index(n) for n in names]
    right = Counter(tuple(row[i] for i in order) for row in relation.fetchall())
    if left == right:
        return None
    return (f"{sum(left.values())} vs {sum(right.values())} rows; only left {list((left - right).items())[:3]}; "
            f"only right {list((right - left).items())[:3]}")


def main(argv: list[str]) -> int:
    from visitlens.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = build_session("compare", **{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8",
                                        "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = 0
    for name in names:
        began = time.time()
        df = QUERIES[name](spark, sf_dir)
        problem = difference(df, con.sql(ORACLE[name]))
        failed += problem is not None
        print(f"{name:28s} {time.time() - began:6.2f}s {'ok ' + str(df.count()) if problem is None else 'FAIL ' + problem}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
