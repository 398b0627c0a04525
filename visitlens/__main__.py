"""``spark-submit`` entry: ``python -m visitlens --task 1 --out hdfs://.../results``."""

from __future__ import annotations

import argparse
import sys

from visitlens.operators.sampling import DEFAULT_SEED, DEFAULT_TOTAL
from visitlens.plans.job import export_tables, publish_tasks, run_tasks
from visitlens.session import build_session
from visitlens.sources.tables import read_actions, read_tasks, read_users
from visitlens.sources.tasks import load_tasks


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="visitlens", description=__doc__)
    parser.add_argument("--task", type=int, nargs="+", required=True, help="task ids")
    parser.add_argument("--out", required=True, help="folder of the result tables")
    for name, default in (("actions", "user_visit_action"), ("users", "user_info"), ("tasks", "task")):
        parser.add_argument(f"--{name}", default=default, help="table name, or a path with --format")
    parser.add_argument("--format", default=None, help="file format of all three; default: catalog tables")
    parser.add_argument("--option", action="append", default=[], metavar="KEY=VALUE",
                        help="reader option of the files, such as header=true")
    parser.add_argument("--jdbc-url", default=None,
                        help="read the task table from this database, and append the results to it")
    parser.add_argument("--jdbc-option", action="append", default=[], metavar="KEY=VALUE", help="user, password, driver, ...")
    parser.add_argument("--work-folder", default=None,
                        help="shared folder for intermediate results if spark.checkpoint.dir is unset")
    parser.add_argument("--publish", action="store_true",
                        help="write a run of its own and switch all five tables to it at once")
    parser.add_argument("--total", type=int, default=DEFAULT_TOTAL, help="sessions to sample per task")
    parser.add_argument("--seed", type=int, default=DEFAULT_SEED)
    args = parser.parse_args(argv)

    spark = build_session()
    options = dict(option.split("=", 1) for option in args.option)
    jdbc = dict(option.split("=", 1) for option in args.jdbc_option)
    if args.jdbc_url:
        task_table = read_tasks(spark, args.tasks, "jdbc", url=args.jdbc_url, **jdbc)
    else:
        task_table = read_tasks(spark, args.tasks, args.format, **options)
    bad: dict[int, str] = {}
    tasks = load_tasks(task_table, args.task, bad)
    if tasks:
        (publish_tasks if args.publish else run_tasks)(
            spark,
            read_actions(spark, args.actions, args.format, **options),
            read_users(spark, args.users, args.format, **options),
            tasks, args.out, args.total, args.seed, args.work_folder,
        )
        if args.jdbc_url:
            export_tables(spark, args.out, [t.task_id for t in tasks], args.jdbc_url, args.publish, **jdbc)
    if bad:
        sys.exit("".join(f"task {i} has unreadable parameters and was not run: {why}\n" for i, why in bad.items()))


if __name__ == "__main__":
    main()
