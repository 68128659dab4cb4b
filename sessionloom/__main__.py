"""Run a job: ``spark-submit … sessionloom/__main__.py sessions 1 --url jdbc:… --output …``.

Database user and password are read from the file named by ``--credentials``, a JSON object
of JDBC connection properties; they are never taken from the command line.
"""

from __future__ import annotations

import argparse
import json
from pathlib import Path

from pyspark.sql import SparkSession

from sessionloom.params import task_id_from_args
from sessionloom.plans.products import run_product_job
from sessionloom.plans.sessions import run_session_job


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="sessionloom")
    parser.add_argument("job", choices=["sessions", "products"])
    parser.add_argument("task_id")
    parser.add_argument("--url", required=True, help="JDBC address of task and result tables")
    parser.add_argument("--credentials", help="JSON file of JDBC connection properties")
    parser.add_argument("--output", help="folder for the detail records (sessions only)")
    args = parser.parse_args(argv)
    task_id = task_id_from_args([args.task_id])
    properties = json.loads(Path(args.credentials).read_text()) if args.credentials else {}
    if args.job == "sessions" and not args.output:
        parser.error("sessions needs --output")

    builder = SparkSession.builder.appName(f"sessionloom-{args.job}-{task_id}")
    spark = builder.enableHiveSupport().getOrCreate()
    if args.job == "sessions":
        run_session_job(spark, task_id, args.url, args.output, properties)
    else:
        run_product_job(spark, task_id, args.url, properties)


if __name__ == "__main__":
    main()
