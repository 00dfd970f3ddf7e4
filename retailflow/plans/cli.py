"""Command line of the day loads.

Give this file to spark-submit, with the package in --py-files:

    cli.py lakehouse --table-name orders --date-cursor 2017-01-01 --root ROOT --test --ingest
    cli.py warehouse --table-name orders --date-cursor 2017-01-01 --root ROOT --ingest
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from retailflow.model import DIMENSIONS, FACTS, TABLES
from retailflow.plans import lake as lakes
from retailflow.sinks.tables import refresh_table


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="retailflow")
    jobs = top.add_subparsers(dest="job", required=True)
    for job, names in (("lakehouse", FACTS), ("warehouse", TABLES)):
        args = jobs.add_parser(job)
        args.add_argument("--table-name", required=True, choices=list(names))
        args.add_argument("--date-cursor", default="")
        args.add_argument("--root", required=True)
        args.add_argument("--ingest", action="store_true")
        if job == "lakehouse":
            args.add_argument("--test", action="store_true")
            args.add_argument("--profile", action="store_true")
    return top


def run(spark: SparkSession, argv: list[str]) -> int:
    """Run one job; returns the number of rows (or tables, for the warehouse) loaded."""
    args = parser().parse_args(argv)
    lake, name = lakes.Lake(args.root), args.table_name
    if args.job == "lakehouse":
        return lakes.lakehouse_day(
            spark, lake, name, args.date_cursor, args.test, args.ingest, args.profile
        )
    if not args.ingest:
        return 0
    if name in DIMENSIONS:
        return int(refresh_table(spark.read.parquet(lake.table(name)), lake.warehouse(name)))
    return int(lakes.warehouse_day(spark, lake, name, args.date_cursor))


def main() -> None:
    spark = SparkSession.builder.appName("retailflow").getOrCreate()
    try:
        run(spark, sys.argv[1:])
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
