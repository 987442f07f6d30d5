"""Command line: one run of the job, the way it is scheduled.

    spark-submit --py-files adlift.zip adlift/__main__.py --start-date 2024-10-01 --end-date 2024-10-03 \\
        --sales retail.sales --placements ads.placements \\
        --jdbc-url jdbc:postgresql://host/db --jdbc-user u --jdbc-password-env DB_PASSWORD \\
        --output s3://bucket/daily_ad_conversions/

Dimensions come from JDBC (tables categories, campaigns, organizations, locations,
ad_groups, ads) or, with ``--dimension name=table_or_path``, from the catalog or
files. Prints the observed counts as one JSON line.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys

from pyspark.sql import SparkSession

from adlift.config import RunConfig
from adlift.plans.backfill import backfill
from adlift.plans.daily import run
from adlift.session import configure
from adlift.sources.bundle import DIMENSIONS
from adlift.sources.catalog import from_catalog
from adlift.sources.versions import combined, file_versions


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="adlift", description="Daily time-based ad attribution with incremental lift.")
    p.add_argument("--start-date", required=True, help="first day, yyyy-MM-dd (inclusive)")
    p.add_argument("--end-date", required=True, help="last day, yyyy-MM-dd (inclusive)")
    p.add_argument("--sales", required=True, help="sales table name or path (partitioned by year/month/day)")
    p.add_argument("--placements", required=True, help="placements table name or path (partitioned by year/month/day)")
    p.add_argument("--output", required=True, help="output folder for the partitioned Parquet")
    p.add_argument("--dimension", action="append", default=[], metavar="NAME=TABLE",
                   help="a dimension from a table or path instead of JDBC (repeatable)")
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-user")
    p.add_argument("--jdbc-password-env", help="name of the environment variable holding the password")
    p.add_argument("--jdbc-driver", help="class name of the JDBC driver")
    p.add_argument("--jdbc-fetch-size", type=int, default=10_000)
    p.add_argument("--jdbc-partition", action="append", default=[], metavar="NAME=COLUMN,LOWER,UPPER,N",
                   help="read a dimension in N parts split by a numeric column (repeatable)")
    p.add_argument("--lookback-days", type=int, default=60)
    p.add_argument("--grace-seconds", type=int, default=7200)
    p.add_argument("--sales-date-source", choices=("parts", "timestamp"), default="parts")
    p.add_argument("--sale-time-format", choices=("epoch", "text"), default="epoch")
    p.add_argument("--column-owner", action="append", default=[], metavar="COLUMN=TABLE",
                   help="the table an output column is taken from where several have it (repeatable)")
    p.add_argument("--backfill", metavar="HISTORY",
                   help="run only the days that changed inputs reach; HISTORY: folder of the kept history")
    p.add_argument("--versions", choices=("files", "content"), default="content",
                   help="how a backfill tells changed days: by the day folders' files (sales and placements are paths, "
                        "stored by their own day) or by reading the rows")
    p.add_argument("--write-mode", choices=("overwrite", "append"), default="overwrite")
    return p.parse_args(argv)


def jdbc_read(args: argparse.Namespace) -> dict[str, dict]:
    """Per dimension, how it is read over JDBC."""
    out = {name: {"fetch_size": args.jdbc_fetch_size} for name in DIMENSIONS}
    for spec in args.jdbc_partition:
        name, _, split = spec.partition("=")
        column, lower, upper, n = split.split(",")
        out[name] |= {"partition_column": column, "lower": int(lower), "upper": int(upper), "partitions": int(n)}
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = parse_args(sys.argv[1:] if argv is None else argv)
    spark = configure(spark or SparkSession.builder.appName("adlift").getOrCreate())
    cfg = RunConfig(
        start=args.start_date, end=args.end_date, lookback_days=args.lookback_days,
        grace_seconds=args.grace_seconds, sales_date_source=args.sales_date_source,
        sale_time_format=args.sale_time_format, write_mode=args.write_mode,
        column_owners=dict(o.split("=", 1) for o in args.column_owner),
    )
    dims = dict(d.split("=", 1) for d in args.dimension)
    props = {}
    if args.jdbc_user:
        props["user"] = args.jdbc_user
    if args.jdbc_driver:
        props["driver"] = args.jdbc_driver
    if args.jdbc_password_env:
        props["password"] = os.environ.get(args.jdbc_password_env, "")
    sources = from_catalog(spark, args.sales, args.placements, dims or None, args.jdbc_url, props, jdbc_read(args))
    if args.backfill:
        versions = None
        if args.versions == "files":
            days = [cfg.read_start + dt.timedelta(days=i) for i in range((cfg.end - cfg.read_start).days + 1)]
            versions = combined(*[file_versions(spark, root, days) for root in (args.sales, args.placements)])
        result = backfill(spark, sources, cfg, args.output, args.backfill, versions)
    else:
        result = run(spark, sources, cfg, args.output)
    print(json.dumps(result, default=str))
    return result
