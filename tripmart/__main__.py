"""Command line of the jobs, for ``spark-submit`` or ``python -m tripmart``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tripmart.config import KpiSink, default_sources
from tripmart.plans.full_run import run_all
from tripmart.plans.gold import run_gold
from tripmart.plans.silver import run_silver, run_silver_by_month, run_zone_layout
from tripmart.plans.study import run_profile, run_views
from tripmart.plans.training import run_training
from tripmart.sinks.snapshots import expire, manifest, versions
from tripmart.sources.landing import land
from tripmart.streaming.landing import land_new


def _sink(args: argparse.Namespace) -> KpiSink:
    if args.sink == "mongodb":
        return KpiSink.mongodb_from_env()
    if args.sink == "table":
        return KpiSink(kind="table", database=args.out)
    return KpiSink(kind=args.sink, path=args.out, versioned=args.versioned)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tripmart")
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("land", help="copy the raw files of all sources")
    job.add_argument("raw")
    job.add_argument("bronze")
    job.add_argument("--log", help="folder that keeps which files are landed; land only the others")
    job = jobs.add_parser("silver", help="clean raw trips")
    job.add_argument("bronze")
    job.add_argument("silver")
    job.add_argument("--only-months", action="store_true", help="replace only months that occur")
    job.add_argument("--month", action="append", help="clean just this month, as 2024-03")
    job = jobs.add_parser("gold", help="compute all KPI tables")
    job.add_argument("silver")
    job.add_argument("out", nargs="?")
    job.add_argument("--sink", default="parquet", choices=("parquet", "json", "table", "mongodb"))
    job.add_argument("--cells", help="folder that keeps the sums and counts of each month")
    job.add_argument("--month", action="append", help="refresh just this month of the cells")
    job.add_argument("--versioned", action="store_true", help="publish all tables together")
    job = jobs.add_parser("versions", help="list the versions of a clean or KPI table")
    job.add_argument("table")
    job = jobs.add_parser("expire", help="delete old versions and their files")
    job.add_argument("table")
    job.add_argument("--keep", type=int, default=2)
    job = jobs.add_parser("zones", help="lay the clean table out by zone, for lookups")
    job.add_argument("silver")
    job.add_argument("--month", action="append", help="only this month, as 2024-03")
    job = jobs.add_parser("profile", help="write the tables of the exploratory study")
    job.add_argument("silver")
    job.add_argument("out")
    job.add_argument("--sink", default="parquet", choices=("parquet", "json"))
    job = jobs.add_parser("views", help="write the presentation tables of the KPI tables")
    job.add_argument("gold")
    job.add_argument("out")
    job.add_argument("--sink", default="parquet", choices=("parquet", "json"))
    job.add_argument("--versioned", action="store_true", help="the KPI tables were published together")
    job = jobs.add_parser("train", help="train and save the price model")
    job.add_argument("silver")
    job.add_argument("model")
    job.add_argument("--target-coded", action="store_true", help="code zones by their mean price")
    job = jobs.add_parser("all", help="all jobs in order")
    job.add_argument("raw")
    job.add_argument("lake")

    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"tripmart-{args.job}").getOrCreate()
    named = getattr(args, "month", None) or []
    months = [tuple(map(int, month.split("-"))) for month in named] or None
    if args.job == "land" and args.log:
        print(land_new(spark, default_sources(args.raw), args.bronze, args.log))
    elif args.job == "land":
        print(land(spark, default_sources(args.raw), args.bronze))
    elif args.job == "silver" and months:
        print(run_silver_by_month(spark, args.bronze, args.silver, months))
    elif args.job == "silver":
        print(run_silver(spark, args.bronze, args.silver, replace_all=not args.only_months))
    elif args.job == "gold":
        print(run_gold(spark, args.silver, _sink(args), months, args.cells))
    elif args.job == "zones":
        print(run_zone_layout(spark, args.silver, months))
    elif args.job == "profile":
        print(run_profile(spark, args.silver, KpiSink(kind=args.sink, path=args.out)))
    elif args.job == "views":
        gold = KpiSink(path=args.gold, versioned=args.versioned)
        print(run_views(spark, gold, KpiSink(kind=args.sink, path=args.out)))
    elif args.job == "versions":
        for version in versions(spark, args.table):
            rows = manifest(spark, args.table, version).agg(F.sum("nb_rows")).first()[0]
            print(version, rows or 0)
    elif args.job == "expire":
        print(expire(spark, args.table, args.keep))
    elif args.job == "train":
        training = run_training(spark, args.silver, args.model, args.target_coded)
        training.comparison.show(truncate=False)
        print(training.best)
    else:
        result = run_all(spark, args.raw, args.lake)
        print(result.landed, result.silver, result.kpis, result.training.best)


if __name__ == "__main__":
    main()
