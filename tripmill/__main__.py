"""Command line of the batch steps.

    python -m tripmill ingest   --raw ROOT --out TRIPS [--taxi yellow --start 2023-01 --end 2023-12]
    python -m tripmill backfill --raw ROOT --out TRIPS --start 2022-01 --end 2023-12
    python -m tripmill build    --trips TRIPS --root WAREHOUSE
    python -m tripmill check    --trips TRIPS --root WAREHOUSE
"""

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tripmill.plans import quality, views
from tripmill.plans.build import build, reopen
from tripmill.plans.catalog import publish
from tripmill.schema import TRIPS
from tripmill.session import build_session
from tripmill.sinks.backfill import backfill, create_table
from tripmill.sinks.tables import read_table, save_by_day, write_by_day, write_files
from tripmill.sources.files import read_trips
from tripmill.sources.months import MONTH_FILE, check_taxi, select_months
from tripmill.sources.samples import first_trips, sample_trips


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tripmill")
    steps = parser.add_subparsers(dest="step", required=True)

    ingest = steps.add_parser("ingest", help="raw files to canonical trips")
    load = steps.add_parser("backfill", help="raw files to canonical trips, month by month")
    for step in (ingest, load):
        step.add_argument("--raw", required=True, help="folder of raw files")
        step.add_argument("--out", required=step is load, help="folder of canonical trips")
        step.add_argument("--table", help="catalog table: written by ingest instead of --out, declared over it by backfill")
        step.add_argument("--taxi", type=check_taxi, default="yellow" if step is load else None)
        step.add_argument("--pattern", default=MONTH_FILE, help="name of a monthly file or folder")
        step.add_argument("--start", required=step is load, help="first month, YYYY-MM")
        step.add_argument("--end", required=step is load, help="last month, YYYY-MM")
    ingest.add_argument("--sample-rows", type=int, help="cap, shared evenly by the files")
    ingest.add_argument("--max-trips", type=int, help="cap on clean trips, from as few files as hold them")
    ingest.add_argument("--files", type=int, help="number of output files")
    ingest.add_argument("--by-day", action="store_true", help="one folder per day, clustered")
    load.add_argument("--keep", action="store_true", help="keep months loaded earlier")

    make = steps.add_parser("build", help="models and views, then checks")
    check = steps.add_parser("check", help="checks over a finished build")
    for step in (make, check):
        step.add_argument("--trips", required=True, help="folder of canonical trips")
        step.add_argument("--root", required=True, help="folder of the warehouse")
        step.add_argument("--database", help="also declare tables and views in this catalog database")
        step.add_argument("--from-date", type=dt.date.fromisoformat, default=views.DEFAULT_START)
        step.add_argument("--to-date", type=dt.date.fromisoformat, default=views.DEFAULT_END)
    args = parser.parse_args(argv)
    if args.step == "ingest" and bool(args.out) == bool(args.table):
        parser.error("ingest needs either --out or --table")
    return args


def input_files(spark: SparkSession, args: argparse.Namespace) -> list[str]:
    """Files of the chosen taxi type and months, or the raw folder, whose files are all read."""
    if args.taxi or args.start or args.end:
        taxi = args.taxi or "yellow"
        months = select_months(
            spark, args.raw, taxi, args.start or "0000-01", args.end or "9999-12", args.pattern
        )
        return sorted(file for files in months.values() for file in files)
    return [args.raw]


def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    files = input_files(spark, args)
    if args.sample_rows:
        trips = sample_trips(spark, files, args.sample_rows)
    elif args.max_trips:
        trips = first_trips(spark, files, args.max_trips)
    else:
        trips = read_trips(spark, files)
    if args.table:
        rows = save_by_day(trips, args.table)
    elif args.by_day:
        rows = write_by_day(trips, args.out)
    else:
        rows = write_files(trips, args.out, args.files)
    print(f"{rows} trips written to {args.table or args.out}")


def load(spark: SparkSession, args: argparse.Namespace) -> None:
    months = select_months(spark, args.raw, args.taxi, args.start, args.end, args.pattern)
    counts = backfill(spark, months, args.out, fresh=not args.keep).orderBy("source_month").collect()
    for row in counts:
        print(f"{row.source_month}: {row.inserted_rows} inserted, {row.stored_rows} stored")
    inserted, stored = sum(r.inserted_rows for r in counts), sum(r.stored_rows for r in counts)
    print(f"total: {inserted} inserted, {stored} stored")
    wrong = [r.source_month for r in counts if r.inserted_rows != r.stored_rows]
    if wrong:
        raise RuntimeError(f"stored rows differ from inserted ones in {', '.join(wrong)}")
    if args.table:
        create_table(spark, args.table, args.out, None if args.keep else list(months))


def report(tables: dict[str, DataFrame]) -> None:
    """Print the quality report and fail on errors."""
    lines = quality.quality_report(tables).orderBy("model", "check_name", "target").collect()
    for row in lines:
        print(f"{row.status:5s} {row.model}.{row.target} {row.check_name}: {row.failing_rows}")
    quality.enforce(lines)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = build_session()
    if args.step == "ingest":
        ingest(spark, args)
    elif args.step == "backfill":
        load(spark, args)
    else:
        trips = read_table(spark, args.trips, TRIPS)
        span = (args.from_date, args.to_date)
        if args.step == "build":
            house = build(spark, trips, args.root, *span)
        else:
            house = reopen(spark, trips, args.root, *span)
        if args.database:
            publish(house, args.database, *span)
        report(house.tables)


if __name__ == "__main__":
    main()
