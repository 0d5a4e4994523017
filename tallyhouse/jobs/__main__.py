"""``python -m tallyhouse.jobs refresh|sellout|segments …``; every path may be a folder the cluster can reach."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from tallyhouse import rules
from tallyhouse.jobs import runs
from tallyhouse.session import build_session, scratch_run
from tallyhouse.sources import catalog, readers


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="tallyhouse.jobs", description=__doc__)
    jobs = root.add_subparsers(dest="job", required=True)

    refresh = jobs.add_parser("refresh", help="sales, customers, weekly counts and costs")
    refresh.add_argument("--history", required=True)
    for name in ("new", "customers", "costs-history", "costs-new", "family"):
        refresh.add_argument(f"--{name}")
    refresh.add_argument("--cutoff", default=rules.SALES_CUTOFF)
    refresh.add_argument(
        "--append", action=argparse.BooleanOptionalAction, default=True,
        help="add the new sales to the history's folder (default), or write a new version of the whole table",
    )
    refresh.add_argument("--cost-year", type=int, default=rules.COST_YEAR)
    refresh.add_argument("--drop-later-years", action="store_true", help="leave out costs of years after --cost-year")

    sellout = jobs.add_parser("sellout", help="the reports of the three retailers")
    sellout.add_argument("--history", required=True)
    sellout.add_argument("--cities")
    sellout.add_argument("--folder", required=True)
    for name in ("chain", "wholesale", "pharmacy"):
        sellout.add_argument(f"--{name}", help="file name in the folder; if none is given, the newest file of each retailer")

    segments = jobs.add_parser("segments", help="customer segments per channel")
    segments.add_argument("--sales", required=True)
    segments.add_argument("--customers", required=True)
    segments.add_argument("--as-of", help="date, today if not given")
    segments.add_argument("--channel", action="append", help="repeat for each; the default list if not given")
    segments.add_argument("--all-customer-rows", action="store_true", help="keep every row of a tax id in the register")
    segments.add_argument("--on-ties", choices=("compare", "error"), default="compare")

    for job in (refresh, sellout, segments):
        job.add_argument("--sep", default=",", help="separator of delimited files")
        job.add_argument("--encoding", default="UTF-8")
        job.add_argument("--date-format", action="append", help="repeat for each; ISO if not given")
        job.add_argument("--line-breaks", action="store_true", help="quoted cells may hold line breaks")
        job.add_argument("--out", required=True, help="a new folder for the results")
    return root


def dialect_of(args: argparse.Namespace) -> readers.Dialect:
    formats = tuple(args.date_format) if args.date_format else readers.PLAIN.date_formats
    return readers.Dialect(args.sep, args.encoding, formats, args.line_breaks)


def run(spark: SparkSession, args: argparse.Namespace) -> dict:
    dialect = dialect_of(args)
    if args.job == "refresh":
        inputs = (args.history, args.new, args.customers, args.costs_history, args.costs_new, args.family)
        tables = catalog.load_sales_tables(spark, *inputs, dialect=dialect)
        # a delimited file cannot grow by versions: it becomes a new table
        append_to = args.history if args.append and not args.history.lower().endswith(readers.TEXT_ENDINGS) else None
        return runs.refresh_all(tables, args.out, args.cutoff, args.cost_year, inputs, append_to, args.drop_later_years)
    if args.job == "sellout":
        files = dict(zip((key for key, _ in rules.RETAILERS), (args.chain, args.wholesale, args.pharmacy)))
        if not any(files.values()):
            files = catalog.newest_reports(spark, args.folder)
        tables = catalog.load_sellout_tables(spark, args.history, args.cities, args.folder, files, dialect)
        return runs.consolidate_sellout(tables, args.out, (args.history, args.cities))
    sales, customers = (readers.read_table(spark, path, dialect=dialect) for path in (args.sales, args.customers))
    channels = tuple(args.channel) if args.channel else rules.CHANNELS
    return runs.segment_customers(
        sales, customers, args.out, args.as_of, channels, (args.sales, args.customers), dialect.date_formats,
        not args.all_customer_rows, args.on_ties,
    )


def main(arguments: list[str] | None = None) -> dict:
    args = parser().parse_args(arguments)
    spark = build_session(f"tallyhouse {args.job}")
    with scratch_run(spark):
        result = run(spark, args)
    print(json.dumps(result, default=str, ensure_ascii=False))
    return result


if __name__ == "__main__":
    main()
