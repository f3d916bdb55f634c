"""Command line: ``python -m searchtide report|months|day ...``."""

import argparse
import importlib

from pyspark.sql import SparkSession

from searchtide.functions.rules import KNOWN_KEYWORDS
from searchtide.plans import daily, reports
from searchtide.schema import CLASSIFIED
from searchtide.sources.parquet_log import read_log
from searchtide.sources.tables import read_csv


def _function(name: str):
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def _preparing(command: argparse.ArgumentParser) -> None:
    command.add_argument("--clean", action="store_true", help="drop null and blank keywords first")
    command.add_argument(
        "--normalize", action="store_true", help="put keywords into their plain form first"
    )
    command.add_argument("--year", type=int, help="searches of one year only")


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="searchtide")
    commands = parser.add_subparsers(dest="command", required=True)
    report = commands.add_parser("report", help="all reports of a log")
    report.add_argument("log")
    report.add_argument("out")
    report.add_argument("--months", type=int, nargs=2, default=list(reports.MONTHS))
    _preparing(report)
    report.add_argument("--store", help="folder of counts to go on from: files counted there are not read again")
    report.add_argument("--fold", action="store_true", help="count the spellings of a keyword as one")
    report.add_argument("--top", type=int, help="classify the first rows only, not every keyword")
    report.add_argument("--names", help="CSV table of keywords and their categories")
    report.add_argument("--inside", action="store_true", help="look for the names inside of keywords too")
    report.add_argument(
        "--nearest", action="store_true", help="give keywords left over the category they are most like"
    )
    report.add_argument("--allow-missing", action="store_true", help="take a missing log for an empty one")
    report.add_argument(
        "--classifier", type=_function, help="module:function from keywords to a reply"
    )
    months = commands.add_parser("months", help="top keywords per user and month, in long form")
    months.add_argument("log")
    months.add_argument("out")
    months.add_argument("--top", type=int, default=3)
    _preparing(months)
    day = commands.add_parser("day", help="a look at one day's folder")
    day.add_argument("log")
    day.add_argument("day")
    day.add_argument("out")
    given = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("searchtide").getOrCreate()
    if given.command == "day":
        reports.day_report(spark, given.log, given.day, given.out)
        return
    prepared = {"clean": given.clean, "normalize": given.normalize, "year": given.year}
    if given.command == "months":
        reports.top_per_month(read_log(spark, given.log), given.out, given.top, **prepared)
        return
    kept = daily.update(spark, given.log, given.store, given.months, **prepared) if given.store else None
    names = read_csv(spark, given.names, CLASSIFIED) if given.names else KNOWN_KEYWORDS
    reports.search_report(
        spark,
        given.log,
        given.out,
        months=given.months,
        classifier=given.classifier,
        names=names,
        top=given.top,
        allow_missing=given.allow_missing,
        counting=prepared | {"fold": given.fold},
        counts=kept,
        inside=given.inside,
        nearest=given.nearest,
    )


if __name__ == "__main__":
    main()
