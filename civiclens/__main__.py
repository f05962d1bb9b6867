"""Command line: the query families over the published files.

    spark-submit --py-files civiclens.zip civiclens/__main__.py share --crimes a.csv b.csv
    python -m civiclens income --blocks blocks.geojson --income income.csv --strategy MERGE
"""

import argparse
import time

from pyspark.sql import DataFrame, SparkSession

from civiclens import contracts
from civiclens.operators.joins import STRATEGIES
from civiclens.operators.nearest import METHODS, nearest_summary
from civiclens.operators.profile import dataset_profile
from civiclens.plans import families
from civiclens.scratch import clear
from civiclens.sources.readers import read_csv
from civiclens.sources.writers import csv_to_parquet, features_to_parquet, write_rows

LABELS = {"en": contracts.DAY_PART_LABELS, "el": contracts.DAY_PART_LABELS_GREEK}


def share(spark, args) -> DataFrame:
    crimes = families.load_crimes(spark, args.crimes, args.format)
    return families.day_part_share(
        crimes, args.place, strict=args.strict, udf=args.udf, labels=LABELS[args.labels]
    )


def months(spark, args) -> DataFrame:
    crimes = families.load_crimes(spark, args.crimes, args.format)
    return families.top_months_sql(crimes) if args.sql else families.top_months(crimes)


def income(spark, args) -> DataFrame:
    return families.per_capita(
        families.load_blocks(spark, args.blocks, strict=args.strict),
        families.load_income(spark, args.income, strict=args.strict),
        args.strategy,
        strict=args.strict,
    )


def nearest(spark, args) -> DataFrame:
    points = families.known_locations(families.load_crimes(spark, args.crimes, args.format))
    stations = families.load_stations(spark, args.stations)
    summary = nearest_summary(points.select("lat", "lon"), stations, args.method, count="#")
    return summary.withColumnRenamed("site", "division")


def convert(spark, args) -> None:
    csv_to_parquet(spark, dict(zip(args.crimes, args.to, strict=True)))


def convert_features(spark, args) -> None:
    features_to_parquet(spark, args.blocks, args.to)


def profile(spark, args) -> DataFrame:
    return dataset_profile(read_csv(spark, args.path))


def preview(spark, args) -> DataFrame:
    return read_csv(spark, args.path).limit(5)


def timers(spark, args) -> DataFrame:
    return families.load_timers(spark, args.path)


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="civiclens")
    root.add_argument("--explain", action="store_true", help="print the physical plan first")
    commands = root.add_subparsers(dest="command", required=True)

    def command(run, rows: int, *options: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(run.__name__)
        sub.set_defaults(run=run)
        sub.add_argument("--rows", type=int, default=rows, help="rows to print")
        sub.add_argument("--out", help="folder for all rows of the result, instead of printing")
        sub.add_argument("--out-format", choices=("csv", "parquet"), default="csv")
        for option in options:
            sub.add_argument(option, required=True, nargs="+" if option == "--crimes" else None)
        if "--crimes" in options and run is not convert:
            sub.add_argument("--format", choices=("csv", "parquet"), default="csv")
        return sub

    sub = command(share, 20, "--crimes")
    sub.add_argument("--place", default=contracts.STREET)
    sub.add_argument("--labels", choices=sorted(LABELS), default="en")
    sub.add_argument("--strict", action="store_true", help="leave out crimes without a valid time")
    sub.add_argument("--udf", action="store_true", help="part of the day by a Python function")
    command(months, 50, "--crimes").add_argument("--sql", action="store_true")
    sub = command(income, 20, "--blocks", "--income")
    sub.add_argument("--strategy", choices=STRATEGIES[1:])
    sub.add_argument("--strict", action="store_true", help="missing counts are 0, no empty ZIP")
    command(nearest, 30, "--crimes", "--stations").add_argument("--method", choices=METHODS)
    command(convert, 0, "--crimes").add_argument("--to", required=True, nargs="+")
    command(convert_features, 0, "--blocks").add_argument("--to", required=True)
    command(profile, 1000, "--path")
    command(preview, 5, "--path")
    command(timers, 1000, "--path")
    return root


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"civiclens-{args.command}").getOrCreate()
    start = time.perf_counter()
    result = args.run(spark, args)
    if result is not None:
        if args.explain:
            result.explain("formatted")
        if args.out:
            write_rows(result, args.out, args.out_format)
        else:
            result.show(args.rows, truncate=False)
    clear(spark)
    print(f"[TIMER] {args.command}: {time.perf_counter() - start:.3f} s")


if __name__ == "__main__":
    main()
