"""Command line: `python -m tickloom <job> ...`; use spark-submit on a cluster."""

from __future__ import annotations

import argparse

from tickloom import schema
from tickloom.operators.models import board_text
from tickloom.operators.quality import series_quality
from tickloom.plans.collection import run_collection
from tickloom.plans.classification import run_classification
from tickloom.plans.database import run_database_setup
from tickloom.plans.forecasting import run_forecasting
from tickloom.plans.preprocessing import run_preprocessing
from tickloom.session import build_session, scratch_scope
from tickloom.sources.readers import LAYOUTS, read_bar_files, read_serving


def parse(arguments=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tickloom", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    job = jobs.add_parser("check", help="quality report of CSV bars")
    job.add_argument("bars")
    job = jobs.add_parser("collect", help="vendor CSV tables to bars in folders, and their quality")
    job.add_argument("bars", help="where the bars go")
    job.add_argument("vendor", nargs="+", help="TICKER=path of a CSV table with a header")
    job = jobs.add_parser("preprocess", help="CSV bars to a Parquet feature table")
    job.add_argument("bars")
    job.add_argument("features")
    job.add_argument("--layout", choices=sorted(LAYOUTS), default="files")
    job = jobs.add_parser("load", help="feature table to the SQL table")
    job.add_argument("features")
    job.add_argument("--table", default=schema.SERVING_TABLE)
    job.add_argument("--ticker", default=schema.DEFAULT_TICKERS[0], help="whose latest rows to show")
    job = jobs.add_parser("forecast", help="train forecasters and forecast by drift")
    job.add_argument("features")
    job.add_argument("--models")
    job.add_argument("--pooled", action="store_true", help="one model for all series")
    job = jobs.add_parser("classify", help="train the grade classifier and grade every series")
    source = job.add_mutually_exclusive_group()
    source.add_argument("--table", default=schema.SERVING_TABLE)
    source.add_argument("--features", help="the Parquet feature table instead of the SQL table")
    job.add_argument("--model")
    return parser.parse_args(arguments)


def main(arguments=None) -> None:
    options = parse(arguments)
    spark = build_session()
    with scratch_scope(spark):
        run(spark, options)


def run(spark, options: argparse.Namespace) -> None:
    if options.job == "check":
        series_quality(read_bar_files(spark, options.bars)).show(truncate=False)
    elif options.job == "preprocess":
        run_preprocessing(spark, options.bars, options.features, layout=options.layout).show(5)
    elif options.job == "collect":
        paths = dict(pair.split("=", 1) for pair in options.vendor)
        frames = {ticker: spark.read.csv(path, header=True, inferSchema=True) for ticker, path in paths.items()}
        run_collection(spark, frames, options.bars).show(truncate=False)
    elif options.job == "load":
        rows, head = run_database_setup(spark, options.features, options.table, options.ticker)
        print(f"{rows} rows in {options.table}")
        head.show()
    elif options.job == "forecast":
        for frame in run_forecasting(spark, options.features, options.models, options.pooled):
            frame.show()
    else:
        serving = read_serving(spark, options.features) if options.features else spark.table(options.table)
        done = run_classification(serving, options.model)
        for frame in (done.grade_counts, done.accuracy, done.report, board_text(done.board)):
            frame.show()


if __name__ == "__main__":
    main()
