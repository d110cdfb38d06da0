"""`python -m lexiband -i INPUT [-o OUT_DIR]`: write the word and letter report."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from lexiband.plans.report import write_report
from lexiband.session import build_session


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="lexiband", description="Word and letter bands of text files.")
    parser.add_argument("-i", dest="source", required=True, help="text file, directory or glob")
    parser.add_argument("-o", dest="out_dir", default=".", help="folder of the two outputs")
    return parser.parse_args(argv)


def run(spark: SparkSession, argv: list[str] | None = None) -> tuple[str, str]:
    """The job in a given session; returns the paths of the two outputs."""
    given = arguments(argv)
    return write_report(spark, given.source, given.out_dir)


def main(argv: list[str] | None = None) -> None:
    arguments(argv)  # what is wrong with them is said before Spark starts
    spark = build_session()
    try:
        run(spark, argv)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
