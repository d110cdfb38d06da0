"""Input scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_lines(
    spark: SparkSession, path: str | list[str], line_sep: str | None = None, tasks: int | None = None
) -> DataFrame:
    """One row `value` per line of a UTF-8 text file, directory or glob.

    A file can be split between tasks only where a line ends. Lines need not be what the
    file has as lines: any separator character, such as a space, gives the same tokens.
    """
    reader = spark.read if line_sep is None else spark.read.option("lineSep", line_sep)
    return _dealt(reader.text(path), tasks)


def read_text_table(
    spark: SparkSession, path: str, columns: Sequence[str], tasks: int | None = None
) -> DataFrame:
    """The named columns of a parquet table of texts."""
    return _dealt(spark.read.parquet(path).select(*columns), tasks)


def _dealt(scan: DataFrame, tasks: int | None) -> DataFrame:
    """The scan as it lies, or its rows dealt out to `tasks` tasks.

    Only a caller who knows that the input is tiny and in one split should ask for that: it
    moves the text.
    """
    return scan if tasks is None else scan.repartition(tasks)
