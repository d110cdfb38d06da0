"""CSV scans and sinks, all with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_bands(bands: DataFrame, path: str) -> None:
    """Write a banded table with a header, replacing what is there.

    The part files hold the rows in rank order, as `with_rank` leaves them: no shuffle
    is needed and none of the tasks writes the whole. A small result is one file.
    """
    bands.write.mode("overwrite").option("header", True).csv(path)


def read_bands(spark: SparkSession, path: str, token: str) -> DataFrame:
    """Read back what `write_bands` wrote."""
    schema = f"rank BIGINT, {token} STRING, category STRING, frequency BIGINT"
    return spark.read.option("header", True).schema(schema).csv(path)


# The columns of a measurement file.
WORKERS, EXECUTION = "Workers", "Execution Time"
# Before a value in the name of its folder.
MARK = "v"


def execution_columns(repetitions: int = 3) -> list[str]:
    """Column names of the repetitions in a measurement file."""
    return [f"{EXECUTION} {i}" for i in range(1, repetitions + 1)]


def write_measurements(wide: DataFrame, path: str, key: str, repetitions: int = 3) -> None:
    """Write measurement files, those of each value of the column `key` in a folder of their own.

    One write, and no shuffle: a task writes a file for each value that it has, so that
    no value's rows go to one task. The folder's name has a mark before the value, which tells
    an empty value from a null one.
    """
    marked = wide.select(
        F.concat(F.lit(MARK), F.col(key).cast("string")).alias(key), WORKERS, *execution_columns(repetitions)
    )
    marked.write.partitionBy(key).option("header", True).option("lineSep", "\r\n").csv(path)


def read_measurements(
    spark: SparkSession, path: str | list[str], repetitions: int = 3, key: str = "file"
) -> DataFrame:
    """All measurement files under `path` in one scan, each row with the `file` it is from, or
    with the `folder` of the file if that is the key. Any other key is the one that
    `write_measurements` was given; its values come back as strings."""
    times = ", ".join(f"`{name}` DOUBLE" for name in execution_columns(repetitions))
    reader = spark.read.option("header", True)
    if key not in ("file", "folder"):
        scan = reader.schema(f"{WORKERS} INT, {times}, `{key}` STRING").csv(path)
        value = F.substring(F.col(key), len(MARK) + 1, 1 << 30)
        return scan.select(value.alias(key), WORKERS, *execution_columns(repetitions))
    scan = reader.schema(f"{WORKERS} INT, {times}").csv(path)
    place = F.element_at(F.split("_metadata.file_path", "/"), -1 if key == "file" else -2)
    return scan.select(place.alias(key), "*")
