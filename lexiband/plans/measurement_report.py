"""Mean and deviation of every setting in a folder of measurement files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexiband.operators.measurements import mean_and_deviation, unpivot_measures
from lexiband.sources.csv import execution_columns, read_measurements


def measurement_report(spark: SparkSession, path: str | list[str], repetitions: int = 3, key: str = "file") -> DataFrame:
    """`file`, `Workers`, `mean`, `sd`, for all files at once.

    With the key "folder", files of one folder count as one; with the key that
    `write_measurements` was given, those of one value, null included.
    """
    ids = [key, "Workers"]
    wide = read_measurements(spark, path, repetitions, key)
    return mean_and_deviation(unpivot_measures(wide, ids, execution_columns(repetitions)), ids)
