"""Measurement files: scan, unpivot, mean and deviation."""

import pytest
from pyspark.sql import functions as F

from lexiband.operators.measurements import mean_and_deviation, unpivot_measures
from lexiband.plans.measurement_report import measurement_report
from lexiband.sources.csv import execution_columns, read_measurements, write_measurements

# Two measurement files and what they come to.
FILES = {
    "data_100MB.csv": [(2, 96.14, 94.1, 93.1), (4, 67.05, 68.61, 67.39), (6, 58.94, 58.06, 58.34)],
    "data_500MB.csv": [(2, 327.65, 320.43, 324.53), (4, 183.15, 187.2, 187.36), (6, 137.12, 138.03, 137.42)],
}
STATS = {
    ("data_100MB.csv", 2): (94.447, 1.549),
    ("data_100MB.csv", 4): (67.683, 0.820),
    ("data_100MB.csv", 6): (58.447, 0.450),
    ("data_500MB.csv", 2): (324.203, 3.621),
    ("data_500MB.csv", 4): (185.903, 2.386),
    ("data_500MB.csv", 6): (137.523, 0.464),
}


@pytest.fixture
def folder(tmp_path):
    header = "Workers," + ",".join(execution_columns())
    for name, rows in FILES.items():
        text = "\r\n".join([header, *(",".join(map(str, row)) for row in rows)]) + "\r\n"
        (tmp_path / name).write_bytes(text.encode())
    (tmp_path / "starting_times.txt").write_text("20250225T103940\n")
    return tmp_path


def test_scan(spark, folder):
    wide = read_measurements(spark, f"{folder}/*.csv")
    assert wide.dtypes[1:] == [("Workers", "int")] + [(name, "double") for name in execution_columns()]
    want = sorted((name, *row) for name, rows in FILES.items() for row in rows)
    assert sorted(wide.collect()) == want


def test_unpivot(spark, folder):
    wide = read_measurements(spark, f"{folder}/data_100MB.csv")
    long = unpivot_measures(wide, ["Workers"], execution_columns())
    assert long.dtypes == [("Workers", "int"), ("Execution #", "string"), ("Time taken", "double")]
    assert sorted(long.collect())[:3] == [
        (2, "Execution Time 1", 96.14),
        (2, "Execution Time 2", 94.1),
        (2, "Execution Time 3", 93.1),
    ]
    assert long.count() == 9


def test_report(spark, folder):
    rows = measurement_report(spark, f"{folder}/*.csv").collect()
    assert {(row.file, row.Workers): (round(row["mean"], 3), round(row.sd, 3)) for row in rows} == STATS


def test_folders_by_any_value(spark, tmp_path):
    """Values not foreseen, null and empty ones, and what a path can't hold as it is."""
    flags = ["A", "X", None, "", "a/b", "x=y", "v", "17", " ", "ü"]
    rows = [(flag, i % 2, float(i), float(2 * i), None) for i, flag in enumerate(flags * 4)]
    schema = "flag STRING, Workers INT, " + ", ".join(f"`{name}` DOUBLE" for name in execution_columns())
    wide = spark.createDataFrame(rows, schema)
    write_measurements(wide, str(tmp_path / "out"), "flag")
    back = read_measurements(spark, str(tmp_path / "out"), key="flag")
    assert back.columns == wide.columns and sorted(back.collect(), key=repr) == sorted(map(tuple, rows), key=repr)
    report = measurement_report(spark, str(tmp_path / "out"), key="flag")
    want = mean_and_deviation(unpivot_measures(wide, ["flag", "Workers"], execution_columns()), ["flag", "Workers"])
    assert report.columns == want.columns == ["flag", "Workers", "mean", "sd"]
    assert sorted(report.collect(), key=repr) == sorted(want.collect(), key=repr)


def test_writing_folders_moves_no_rows(spark, tmp_path):
    """A value with most rows is written by all tasks that have some of them."""
    schema = ["id % 100 = 0 AS flag", "1 AS Workers", *(f"0.5D AS `{name}`" for name in execution_columns())]
    wide = spark.range(0, 8000, 1, 8).selectExpr(*schema)
    write_measurements(wide, str(tmp_path / "out"), "flag")
    assert len(list((tmp_path / "out" / "flag=vfalse").glob("part-*.csv"))) == 8
    assert read_measurements(spark, str(tmp_path / "out"), key="flag").count() == 8000


def test_missing_times_do_not_count(spark):
    long = spark.createDataFrame([(1, 2.0), (1, None), (1, 4.0), (2, 5.0), (3, None)], "Workers INT, `Time taken` DOUBLE")
    stats = mean_and_deviation(long, ["Workers"]).withColumn("sd", F.round("sd", 6))
    assert sorted(stats.collect()) == [(1, 3.0, 1.414214), (2, 5.0, None), (3, None, None)]
