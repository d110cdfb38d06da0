"""The job from text files to CSV."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

import model
from lexiband import __main__ as cli
from lexiband.operators.bands import word_bands
from lexiband.plans.report import write_report
from lexiband.sources.csv import read_bands
from lexiband.sources.tables import read_lines


def csv_lines(folder):
    parts = sorted(Path(folder).glob("part-*.csv"))
    return [part.read_text().splitlines() for part in parts]


def expected(token, rows):
    return [f"rank,{token},category,frequency"] + [",".join(map(str, row)) for row in rows]


def test_small_output_is_one_sorted_file(spark, tmp_path):
    text = "b a b c's d9 e-f\n\nB zebra\n"
    (tmp_path / "in.txt").write_text(text)
    words, letters = write_report(spark, str(tmp_path / "in.txt"), str(tmp_path))
    assert (words, letters) == (f"{tmp_path}/words_spark", f"{tmp_path}/letters_spark")
    assert csv_lines(words) == [expected("word", model.bands(model.words(text)))]
    assert csv_lines(letters) == [expected("letter", model.bands(model.letters(text)))]


def test_part_files_follow_each_other_in_rank_order(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        text = "\n".join("w" + "".join(chr(97 + int(d)) for d in str(i)) for i in range(4_000))
        (tmp_path / "in.txt").write_text(text)
        words, _ = write_report(spark, str(tmp_path / "in.txt"), str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = csv_lines(words)
    assert len(files) > 1
    rows = [line for lines in files for line in lines[1:]]
    assert rows == expected("word", model.bands(model.words(text)))[1:]


def test_old_output_is_replaced(spark, tmp_path):
    (tmp_path / "in.txt").write_text("old")
    write_report(spark, str(tmp_path / "in.txt"), str(tmp_path))
    (tmp_path / "in.txt").write_text("new")
    words, _ = write_report(spark, str(tmp_path / "in.txt"), str(tmp_path))
    assert read_bands(spark, words, "word").collect() == [(1, "new", "popular", 1)]


def test_empty_input_leaves_headers(spark, tmp_path):
    (tmp_path / "in.txt").write_text("")
    words, letters = write_report(spark, str(tmp_path / "in.txt"), str(tmp_path))
    assert csv_lines(words) == [expected("word", [])]
    assert csv_lines(letters) == [expected("letter", [])]


def test_directory_glob_and_list_inputs(spark, tmp_path):
    source = tmp_path / "texts"
    source.mkdir()
    for name, text in (("1.txt", "a b"), ("2.txt", "b c"), ("3.log", "z")):
        (source / name).write_text(text)
    two = model.bands(["a", "b", "b", "c"])
    for path in (f"{source}/*.txt", [f"{source}/1.txt", f"{source}/2.txt"]):
        assert word_bands(read_lines(spark, path), "value").orderBy("rank").collect() == two
    every = word_bands(read_lines(spark, str(source)), "value").orderBy("rank").collect()
    assert every == model.bands(["a", "b", "b", "c", "z"])


def test_lines_may_end_at_any_separator(spark, tmp_path):
    text = "One two, two\nthree's four four four\n"
    (tmp_path / "in.txt").write_text(text)
    lines = read_lines(spark, str(tmp_path / "in.txt"), line_sep=" ")
    assert lines.count() == 6
    assert word_bands(lines, "value").orderBy("rank").collect() == model.bands(model.words(text))


def test_missing_input_keeps_old_output(spark, tmp_path):
    (tmp_path / "in.txt").write_text("old")
    words, _ = write_report(spark, str(tmp_path / "in.txt"), str(tmp_path))
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        write_report(spark, str(tmp_path / "none.txt"), str(tmp_path))
    assert read_bands(spark, words, "word").count() == 1


def test_arguments(monkeypatch, spark, tmp_path):
    for wrong in ([], ["-i"], ["text.txt"], ["-x", "text.txt"]):
        with pytest.raises(SystemExit):
            cli.main(wrong)
    (tmp_path / "in.txt").write_text("word")
    monkeypatch.setattr(cli, "build_session", lambda: spark.newSession())
    monkeypatch.setattr("pyspark.sql.SparkSession.stop", lambda self: None)
    cli.main(["-i", str(tmp_path / "in.txt"), "-o", str(tmp_path)])
    assert read_bands(spark, str(tmp_path / "words_spark"), "word").count() == 1
    assert read_bands(spark, str(tmp_path / "letters_spark"), "letter").count() == 4


def test_job_in_a_process_of_its_own(spark, tmp_path):
    (tmp_path / "in.txt").write_text("one two two\n")
    job = Path(__file__).resolve().parents[1] / "report_job.py"
    submit = "--master local[2] --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=2 pyspark-shell"
    subprocess.run(
        [sys.executable, str(job), "-i", "in.txt"],
        cwd=tmp_path,
        env={**os.environ, "PYSPARK_SUBMIT_ARGS": submit},
        check=True,
        capture_output=True,
        timeout=300,
    )
    assert csv_lines(tmp_path / "words_spark") == [expected("word", model.bands(["one", "two", "two"]))]
    assert csv_lines(tmp_path / "letters_spark") == [expected("letter", model.bands("onetwotwo"))]
