"""The word and letter report in one pass over the text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiband.operators.bands import banded
from lexiband.operators.frequency import letters_of_counts, token_counts
from lexiband.operators.ranking import by_frequency, in_order, numbered, release, standing, with_letter_rank
from lexiband.sources.csv import write_bands
from lexiband.sources.tables import read_lines

# Names of the two outputs.
WORDS_OUT = "words_spark"
LETTERS_OUT = "letters_spark"


def word_and_letter_bands(df: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Word bands and letter bands that share one reading of the text.

    The token counts are kept in order, words first and then the letters found outside
    words. Both results start from there.
    """
    tokens = in_order(token_counts(df, text), by_frequency("token"), ranked=F.col("is_word"))
    words = numbered(tokens).where("is_word").withColumnRenamed("token", "word")
    letters = with_letter_rank(letters_of_counts(tokens), by_frequency("letter"))
    return banded(words, "word"), banded(letters, "letter")


def write_report(spark: SparkSession, source: str | list[str], out_dir: str = ".") -> tuple[str, str]:
    """Read text files, write both banded tables as CSV, and return the two paths."""
    mark = standing()
    words, letters = word_and_letter_bands(read_lines(spark, source), "value")
    paths = f"{out_dir.rstrip('/')}/{WORDS_OUT}", f"{out_dir.rstrip('/')}/{LETTERS_OUT}"
    write_bands(words, paths[0])
    write_bands(letters, paths[1])
    release(spark, mark)
    return paths
