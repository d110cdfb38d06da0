"""Ranked and banded tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiband.functions.bands import category
from lexiband.operators.frequency import letter_frequency, word_frequency
from lexiband.operators.ranking import by_frequency, with_letter_rank, with_rank


def word_rank(df: DataFrame, text: str = "text") -> DataFrame:
    """`rank`, `word`, `frequency` of every distinct word."""
    return with_rank(word_frequency(df, text), by_frequency("word")).select("rank", "word", "frequency")


def letter_rank(df: DataFrame, text: str = "text") -> DataFrame:
    """`rank`, `letter`, `frequency` of every distinct letter."""
    ranked = with_letter_rank(letter_frequency(df, text), by_frequency("letter"))
    return ranked.select("rank", "letter", "frequency")


def word_bands(df: DataFrame, text: str = "text") -> DataFrame:
    """`rank`, `word`, `category`, `frequency` of the popular, common and rare words."""
    return banded(with_rank(word_frequency(df, text), by_frequency("word")), "word")


def letter_bands(df: DataFrame, text: str = "text") -> DataFrame:
    """`rank`, `letter`, `category`, `frequency` of the popular, common and rare letters."""
    return banded(with_letter_rank(letter_frequency(df, text), by_frequency("letter")), "letter")


def banded(ranked: DataFrame, token: str) -> DataFrame:
    """Label a table that has `rank` and `n`, and keep the rows inside a band."""
    return (
        ranked.withColumn("category", category(F.col("rank"), F.col("n")))
        .where(F.col("category").isNotNull())
        .select("rank", token, "category", "frequency")
    )
