"""Frequency tables and corpus totals.

All counts combine on the map side, so a task sends one row per distinct token however
often the token occurs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiband.functions import tokens as T
from lexiband.functions.bands import thresholds
from lexiband.operators import tokenize


def word_frequency(df: DataFrame, text: str = "text") -> DataFrame:
    """`word`, `frequency`."""
    return tokenize.word_rows(df, text).groupBy("word").agg(F.count("*").alias("frequency"))


def letter_frequency(df: DataFrame, text: str = "text") -> DataFrame:
    """`letter`, `frequency`, straight from the text: a task sends at most 26 rows."""
    return tokenize.letter_rows(df, text).groupBy("letter").agg(F.count("*").alias("frequency"))


def token_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """`is_word`, `token`, `frequency`: the words, and the letters found outside words."""
    return (
        tokenize.counting_tokens(df, text)
        .groupBy("is_word", "token")
        .agg(F.count("*").alias("frequency"))
    )


def letters_of_counts(counts: DataFrame) -> DataFrame:
    """`letter`, `frequency` from `token_counts`: each letter weighs as its token occurs."""
    return (
        counts.select(F.explode(F.split("token", "")).alias("letter"), "frequency")
        .groupBy("letter")
        .agg(F.sum("frequency").alias("frequency"))
    )


def distinct_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """`kind`, `n`: the exact numbers of distinct words and of distinct letters."""
    sizes = _sizes(token_counts(df, text))
    return sizes.selectExpr("stack(2, 'word', distinct_words, 'letter', distinct_letters) AS (kind, n)")


def corpus_totals(df: DataFrame, text: str = "text") -> DataFrame:
    """One row: total and distinct words, distinct letters, and the thresholds of both."""
    sizes = _sizes(token_counts(df, text))
    return sizes.select(
        "total_words",
        "distinct_words",
        *_prefixed("word", F.col("distinct_words")),
        "distinct_letters",
        *_prefixed("letter", F.col("distinct_letters")),
    )


def band_thresholds(frequencies: DataFrame) -> DataFrame:
    """One row: the number of distinct tokens `n` and the thresholds that follow from it."""
    sizes = frequencies.agg(F.count("*").alias("n"))
    return sizes.select("n", *(limit.alias(name) for name, limit in thresholds(F.col("n")).items()))


def _sizes(counts: DataFrame) -> DataFrame:
    """One row in one aggregate over `token_counts`, so that the text is read once."""
    seen = (F.coalesce(F.bool_or(F.contains("token", F.lit(letter))), F.lit(False)) for letter in T.LETTERS)
    return counts.agg(
        F.coalesce(F.sum(F.when(F.col("is_word"), F.col("frequency"))), F.lit(0)).alias("total_words"),
        F.count_if("is_word").alias("distinct_words"),
        sum((found.cast("bigint") for found in seen), F.lit(0)).alias("distinct_letters"),
    )


def _prefixed(kind: str, n: Column) -> list[Column]:
    return [limit.alias(f"{kind}_{name}") for name, limit in thresholds(n).items()]
