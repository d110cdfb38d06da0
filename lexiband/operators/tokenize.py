"""Row-level tokenising: one input row becomes many, nothing is shuffled.

Each function takes the name of the text column and the columns to `keep` beside the
tokens. Rows with a null text give no tokens.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiband.functions import tokens as T


def line_rows(df: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Lines of the text, numbered from 0 within each input row."""
    return df.select(*keep, F.posexplode(T.lines(F.col(text))).alias("line_no", "line"))


def token_rows(df: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Non-empty pieces between separators, as written."""
    return _blocks(df, text, keep).select(*keep, F.explode(T.pieces(F.col("_text"))).alias("raw"))


def word_rows(df: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Pieces made of ASCII letters only, lower-cased after that test."""
    raw = F.col("raw")
    return token_rows(df, text, keep).where(T.is_word(raw)).select(*keep, F.lower(raw).alias("word"))


def letter_rows(df: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Every ASCII letter of the text, lower-cased, whether or not it is part of a word.

    No separator is a letter, so runs of letters serve as well as pieces. Two explodes
    keep the arrays small: one array of all letters would be many times the text.
    """
    runs = _blocks(df, text, keep).select(*keep, F.explode(T.letter_runs(F.col("_text"))).alias("run"))
    return runs.select(*keep, F.explode(F.split(F.lower("run"), "")).alias("letter"))


def tagged_tokens(
    df: DataFrame, text: str = "text", keep: Sequence[str] = (), tags: Sequence[str] = ("w", "l")
) -> DataFrame:
    """Words tagged `w` and letters tagged `l` in one table.

    A caller who wants one kind says so in `tags`: a filter on `type` comes too late to keep
    the other kind from being made.
    """
    if set(tags) == {"w"}:
        return word_rows(df, text, keep).select(*keep, F.col("word").alias("token"), F.lit("w").alias("type"))
    if set(tags) == {"l"}:
        return letter_rows(df, text, keep).select(*keep, F.col("letter").alias("token"), F.lit("l").alias("type"))
    raw = F.col("raw")
    tagged = token_rows(df, text, keep).select(*keep, raw, T.is_word(raw).alias("is_word"))
    tokens = F.when(F.col("is_word"), F.concat(F.array(F.lower(raw)), T.letters(raw))).otherwise(T.letters(raw))
    return (
        tagged.select(*keep, "is_word", F.posexplode(tokens).alias("pos", "token"))
        .where(F.col("token") != "")
        .select(*keep, "token", F.when(F.col("is_word") & (F.col("pos") == 0), "w").otherwise("l").alias("type"))
    )


def counting_tokens(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows from which both words and letters can be counted: `is_word`, `token`.

    A word stands for itself and its letters. Only pieces that are no words (numbers,
    addresses, other scripts) are broken into letters here, so that their endless
    variety collapses to 26 keys before the shuffle and no letter of a word needs a row.
    """
    raw = F.col("raw")
    tagged = token_rows(df, text).select(raw, T.is_word(raw).alias("is_word"))
    token = F.when(F.col("is_word"), F.array(F.lower(raw))).otherwise(T.letters(raw))
    return tagged.select("is_word", F.explode(token).alias("token")).where(F.col("token") != "")


def _blocks(df: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """Texts in blocks that cut no piece, so that the tokens are the same."""
    return df.select(*keep, F.explode(T.blocks(F.col(text))).alias("_text"))
