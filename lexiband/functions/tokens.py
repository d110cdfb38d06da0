"""Tokenising rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What separates two pieces of a line, what a word and a letter are.
# White space is spelled out: as single characters the class is one table look-up.
SEPARATORS = r' \t\n\x0B\f\r,.;:?!"()\[\]{}_-'
WORD = "[a-zA-Z]+"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
# Characters of a long text that are taken apart at once.
BLOCK = 1 << 16
LINE_BREAK = r"\r\n|[\r\n]"


def pieces(text: Column) -> Column:
    """Array of the non-empty runs of `text` between separators.

    Extracting the runs leaves no empty strings to drop afterwards, and the pattern
    is compiled once per task; `split` compiles it again for every row.
    """
    return F.regexp_extract_all(text, F.lit(f"[^{SEPARATORS}]+"), F.lit(0))


def blocks(text: Column) -> Column:
    """Array of parts of `text` that cut no piece: BLOCK characters and the rest of the last piece.

    The array of a text's pieces takes many times the room of the text and is held by one
    task; that of a block is small, whatever the text. A text of no more bytes is one block as
    it is, so that most texts are not searched for the cuts.
    """
    cut = F.regexp_extract_all(text, F.lit(rf"[\s\S]{{1,{BLOCK}}}[^{SEPARATORS}]*+"), F.lit(0))
    return F.when(F.octet_length(text) > BLOCK, cut).otherwise(F.array(text))


def is_word(piece: Column) -> Column:
    """True if the whole piece is ASCII letters.

    `\\z` rather than `$`, as `$` would also accept a word followed by U+2028 or U+0085.
    """
    return piece.rlike(rf"\A{WORD}\z")


def letter_runs(text: Column) -> Column:
    """Array of the runs of ASCII letters, in words or not."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def letters(piece: Column) -> Column:
    """Array of the ASCII letters of `piece`, lower-cased; `[""]` if there are none.

    Other characters go before `lower` does, which would turn U+212A into `k`.
    """
    return F.split(F.lower(F.regexp_replace(piece, "[^a-zA-Z]+", "")), "")


def lines(text: Column) -> Column:
    """Array of the lines that a file scan would make of `text`.

    A final line break opens no further line, and an empty text has no lines.
    """
    body = F.regexp_replace(text, rf"(?:{LINE_BREAK})\z", "")
    return F.when(text != "", F.split(body, LINE_BREAK))
