"""Tokenising rules, at their edges."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import model
from lexiband.operators import frequency, tokenize
from lexiband.sources.tables import read_lines

EDGES = {
    "abc ": ([], "abc"),
    "abc\u0085": ([], "abc"),
    "K": ([], ""),
    "xİy": ([], "xy"),
    "café": ([], "caf"),
    "a b": ([], "ab"),
    "a\x0bb": (["a", "b"], "ab"),
    "Berkeley's": ([], "berkeleys"),
    "": ([], ""),
    "4711": ([], ""),
    "++": ([], ""),
    "x-y_z": (["x", "y", "z"], "xyz"),
    "a/b a\\b a@b a|b a#b": ([], "abababab" + "ab"),
    "\U0001f600abc abc\U0001f600": ([], "abcabc"),
    "...lead, trail!!!": (["lead", "trail"], "leadtrail"),
    "A a I": (["a", "a", "i"], "aai"),
}


@pytest.mark.parametrize("text", EDGES)
def test_edges(texts, text):
    words, letters = EDGES[text]
    df = texts(text)
    assert [row.word for row in tokenize.word_rows(df).collect()] == words
    assert "".join(row.letter for row in tokenize.letter_rows(df).collect()) == letters
    tagged = tokenize.tagged_tokens(df).collect()
    assert [row.token for row in tagged if row.type == "w"] == words
    assert "".join(row.token for row in tagged if row.type == "l") == letters


def test_null_text_gives_no_tokens(texts):
    df = texts(None, "one")
    assert [row.word for row in tokenize.word_rows(df).collect()] == ["one"]
    assert tokenize.line_rows(df).count() == 1
    assert frequency.corpus_totals(df).first().total_words == 1


def test_keep_carries_columns(texts):
    df = texts("a b", "c4 d")
    assert tokenize.token_rows(df, keep=["doc_id"]).collect() == [(0, "a"), (0, "b"), (1, "c4"), (1, "d")]


@pytest.mark.parametrize("text", ["", "\n", "a", "a\n", "a\n\n", "a\r\nb\rc\n\rd\n", "a\x0bb\u0085c d", "\n\na"])
def test_lines_match_a_file_scan(spark, texts, tmp_path, text):
    (tmp_path / "text.txt").write_bytes(text.encode("utf-8"))
    scanned = [row.value for row in spark.read.text(str(tmp_path / "text.txt")).collect()]
    assert sorted(row.value for row in read_lines(spark, str(tmp_path / "text.txt")).collect()) == sorted(scanned)
    split = tokenize.line_rows(texts(text)).collect()
    assert [row.line for row in split] == scanned
    assert [row.line_no for row in split] == list(range(len(scanned)))


ALPHABET = "aAbzZ kKé£1-_'\",.;:?!()[]{}@ \t\n\r\x0b\x0c \u0085 \U0001f600"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(ALPHABET, max_size=60), min_size=1, max_size=30))
def test_counts_match_the_model(texts, rows):
    df = texts(*rows)
    words = Counter(word for row in rows for word in model.words(row))
    letters = Counter(letter for row in rows for letter in model.letters(row))
    counts = frequency.token_counts(df)
    assert dict(counts.where("is_word").select("token", "frequency").collect()) == words
    assert dict(frequency.letters_of_counts(counts).collect()) == letters
    assert dict(frequency.letter_frequency(df).collect()) == letters
    assert dict(frequency.word_frequency(df).collect()) == words
    totals = frequency.corpus_totals(df).first()
    assert (totals.total_words, totals.distinct_words) == (words.total(), len(words))
    assert totals.distinct_letters == len(letters)
    assert frequency.distinct_counts(df).collect() == [("word", len(words)), ("letter", len(letters))]


def test_documents_and_their_lines_count_the_same(texts):
    text = "One two\nthree-four\r\nfive's six7\rEight\x0bnine"
    lines = tokenize.line_rows(texts(text)).select("line")
    whole = frequency.token_counts(texts(text)).collect()
    assert sorted(whole) == sorted(frequency.token_counts(lines, "line").collect())


def test_a_long_text_without_line_or_sentence_counts_right(spark):
    """64 MB in one row, parted by spaces alone, is never one array."""
    df = spark.range(1).selectExpr("repeat('Aa b9 c-d ', 6710886) AS text")
    assert dict(frequency.word_frequency(df).collect()) == {"aa": 6710886, "c": 6710886, "d": 6710886}


def test_only_wanted_kinds_are_made(texts):
    df = texts("Aa 1b")
    words = tokenize.tagged_tokens(df, tags=["w"])
    assert words.collect() == [("aa", "w")]
    assert "split" not in words._jdf.queryExecution().executedPlan().toString()
    assert sorted(tokenize.tagged_tokens(df, tags=["l"]).collect()) == [("a", "l"), ("a", "l"), ("b", "l")]


def test_long_texts_are_cut_without_loss(texts, monkeypatch):
    text = "Aa 1b\n\n" * 50 + "c-d\r\ne's\n.5.Six." + "x" * 40
    monkeypatch.setattr(tokenize.T, "BLOCK", 100)
    df = texts(text, "short text\nof two lines")
    words = Counter(model.words(text + "\nshort text\nof two lines"))
    assert dict(frequency.word_frequency(df).collect()) == words
    assert [row.raw for row in tokenize.token_rows(df).collect()][-5:] == ["short", "text", "of", "two", "lines"]
    letters = Counter(model.letters(text + "short text of two lines"))
    assert dict(frequency.letter_frequency(df).collect()) == letters


def test_pieces_outside_words_shrink_to_letters(texts):
    counts = frequency.token_counts(texts(*(f"id{i}x http://h/{i}" for i in range(500))))
    assert sorted(row.token for row in counts.where("not is_word").collect()) == ["d", "h", "i", "x"]
    assert [row.token for row in counts.where("is_word").collect()] == ["http"]
