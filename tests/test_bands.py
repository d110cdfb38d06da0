"""Thresholds and bands."""

import random

import pytest
from pyspark.sql import functions as F

import model
from lexiband.functions.bands import thresholds
from lexiband.operators.bands import letter_bands, word_bands
from lexiband.operators.frequency import band_thresholds, word_frequency
from lexiband.plans.report import word_and_letter_bands

# Bands by rank of vocabularies of 0 to 7 tokens.
SMALL = ["", "P", "PR", "PRR", "PCRR", "PCCRR", "PCCCRR", "P.CC.RR"]


@pytest.mark.parametrize("n", range(8))
def test_small_vocabularies(texts, n):
    df = texts(" ".join("abcdefg"[:n]))
    want = [(i, name) for i, name in enumerate(SMALL[n], 1) if name != "."]
    for bands in (word_bands(df), letter_bands(df), *word_and_letter_bands(df)):
        got = bands.orderBy("rank").collect()
        assert [(row.rank, row.category[0].upper()) for row in got] == want


def test_schema(texts):
    names = ["rank", "word", "category", "frequency"]
    types = ["bigint", "string", "string", "bigint"]
    assert word_bands(texts("a b")).dtypes == list(zip(names, types))


def test_thresholds_match_exact_arithmetic(spark):
    numbers = spark.range(0, 3_000_000).select(F.col("id").alias("n"))
    limit = thresholds(F.col("n"))
    exact = {
        "popular": F.expr("(n + 19) div 20"),
        "common_lo": F.expr("19 * n div 40"),
        "common_hi": F.expr("(21 * n + 39) div 40"),
        "rare": F.expr("19 * n div 20"),
    }
    differing = [limit[name] != exact[name] for name in exact]
    assert numbers.where(differing[0] | differing[1] | differing[2] | differing[3]).count() == 0


def test_threshold_row(texts):
    rows = band_thresholds(word_frequency(texts(" ".join("abcdefghijklmnopqrstuvwxyz")))).collect()
    assert rows == [(26, *model.limits(26))]


def test_both_from_one_reading_equal_the_single_ones(texts):
    df = texts("The cat's 9 lives: the cat, a dog, a bird and the end.", "x1y2 the Zoo-keeper", None)
    words, letters = word_and_letter_bands(df)
    assert words.orderBy("rank").collect() == word_bands(df).orderBy("rank").collect()
    assert letters.orderBy("rank").collect() == letter_bands(df).orderBy("rank").collect()


@pytest.mark.parametrize("vocabulary", [40, 700])
def test_bands_match_the_model(texts, vocabulary):
    source = random.Random(vocabulary)
    pool = ["".join(source.choices("abcDEFé9'", k=source.randint(1, 6))) for _ in range(vocabulary)]
    rows = [source.choice(" ,-!").join(source.choices(pool, k=60)) for _ in range(30)]
    words = model.bands([word for row in rows for word in model.words(row)])
    letters = model.bands([letter for row in rows for letter in model.letters(row)])
    df = texts(*rows)
    assert word_bands(df).orderBy("rank").collect() == words
    assert letter_bands(df).orderBy("rank").collect() == letters
    both = word_and_letter_bands(df)
    assert [result.orderBy("rank").collect() for result in both] == [words, letters]


def test_neither_result_reads_the_text_again(texts):
    for bands in word_and_letter_bands(texts("one two", "three")):
        plan = bands._jdf.queryExecution().executedPlan().toString()
        assert "regexp_extract_all" not in plan and "ExistingRDD" in plan
