import hashlib

import pytest
from pyspark.sql import functions as F

from lexiband.llm import content_sort
from lexiband.llm.content_sort import LOWER, UPPER

SCHEMA = "doc_id BIGINT, text STRING, kept STRING, part INT, lang STRING"


def brute(rows, keep):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault((text or "").translate(str.maketrans(UPPER, LOWER)), []).append(doc_id)
    found = []
    for text, ids in groups.items():
        named = [i for i in ids if i is not None]
        stays = (max(named) if keep == "largest" else min(named)) if named else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        found += [(i, stays, len(ids), sha) for i in ids]
    return sorted(found, key=str)


def result(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=str)


@pytest.fixture
def frame(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, "x", 7, None) for i, t in rows], SCHEMA)

    return make


CASES = [
    [],
    [(1, None), (2, ""), (3, "a"), (4, "A"), (5, "Ä"), (6, "ä")],
    [(None, "a"), (None, "a"), (3, "b"), (None, "b")],
    [(1, "a"), (1, "a"), (2, "a"), (2, "b")],
    [(i, "Hot text" if i % 3 else f"text {i % 50}") for i in range(600)],
    [(1, "x" * 300_000), (2, "x" * 300_000), (3, "x" * 299_999 + "y")],
]


@pytest.mark.parametrize("rows", CASES)
@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_groups_equal_brute_force(frame, rows, keep):
    assert result(content_sort.duplicate_groups(frame(rows), keep=keep)) == brute(rows, keep)


@pytest.mark.parametrize("rows", CASES)
def test_one_row_of_each_group_stays(frame, rows):
    df = frame(rows)
    groups = content_sort.duplicate_groups(df, keep="largest")
    assert groups.where("kept").count() == groups.select("text_sha256").distinct().count()
    stays = content_sort.drop_duplicates(df, keep="largest")
    assert stays.columns == df.columns
    key = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    assert stays.count() == df.select(key).distinct().count()


def test_a_group_over_many_partitions_is_one(spark, frame):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(i, "same" if i % 4 else f"other {i}") for i in range(4000)]
        df = frame(rows)
        parts = content_sort._sorted_rows(df, "text", "doc_id", "largest", False)
        spread = parts.where(F.col("sha") == F.sha2(F.lit("same"), 256)).select("part").distinct().count()
        assert spread > 2
        assert result(content_sort.duplicate_groups(df, keep="largest")) == brute(rows, "largest")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


@pytest.mark.parametrize("carry", [False, True])
def test_large_batches_are_taken_in_pieces(spark, carry):
    """Neighbours are compared a few texts at a time, and copies across pieces still meet."""
    docs = spark.range(0, 3000, 1, 1).selectExpr("id AS doc_id", "concat('Text ', CAST(id DIV 700 AS STRING)) AS text")
    rows = content_sort._sorted_rows(docs, "text", "doc_id", "largest", carry)
    parts = rows.where("pos = 0").count()
    assert rows.where("edge IS NOT NULL").count() > 2 * parts
    assert rows.count() == 3000
    if carry:
        kept = content_sort.drop_duplicates(docs, keep="largest")
        assert sorted(r.doc_id for r in kept.collect()) == [699, 1399, 2099, 2799, 2999]
    else:
        groups = content_sort.duplicate_groups(docs, keep="largest")
        assert sorted(r.doc_id for r in groups.where("kept").collect()) == [699, 1399, 2099, 2799, 2999]
