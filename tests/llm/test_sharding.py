import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiband.llm import queries, sharding

def dims():
    return {"n": F.col("n").cast("bigint"), "m": F.coalesce(F.col("m").cast("bigint"), F.lit(0))}



def check(found, rows, count, slack):
    assert len(found) == len(rows)
    assert sorted(zip(found["size"], found.text_crc32)) == sorted(
        (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for t in rows
    )
    for _, slots in found.groupby("shard").slot:
        assert sorted(slots) == list(range(len(slots)))
    sizes = np.bincount(found.shard, weights=found["size"], minlength=count)
    assert len(sizes) == count
    assert abs(sizes - sizes.mean()).max() <= slack * sizes.mean() + found["size"].max()


@pytest.mark.parametrize("count", [1, 3, 16])
def test_shards_are_near_equal(spark, count):
    rng = np.random.default_rng(1)
    texts = ["a" * int(n) for n in rng.integers(0, 300, 700)]
    rows = [(i, t, len(t), i % 7, 3, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, n INT, m INT, shard INT, slot STRING")
    check(sharding.shards(docs, dims(), count).toPandas(), texts, count, 0.02)


def test_a_hot_group_is_split_and_others_stay_together(spark):
    texts = ["hot text"] * 600 + [f"text {i // 3} " + "z" * (i // 3 % 50) for i in range(900)]
    rows = [(i if i % 5 else None, t, len(t), 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, n INT, m INT")
    found = sharding.shards(docs, dims(), 16, tolerance=0.02).toPandas()
    check(found, texts, 16, 0.1)
    spread = found.groupby("text_crc32").shard.nunique()
    assert spread[zlib.crc32(b"hot text")] >= 2
    assert (spread > 1).sum() <= 16


@pytest.mark.parametrize("rows", [[], [(None, None, None, None)], [(1, "", 0, 0)] * 3, [(1, "é", 1, 1), (2, "x" * 99_999, 9, 9)]])
def test_few_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, n INT, m INT")
    found = sharding.shards(docs, {"n": F.coalesce(F.col("n"), F.lit(0)).cast("bigint")}, 16).toPandas()
    assert len(found) == len(rows) and (found.empty or found.shard.between(0, 15).all())
    assert sum(found["size"]) == sum(len((r[1] or "").encode()) + 1 for r in rows)


def test_query(spark):
    found = queries.op5_kd_shards(spark, "/root/testdata/sf0.01").toPandas()
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    check(found, texts, 16, 0.02)
    assert set(found.law) == {"bytes"} and found.grown_shard.isna().all()
