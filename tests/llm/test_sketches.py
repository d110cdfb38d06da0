import hashlib
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiband.llm import sketches

SCHEMA = "doc_id BIGINT, text STRING, n_chars BIGINT, extra STRING, bucket INT"


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    rows = sorted(
        ((i, t or "") for i, t in rows),
        key=lambda r: (r[0] is not None, 0 if r[0] is None else r[0], hashlib.sha256(r[1].encode()).hexdigest()),
    )
    out = []
    for k, (doc_id, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), text, edited, following))
    return out


def exact(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a and b else float(not a and not b)


def check(spark, rows, type_="BIGINT"):
    docs = spark.createDataFrame([(*r, 1, "e", 2) for r in rows], SCHEMA.replace("BIGINT", type_, 1))
    found = sketches.edited_likeness(docs).collect()
    want = brute(rows)
    key = lambda r: (str(r[0]), r[1], r[2])
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in found), key=str) == sorted(
        (w[:3] for w in want), key=str
    )
    by_key = {key((r.doc_id, r.n_chars, r.edited_sha256)): r for r in found}
    for doc_id, n, sha, text, edited, following in want:
        row = by_key[key((doc_id, n, sha))]
        assert row.fingerprint == sketches.packed(sketches.sketch(text))
        assert row.edited_fingerprint == sketches.packed(sketches.sketch(edited))
        small = max(len(shingles(t)) for t in (text, edited, following)) < 60
        for estimate, truth in ((row.near_edited, exact(text, edited)), (row.near_next, exact(text, following))):
            assert abs(estimate - truth) < (1e-9 if small else 0.25)


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(5, "only one here")],
        [(None, None), (None, "a b c"), (1, ""), (2, "x y z w v u t s"), (2, "x y z w v u t s")],
        [(7, "a b c d e f g h")] * 4,
        [(i * 37 % 1009, " ".join(f"w{(i * j) % 97}" for j in range(i % 40))) for i in range(500)],
        [(1, "long " * 60_000), (2, " ".join(map(str, range(30_000))))],
    ],
)
def test_equals_brute_force(spark, rows):
    check(spark, rows)


@pytest.mark.parametrize(
    "type_, ids",
    [
        ("BIGINT", [2**60 + i for i in (5, 3, 9, 1, 7, 2, 8, 0, 6, 4)] * 20),
        ("BIGINT", [-(2**62), 2**62, 2**53, 2**53 + 1, 0, None] * 30),
        ("STRING", [f"id{i % 77}" for i in range(200)] + ["", "É", "z", "Z", None, "\U0001f600", "\uffff"]),
        ("DECIMAL(30,0)", [Decimal(10) ** 25 + i for i in range(150)]),
        ("BIGINT", [None] * 10_000),
    ],
)
def test_ids_of_any_kind(spark, type_, ids):
    """Large, negative, null and repeated ids, and ids that are no numbers."""
    check(spark, [(name, f"text {i * 7919 % 1013} of {i % 19} words") for i, name in enumerate(ids)], type_)


def test_null_ids_are_spread(spark):
    rows = spark.createDataFrame([(None, f"text {i}") for i in range(10_000)], "doc_id BIGINT, text STRING")
    sizes = sketches._ranges(rows, "text", "doc_id").groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 8 and max(row["count"] for row in sizes) < 3_000


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    check(spark, [(r.doc_id, r.text) for r in docs])


def test_estimates():
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in rng.integers(0, 10**9, 6000)]
    for share in (0.0, 0.3, 0.8, 1.0):
        a, b = " ".join(words[:3000]), " ".join(words[int(3000 * (1 - share)) : int(3000 * (2 - share))])
        x, y = sketches.sketch(a), sketches.sketch(b)
        truth = exact(a, b)
        assert abs(sketches.resemblance(x, y) - truth) < 0.15
        inside = len(shingles(a) & shingles(b)) / len(shingles(a))
        assert abs(sketches.containment(x, y) - inside) < 0.25
        assert abs(sketches.distinct_shingles(x) / len(shingles(a)) - 1) < 0.35
        assert (sketches.unpacked(sketches.packed(x)) == x).all()


def test_parts_merge_into_the_whole(spark):
    parts = [" ".join(f"w{i}" for i in range(a, a + 400)) for a in range(0, 4000, 100)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(parts)], "doc_id BIGINT, text STRING").repartition(7)
    sketched = sketches.fingerprints(docs).withColumn("source", F.col("doc_id") % 2)
    found = {r.source: r.fingerprint for r in sketches.merge(sketched, "source").collect()}
    for source in (0, 1):
        whole = sketches.merged([sketches.sketch(t) for t in parts[source::2]])
        assert found[source] == sketches.packed(whole)
