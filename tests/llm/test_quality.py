"""Quality classifier: the learner against plain arithmetic, and its accuracy on held-out rows."""

import math
import random
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiband.llm import quality

SF_DIR = "/root/testdata/sf0.01"
DOCS, LABELS = "doc_id BIGINT, text STRING, lang STRING, source STRING", "doc_id BIGINT, quality INT, toxic INT"


def test_updates_against_plain_arithmetic():
    """The closed form per slot, row by row, in dictionaries."""
    rng = random.Random(7)
    rows = []
    for _ in range(200):
        slots = np.array(sorted(rng.sample(range(40), 5)))
        rows.append((slots, np.array([rng.random() for _ in slots]), int(rng.random() < 0.6)))
    state = quality.start()
    quality.learn(state, rows)
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= quality.L1:
            return 0.0
        sign = math.copysign(quality.L1, z[i])
        return (sign - z[i]) / ((quality.SMOOTHING + math.sqrt(n[i])) / quality.RATE + quality.L2)

    for slots, values, label in rows:
        pairs = [*zip(slots.tolist(), values.tolist()), (quality.SLOTS, 1.0)]
        w = {i: weight(i) for i, _ in pairs}
        p = 1 / (1 + math.exp(-sum(w[i] * x for i, x in pairs)))
        for i, x in pairs:
            g = (p - label) * x
            more = n.get(i, 0.0) + g * g
            z[i] = z.get(i, 0.0) + g - (math.sqrt(more) - math.sqrt(n.get(i, 0.0))) / quality.RATE * w[i]
            n[i] = more
    got = state.weights()
    assert set(np.flatnonzero(got).tolist()) == {i for i in z if weight(i) != 0}
    assert all(math.isclose(got[i], weight(i), rel_tol=1e-9, abs_tol=1e-12) for i in z)


def test_rows_have_length_one_and_know_repeats_and_capitals():
    for text in ("", " ", "a", "One two, one two!", "THE THE THE", "x " * 1000, "é" * 10, "\ud800"):
        slots, values = quality.features(text)
        assert math.isclose(float(values @ values), 1.0) and len(set(slots.tolist())) == len(slots)
    assert set(quality.features("a a")[0]) & set(quality.features("b b")[0])
    assert set(quality.features("AB")[0]) & set(quality.features("CD")[0])
    assert not set(quality.features("ab")[0]) & set(quality.features("cd")[0])


def test_calibration_finds_the_best_cut():
    rng = np.random.default_rng(3)
    for _ in range(20):
        margins, labels = rng.integers(0, 12, 40).astype(float), rng.integers(0, 2, 40)
        if labels.min() == labels.max():
            continue
        _, at = quality.calibrated(margins, labels)

        def gain(cut, margins=margins, labels=labels):
            told = margins >= cut
            return told[labels == 1].mean() - told[labels == 0].mean()

        assert math.isclose(gain(at), max(gain(cut) for cut in np.arange(-1, 14, 0.5)))


def made(n, seed=1):
    rng = random.Random(seed)
    good, bad = [f"g{chr(97 + i)}" for i in range(20)], [f"b{chr(97 + i)}" for i in range(20)]
    rows = []
    for i in range(n):
        label = i % 4 > 0
        rows.append((i, " ".join(rng.choices(good if label else bad, k=30)) + " so it is", int(label)))
    return rows


def scores(spark, docs, labels):
    out = quality.score_documents(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    return out.collect()


def test_held_out_rows_of_made_texts(spark):
    rows = made(600)
    docs = [(i, text, "en", "s") for i, text, _ in rows]
    # Labels of rows that may not teach are turned round: they must not matter.
    apart = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    labels = [(i, 1 - y if i in apart else y, 0) for i, _, y in rows]
    out = {row.doc_id: row for row in scores(spark, docs, labels)}
    assert {i for i, row in out.items() if row.held_out} == apart
    assert all(out[i].predicted == y for i, _, y in rows)
    assert all(0 <= row.score <= 1 and row.predicted == (row.score >= 0.3) for row in out.values())


def test_odd_rows(spark):
    rows = made(300)
    docs = [(i, text, None, None) for i, text, _ in rows]
    docs += [(None, "ga gb", None, None), (900, None, None, None), (901, "", None, None), (902, "ga gb " * 300_000, None, None)]
    docs += [(2, rows[2][1], None, None)] * 3
    labels = [(i, y, None) for i, _, y in rows] + [(None, 0, 0), (901, None, 0), (3, 0, 0), (7777, 1, 1)]
    out = scores(spark, docs, labels)
    assert len(out) == len(docs)
    by_id = {row.doc_id: row for row in out}
    assert by_id[None].held_out is False and by_id[900].score == by_id[901].score
    assert by_id[902].predicted == 1 and len({row.score for row in out if row.doc_id == 2}) == 1


@pytest.mark.parametrize("labels, score", [([], 1.0), ([(1, 1, 0), (2, 1, 0)], 1.0), ([(1, 0, 0)], 0.0)])
def test_too_few_labels(spark, labels, score):
    docs = [(1, "a", None, None), (2, "b", None, None), (None, None, None, None)]
    assert {row.score for row in scores(spark, docs, labels)} == {score}
    assert scores(spark, [], labels) == []


def test_clashing_columns_and_same_run_twice(spark):
    rows = made(200)
    docs = spark.createDataFrame([(i, text, "en", "s") for i, text, _ in rows], DOCS)
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows], LABELS)
    plain = sorted(quality.score_documents(docs, labels).collect())
    names = ["label", "part", "order", "slots", "values", "score", "_id", "_text", "doc"]
    more = docs.withColumns({name: F.lit("x") for name in names})
    assert sorted(quality.score_documents(more, labels.withColumn("text", F.lit("y"))).collect()) == plain


@pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="test tables are not there")
def test_held_out_rows_of_the_tables(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels"))
    out = quality.score_documents(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = {y: [row.predicted == y for row in out if row.quality == y] for y in (0, 1)}
    assert all(sum(found) >= 0.85 * len(found) for found in right.values())
