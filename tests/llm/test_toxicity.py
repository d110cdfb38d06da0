import zlib

import pytest

from lexiband.llm import toxicity

DOCS = "doc_id BIGINT, text STRING, score STRING, doc INT, _text STRING"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", 1, "t") for r in rows], DOCS)


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id BIGINT, quality INT, toxic INT")


def corpus(n):
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]
    plain = lambda i: [words[(i * 7 + j * j * 13 + j) % len(words)] for j in range(30 + i % 50)]
    bad = ["villain", "scoundrel", "wretch", "rascal"]
    rows, marks = [], []
    for i in range(n):
        text = plain(i)
        if i % 8 == 0:
            for k in range(4):
                text[(k * 9 + i) % len(text)] = bad[(i + k) % 4]
        rows.append((i, " ".join(text)))
        marks.append((i, 1, int(i % 8 == 0)))
    return rows, marks


def test_held_out_accuracy(spark):
    rows, marks = corpus(1200)
    found = toxicity.score_documents(frame(spark, rows), labelled(spark, marks)).collect()
    assert len(found) == 1200
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    assert sum(r.predicted == marks[r.doc_id][2] for r in found if r.held_out) >= 0.98 * sum(r.held_out for r in found)


def test_held_out_labels_do_not_teach(spark):
    rows, marks = corpus(400)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in marks]
    one = toxicity.score_documents(frame(spark, rows), labelled(spark, marks)).collect()
    other = toxicity.score_documents(frame(spark, rows), labelled(spark, flipped)).collect()
    assert sorted(one) == sorted(other)


def test_given_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet") for name in ("documents", "labels"))
    found = toxicity.score_documents(docs, labels).join(labels, "doc_id").where("held_out").collect()
    hits = sum(r.predicted and r.toxic for r in found)
    assert hits / sum(r.predicted for r in found) > 0.95
    assert hits / sum(r.toxic for r in found) > 0.9


@pytest.mark.parametrize("marks", [[], [(1, 1, 1), (3, 0, None), (None, 0, 0)], [(1, 1, 0), (1, 1, 1), (5, 1, 0)]])
def test_edge_cases(spark, marks):
    rows = [(None, None), (1, ""), (2, "a b c"), (2, "a b c"), (3, "w " * 200_000), (5, "ÄÖ 123 ...")]
    docs = frame(spark, rows)
    found = toxicity.score_documents(docs, labelled(spark, marks)).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert [r.held_out for r in found if r.doc_id is None] == [False]
    assert toxicity.drop_toxic(docs, labelled(spark, marks)).columns == docs.columns
    assert toxicity.score_documents(frame(spark, []), labelled(spark, marks)).count() == 0


def test_a_passage_in_a_very_long_text_counts(spark):
    """A clean text of 100,000 words stays; with a toxic passage in it it goes, wherever that is."""
    rows, marks = corpus(1200)
    clean = " ".join(text for i, text in rows if i % 8)
    clean = " ".join((clean + " " + clean + " " + clean).split()[:100_000])
    passage = " ".join(next(text for i, text in rows if i % 8 == 0) for _ in range(3))
    half = len(clean) // 2
    long_ = [(2000, clean), (2001, passage + " " + clean), (2002, clean[:half] + f" {passage} " + clean[half:]), (2003, f"{clean} {passage}")]
    found = toxicity.score_documents(frame(spark, [*rows, *long_]), labelled(spark, marks)).where("doc_id >= 2000").collect()
    assert {r.doc_id: r.predicted for r in found} == {2000: 0, 2001: 1, 2002: 1, 2003: 1}


def test_an_id_of_many_texts_teaches_once(spark):
    rows, marks = corpus(200)
    docs = frame(spark, [*rows, *([(7, "zz again")] * 500)])
    kept_ = toxicity.learning_rows(docs, labelled(spark, marks), toxicity.learns(), "text", "doc_id", "toxic").collect()
    assert len({row["_id"] for row in kept_}) == len(kept_) <= 200


def test_codes_are_remembered_up_to_a_bound():
    codes = toxicity.Codes()
    first = codes["word0"]
    for i in range(120_000):
        codes[f"word{i}"]
    assert len(codes) <= 50_000
    assert codes["word0"] == first
