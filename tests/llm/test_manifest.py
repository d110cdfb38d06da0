"""Merkle manifest: against a plain tree, at the sizes where levels begin and end."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from lexiband.llm import manifest
from lexiband.llm.common import release

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
LOWER = str.maketrans(manifest.CAPITALS, manifest.SMALL)


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc):
    doc_id, text, lang, source, n_chars = doc
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(nodes, paths):
    """`nodes` are (digest, rows below); the paths of the rows get a step at every level."""
    while len(nodes) > 1:
        above = []
        for at in range(0, len(nodes), 8):
            run = nodes[at : at + 8]
            for i, (_, below) in enumerate(run):
                step = "".join(d for d, _ in run[:i]), "".join(d for d, _ in run[i + 1 :])
                for row in below:
                    paths[row].append(step)
            above.append((h("".join(d for d, _ in run)), [row for _, below in run for row in below]))
        nodes = above
    return nodes[0]


def expected(docs):
    order = sorted(
        range(len(docs)), key=lambda i: (docs[i][0] is not None, docs[i][0] or 0, leaf(docs[i]))
    )
    langs = sorted({doc[2] for doc in docs}, key=lambda lang: (lang is not None, (lang or "").encode()))
    paths, tops = [[] for _ in docs], []
    for lang in langs:
        tops.append(tree([(leaf(docs[i]), [i]) for i in order if docs[i][2] == lang], paths))
    subroots = dict(zip(langs, (digest for digest, _ in tops)))
    root = tree(tops, paths)[0] if tops else None
    out = []
    for doc, path in zip(docs, paths):
        fold = leaf(doc)
        if doc[0] is not None and zlib.crc32(str(doc[0]).encode()) % 3 == 0:
            fold = leaf((doc[0], doc[1] and doc[1].translate(LOWER), *doc[2:]))
        for before, after in path:
            fold = h(before + fold + after)
        proof = h("".join(before + after for before, after in path))
        out.append((doc[0], leaf(doc), subroots[doc[2]], root, proof, fold, fold == root))
    return sorted(out, key=repr)


def found(spark, docs):
    df = spark.createDataFrame(docs, SCHEMA)
    rows = sorted(map(tuple, manifest.document_proofs(df).collect()), key=repr)
    release(spark)
    return rows


@pytest.mark.parametrize("sizes", [[1], [8], [9, 1, 64, 2], [65, 513, 7]])
def test_against_a_plain_tree(spark, sizes):
    docs = [
        (1000 * g + i, f"Text {i} ÉTÉ", [None, "", "de", "en"][g], "s", i)
        for g, size in enumerate(sizes)
        for i in range(size)
    ]
    assert found(spark, docs) == expected(docs)


def test_groups_of_several_blocks(spark, monkeypatch):
    """Blocks of 64 leaves, of 64 blocks: three tables above one another."""
    monkeypatch.setattr(manifest, "DIGITS", 2)
    docs = [(i, f"T{i}", "en" if i % 20 else f"l{i}", None, i) for i in range(4500)]
    assert found(spark, docs) == expected(docs)
    monkeypatch.setattr(manifest, "PATHS", 0)  # no broadcast of paths
    assert found(spark, docs) == expected(docs)


def test_nulls_ties_and_repeated_rows(spark):
    docs = [
        (None, None, None, None, None),
        (None, "A", None, None, 1),
        (5, "A", "en", "-", 1),
        (5, "B", "en", "1:-", 1),
        (5, "B", "en", "1:-", 1),
        (6, "", "en", "", 0),
        (7, "LONG " * 400_000, "en", "s", 2_000_000),
    ]
    rows = found(spark, docs)
    assert rows == expected(docs)
    assert leaf(docs[0]) != leaf(docs[1])
    # The three equal leaves of id 5 and the one beside them are leaves of their own.
    assert sum(row[0] == 5 for row in rows) == 3


def test_tampering_shows(spark):
    docs = [(i, "Capital" if i % 2 else "small", "en", "s", 7) for i in range(100)]
    for row in found(spark, docs):
        hit = zlib.crc32(str(row[0]).encode()) % 3 == 0
        assert row[6] == (not hit or docs[row[0]][1] == "small")


def test_empty_table_and_clashing_columns(spark):
    assert found(spark, []) == []
    docs = [(i, "T", "en", "s", 1) for i in range(10)]
    names = ["key", "n", "rank", "digest", "held", "path", "root", "block", "kids", "forged"]
    df = spark.createDataFrame(docs, SCHEMA).withColumns({name: F.lit(1) for name in names})
    assert sorted(map(tuple, manifest.document_proofs(df).collect()), key=repr) == expected(docs)


def test_a_hot_group_is_dealt_out(spark):
    """Leaves of one language meet in blocks by hash; none of the shuffles is by language alone."""
    docs = spark.range(20_000).selectExpr("id AS doc_id", "'x' AS text", "'en' AS lang", "'s' AS source", "id AS n_chars")
    leaves = docs.selectExpr("if(doc_id < 0, 'de', lang) AS key", "20000L + least(doc_id, 0L) AS n", "doc_id AS rank", "sha2(text, 256) AS digest", "struct(doc_id) AS held")
    blocks = manifest.rolled(leaves)
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning" in plan and "block" in plan[plan.index("hashpartitioning") :][:60]
    assert blocks.count() == 5 and blocks.agg(F.max(F.size("kids"))).first()[0] == 8
