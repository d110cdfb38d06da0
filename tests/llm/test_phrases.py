"""Phrase mining: the index against plain counting, the operator against a plain model."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiband.llm import phrases
from lexiband.llm.common import release

SCHEMA = "doc_id BIGINT, text STRING, lang STRING"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
        yield [word for word in re.split(r"[ \t]+", piece) if word]


def expected(docs, longest=3, least=10, covered=50, best=2000):
    out = []
    for lang in {"und" if doc[2] is None else doc[2] for doc in docs}:
        f = Counter()
        for doc in docs:
            if ("und" if doc[2] is None else doc[2]) == lang:
                for words in pieces(doc[1]):
                    for size in range(1, longest + 1):
                        f.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
        n = sum(count for words, count in f.items() if len(words) == 1)
        candidates = {words: a for words, a in f.items() if len(words) > 1 and a >= least}
        inside = Counter()
        for words, a in candidates.items():
            for size in range(2, len(words)):
                for i in range(len(words) - size + 1):
                    part = words[i : i + size]
                    inside[part] = max(inside[part], a)
        rows = []
        for words, a in candidates.items():
            if inside[words] * 100 >= covered * a and inside[words]:
                continue
            score, _, l, r = min(
                (1_000_000 * a * a // (f[words[:k]] * f[words[k:]]), k, f[words[:k]], f[words[k:]])
                for k in range(1, len(words))
            )
            rows.append((-score, -a, " ".join(words).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def found(spark, docs, **settings):
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    out = phrases.collocations(df, **settings)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    rows = sorted(map(tuple, out.collect()))
    release(spark)
    return rows


def invented(seed, n=60, words=12, length=40):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["Ä", "the", "THE", "of ", "x'y"]
    marks = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", " ! ", "\r\n", "\x85"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = []
    for i in range(n):
        text = "".join(w + rng.choice(marks) for w in rng.choices(vocabulary, weights, k=rng.randrange(length)))
        docs.append((i, text, rng.choice(["en", "en", "de", None])))
    return docs


@pytest.mark.parametrize("seed", range(4))
def test_index_against_plain_counting(seed):
    rng = np.random.default_rng(seed)
    row = np.concatenate([[0], rng.integers(0, 6, 300), [0]]).astype(np.int32)
    index = phrases.Index.of(row, 6, depth=4)
    text = row.tolist()

    def count(phrase):
        return sum(text[i : i + len(phrase)] == list(phrase) for i in range(len(text)))

    shown = np.arange(1, 6)[:, None]
    for step in ("right", "left", "right"):
        which, word, counts = getattr(index, step)(shown)
        sides = [shown[which], word[:, None]] if step == "right" else [word[:, None], shown[which]]
        shown = np.concatenate(sides, 1)
        for half, phrases_ in ((index.forward, shown[:, ::-1]), (index.backward, shown)):
            low, high = half.interval(phrases_)
            assert (high - low).tolist() == counts.tolist() == [count(phrase) for phrase in shown.tolist()]
        every = {tuple(text[i : i + shown.shape[1]]) for i in range(len(text) - shown.shape[1] + 1)}
        assert {tuple(x) for x in shown.tolist()} == {x for x in every if 0 not in x}


def test_numbers_survive_packing():
    for kind in (np.int32, np.int64):
        values = np.array([0, 1, -1, 2**31 - 1, 77], kind)
        assert phrases.unpacked(phrases.packed(values), kind).tolist() == values.tolist()


def test_many_symbols_are_sorted_in_steps():
    row = np.concatenate([[0], np.random.default_rng(1).integers(0, 50, 500), [0]]).astype(np.int32)
    plain = phrases.transformed(row, 50, 4)
    huge = phrases.transformed(row, 1 << 20, 4)
    order = sorted(range(len(row)), key=lambda i: ([int(row[(i + j) % len(row)]) for j in range(4)], i))
    assert plain.tolist() == huge.tolist() == [int(row[i - 1]) for i in order]


@pytest.mark.parametrize("longest, words", [(2, 1 << 21), (3, 1 << 21), (3, 50), (4, 100)])
def test_against_a_plain_model(spark, longest, words):
    docs = invented(longest)
    assert found(spark, docs, longest=longest, least=4, words=words) == expected(docs, longest, 4)


def test_phrases_that_one_number_does_not_hold(spark, monkeypatch):
    monkeypatch.setattr(phrases, "keys", lambda length, base: phrases.names(length))
    docs = invented(5)
    assert found(spark, docs, least=4, words=100) == expected(docs, 3, 4)


def test_best_ties_and_cover(spark):
    docs = invented(9, n=120)
    for best, covered in ((5, 50), (2000, 90), (3, 1)):
        assert found(spark, docs, best=best, covered=covered, least=3) == expected(docs, 3, 3, covered, best)


def test_products_pass_64_bits(spark):
    docs = [(1, "a b " * 4_000_000 + "c. a c", "en"), (2, "a", "en")]
    assert found(spark, docs) == expected(docs)


def test_nulls_empty_and_repeated_rows(spark):
    docs = [(None, None, None), (1, "", "en"), (2, " .,\n", None), (None, "New York. " * 6, None), (3, "new york", "und")]
    docs += [(4, "new york", None)] * 5 + [(5, "one piece of words " * 30_000, ""), (6, "x" * 1_500_000 + " y", "en")]
    assert found(spark, docs, words=1000) == expected(docs)
    assert found(spark, []) == []


def test_long_pieces_are_read_in_parts(monkeypatch):
    monkeypatch.setattr(phrases, "PART", 16)
    piece = b"short words " * 5 + b"y" * 40 + b" and more" + b"z" * 20
    assert b" ".join(phrases.parts(piece)).split() == piece.split()
    shard = phrases.Shard()
    shard.add(piece)
    assert len(shard.row) == len(piece.split()) + 2


def test_clashing_columns(spark):
    docs = invented(2)
    df = spark.createDataFrame(docs, SCHEMA)
    more = df.withColumns({name: F.lit(1) for name in ("grp", "w0", "n", "shard", "phrase", "score", "rank", "word", "own")})
    assert sorted(map(tuple, phrases.collocations(more).collect())) == expected(docs)
