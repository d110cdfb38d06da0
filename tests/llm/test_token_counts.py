import time

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lexiband.llm import token_counts

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
TEXTS = ["", None, "one line", "Öl 漢字 😀\n\n\nnext   line\n", "a\nb\nc", "x" * 20_000, "\n" * 9, "é ퟿\n z", "two words " * 20_000]


def brute(text, sections):
    """Tokens of each section by decoding one after the other."""
    text = text or ""
    spans = token_counts.spans(PATH, PATTERN)
    of_byte = [i for i, c in enumerate(text) for _ in c.encode()]
    at, counts, total = 0, {}, 0
    for token in spans.encoding.encode_ordinary(text):
        size = len(spans.encoding.decode_single_token_bytes(token))
        chars = range(of_byte[at], of_byte[at + size - 1] + 1)
        at, total = at + size, total + 1
        owners = [next((k for k, (a, b) in enumerate(sections) if a <= c < b), None) for c in chars]
        runs = []  # of successive characters of one section or one gap
        for c, owner in zip(chars, owners):
            fresh = not runs or runs[-1][0] != owner or any(b == c or a == c for a, b in sections if b > a)
            if fresh:
                runs.append([owner, 0])
            runs[-1][1] += 1
        best = max(runs, key=lambda r: r[1])[0]
        counts[-1 if best is None else best] = counts.get(-1 if best is None else best, 0) + 1
    return total, counts


def lines(text):
    out, at = [], 0
    for line in (text or "").split("\n"):
        out.append((at, at + len(line)))
        at += len(line) + 1
    return out


def frame(spark, texts):
    rows = [(i if i else None, t, 1, "s") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, section INT, sections STRING")


def test_lines_equal_brute_force(spark):
    texts = [t if t is None or len(t) < 5000 else t[:3000] for t in TEXTS]
    found = token_counts.section_tokens(frame(spark, texts), PATH, PATTERN).collect()
    for i, text in enumerate(texts):
        mine = [r for r in found if r.doc_id == (i if i else None)]
        total, counts = brute(text, lines(text))
        assert {r.section: r.tokens for r in mine if r.tokens} == counts
        assert {r.doc_tokens for r in mine} == {total} and sum(r.tokens for r in mine) == total
        assert [(r.start, r.end) for r in sorted(mine, key=lambda r: r.section) if r.section >= 0] == lines(text)


def test_given_sections(spark):
    text = "alpha beta gamma delta"
    for sections in ([], [(0, 3)], [(2, 8), (8, 8), (9, 15)], [(0, 22)], [(0, 7), (7, 22)], [(5, 3)]):
        column = F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("end")) for a, b in sections])
        column = column if sections else F.lit(None).cast("array<struct<start:int,end:int>>")
        found = token_counts.section_tokens(frame(spark, [text]), PATH, PATTERN, sections=column).collect()
        assert {r.section: r.tokens for r in found if r.tokens} == brute(text, sections)[1]


def test_counts_add_up(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = token_counts.section_tokens(docs, PATH, PATTERN).groupBy("doc_id").agg(
        F.sum("tokens").alias("tokens"), F.max("doc_tokens").alias("doc_tokens")
    )
    assert found.where("tokens <> doc_tokens").count() == 0
    encode = token_counts.spans(PATH, PATTERN).encoding.encode_ordinary
    want = {r.doc_id: len(encode(r.text)) for r in docs.collect()}
    assert {r.doc_id: r.doc_tokens for r in found.collect()} == want


def test_long_and_empty(spark):
    found = token_counts.section_tokens(frame(spark, TEXTS), PATH, PATTERN)
    assert found.where("doc_id IS NULL").select("section", "tokens").collect() == [(0, 0)]
    assert token_counts.section_tokens(frame(spark, []), PATH, PATTERN).count() == 0


def test_long_white_space_has_the_ids_of_the_whole_text():
    """Runs that the tokenizer itself still takes, against its own ids, on every side of a cut."""
    spans = token_counts.spans(PATH, PATTERN)
    for blank in (" ", "\n", "\t", "\u00a0", "\u3000", " \n", "\r\n", "\x85 "):
        run = blank * 1500
        for text in (run, "a" + run, run + "b", f"it's{run}b,c{run}5{run}", run + "\x1c" + run, f"x {run}\n'll {run}"):
            assert spans.ids(text).tolist() == spans.encoding.encode_ordinary(text)


@pytest.mark.parametrize("part", [" ", "\n", "\t ", "\u3000", "a", "7", "!", "\u00e9", "\u6f22", "\U0001f600", "a "])
def test_a_million_of_each_kind(spark, part):
    """No text may crash the job or hold it up."""
    docs = [(1, part * (1_000_000 // len(part))), (2, f"begin {part * (1_000_000 // len(part))} end")]
    df = spark.createDataFrame(docs, "doc_id BIGINT, text STRING")
    start = time.monotonic()
    found = token_counts.section_tokens(df, PATH, PATTERN).groupBy("doc_id").agg(F.sum("tokens").alias("n"), F.max("doc_tokens").alias("all"))
    assert all(row.n == row["all"] > 0 for row in found.collect())
    assert time.monotonic() - start < 30
