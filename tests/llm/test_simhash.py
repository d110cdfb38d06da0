import re

import numpy as np
import pytest
import xxhash

from lexiband.llm import simhash
from lexiband.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_bits(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """doc_id to (fingerprint, smallest reachable id)."""
    bits = [brute_bits(text) for _, text in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (bits[i] ^ bits[j]).bit_count() <= 4:
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        root = find(i)
        least[root] = min((x for x in (least.get(root), doc_id) if x is not None), default=None)
    return [(doc_id, f"{bits[i]:016x}", least[find(i)]) for i, (doc_id, _) in enumerate(rows)]


def result(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


TEXTS = ["", " \t\n", "One", "one two THREE", "a b c d e", "Ä ä\x85x y z", "A B C D E", None, "x " * 50_000]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert simhash.simhash(text or "") & (1 << 64) - 1 == brute_bits(text)


def test_spark_hashes_alike(spark):
    row = spark.sql("SELECT xxhash64('one two three four') AS h").first()
    assert row.h & (1 << 64) - 1 == xxhash.xxh64_intdigest(b"one two three four", 42)


def test_every_pair_within_the_radius_collides():
    rng = np.random.default_rng(0)
    masks = np.array(simhash.covering_masks(), np.int64).view(np.uint64)
    assert len(masks) == 31
    for _ in range(20_000):
        flips = rng.choice(64, size=rng.integers(0, 5), replace=False)
        difference = np.uint64(sum(1 << int(b) for b in flips))
        assert (masks & difference == 0).any()


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(simhash.near_duplicates(docs)) == sorted(brute_components(rows), key=str)


def near_copies(n, seed):
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(n):
        words = list(base)
        for at in rng.integers(0, 400, rng.integers(0, 6)):
            words[at] = f"v{rng.integers(1000)}"
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("block", [7, 1 << 14])
def test_large_buckets_lose_no_link(spark, block):
    rows = list(enumerate(near_copies(150, 3)))
    nodes = sorted({brute_bits(text) for _, text in rows})
    signed = [b - (1 << 64) if b >> 63 else b for b in nodes]
    found = simhash.links(spark.createDataFrame([(b,) for b in signed], "bits BIGINT"), block=block).collect()
    group = {b: b for b in nodes}

    def find(b):
        while group[b] != b:
            b = group[b]
        return b

    for row in found:
        a, b = row.src & (1 << 64) - 1, row.dst & (1 << 64) - 1
        group[find(a)] = find(b)
    want = {b: b for b in nodes}

    def find_want(b):
        while want[b] != b:
            b = want[b]
        return b

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if (a ^ b).bit_count() <= 4:
                want[find_want(a)] = find_want(b)
    same = {(a, b) for a in nodes for b in nodes if find(a) == find(b)}
    assert same == {(a, b) for a in nodes for b in nodes if find_want(a) == find_want(b)}
    assert len(found) < 31 * len(nodes) * (1 if block > 100 else 30)


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(None, "a b"), (None, "a b"), (4, "c d"), (None, "c d"), (2, None), (9, ""), (9, "")],
        [(i, "same words here again" if i % 3 else f"text {i} of {i * 7} own {i * 13}") for i in range(90)],
    ],
)
def test_edge_cases(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id BIGINT, text STRING, bits INT, root STRING")
    assert result(simhash.near_duplicates(docs)) == sorted(brute_components(rows), key=str)
    stays = simhash.drop_near_duplicates(docs)
    assert stays.columns == docs.columns
    want = [i for i, _, least in brute_components(rows) if i is None or i == least]
    assert sorted((r.doc_id for r in stays.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize(
    "links",
    [[], [(1, 1)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 80)], [(5, 3), (3, 9), (7, 8), (9, 5), (8, 7)]],
)
def test_components(spark, links):
    group = {x: x for link in links for x in link}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        group[max(a, b)] = min(a, b)
    want = {x: find(x) for link in links for x in link if link[0] != link[1]}
    found = components(spark.createDataFrame(links, "src BIGINT, dst BIGINT")).collect()
    assert {r.node: r.root for r in found} == want
    assert len(found) == len(want)
