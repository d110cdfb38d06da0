"""SimHash near-dedup by covering locality-sensitive hashing.

A fingerprint bit is set if it is set in over half of the hashes of a text's word shingles.
Two fingerprints are linked if they differ in at most `radius` bits. To find all such pairs,
each bit gets a vector of radius+1 coordinates over GF(2), and each of the 2^(radius+1)-1
nonzero vectors v makes a table: the table's mask keeps the bits whose vector has an odd
product with v. The vectors of `radius` differing bits span less than the whole space, so
some v is orthogonal to all of them: that table's mask hides every differing bit, and the
pair is equal there. No pair within the radius is missed.

Equal fingerprints are one node. A bucket of two is compared by Spark. Larger buckets are
dealt out as pairs of blocks of BLOCK fingerprints at most, and a task walks each pair of
blocks from member to near member, which gives a tree of links and never all pairs.

Defined results: null counts as empty; a text without words has fingerprint zero and is
linked like any other. A text of fewer words than a shingle is one shingle. Rows with a null
id take part; a group has a null component only if none of its rows has an id. Repeated ids
get a row each. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiband.llm.common import kept, pieces, texts_of
from lexiband.llm.components import components

SHINGLE, RADIUS, SEED, BLOCK = 4, 4, 42, 1 << 14


def simhash(text: str, size: int = SHINGLE, seed: int = SEED) -> int:
    """Fingerprint of one text, signed as Spark's bigint is."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII case and white space only
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    span = min(size, len(words)) - 1
    firsts, lasts = starts[: len(words) - span], ends[span:]
    digest, counts, step = xxhash.xxh64_digest, np.zeros(64, np.int64), 1 << 15
    for i in range(0, len(firsts), step):  # in steps, as 64 bytes are unpacked for a shingle
        some = zip(firsts[i : i + step].tolist(), lasts[i : i + step].tolist())
        hashes = np.frombuffer(b"".join([digest(joined[a:b], seed) for a, b in some]), np.uint8)
        counts += np.unpackbits(hashes.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * counts > len(firsts)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = SHINGLE) -> DataFrame:
    """doc_id and `bits`, the fingerprint, of every row."""
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("bits", T.LongType())]
    )

    def hashed(batches):
        for batch, texts in texts_of(pieces(batches), "text"):
            bits = pa.array([simhash(text, size) for text in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), bits], names=["doc_id", "bits"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(hashed, schema)


def covering_masks(radius: int = RADIUS) -> list[int]:
    """The masks of all tables, as signed 64-bit numbers."""
    vectors = range(1, 1 << (radius + 1))
    masks = []
    for v in vectors:
        mask = sum(((i % (1 << (radius + 1))) & v).bit_count() % 2 << i for i in range(64))
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def links(nodes: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """src, dst: links that connect what pairs within `radius` connect.

    `nodes` has each fingerprint once, as `bits`.
    """
    masked = [F.col("bits").bitwiseAND(F.lit(mask)) for mask in covering_masks(radius)]
    rows = nodes.select("bits", F.posexplode(F.array(*masked)).alias("tab", "key"))
    buckets = kept(
        rows.groupBy("tab", "key")
        .agg(F.count("*").alias("n"), F.min("bits").alias("src"), F.max("bits").alias("dst"))
        .where("n > 1")
    )
    near = F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= radius
    pairs = buckets.where((F.col("n") == 2) & near).select("src", "dst")

    # A fingerprint meets every block of its bucket: one group of rows for each pair of blocks.
    parts = F.ceil(F.col("n") / block)
    mine = F.pmod(F.xxhash64("bits"), parts)
    other = F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))
    members = (
        rows.join(buckets.where("n > 2").select("tab", "key", "n"), ["tab", "key"])
        .select("tab", "key", "bits", mine.alias("mine"), other.alias("other"))
        .select("tab", "key", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "bits")
    )
    group = ["tab", "key", "low", "high"]
    grouped = members.repartition(*group).sortWithinPartitions(*group)

    def walk(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            keys = [table.column(name).to_numpy() for name in group]
            changes = reduce(np.logical_or, [key[1:] != key[:-1] for key in keys])
            cuts = [0, *(np.flatnonzero(changes) + 1).tolist()]
            yield from _trees(table, cuts, radius)
            held = table.slice(cuts[-1]) if table.num_rows else None
        if held is not None and held.num_rows:
            yield from _trees(held, [0, held.num_rows], radius)

    walked = grouped.mapInArrow(walk, "src bigint, dst bigint")
    return pairs.unionByName(walked)


def _trees(table: pa.Table, cuts: list[int], radius: int):
    bits = table.column("bits").to_numpy().view(np.uint64)
    found = [tree(bits[a:b], radius) for a, b in zip(cuts[:-1], cuts[1:])]
    if found:
        src, dst = (np.concatenate(side).view(np.int64) for side in zip(*found))
        yield pa.RecordBatch.from_arrays([pa.array(src), pa.array(dst)], names=["src", "dst"])


def tree(bits: np.ndarray, radius: int, step: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """A star for each set of fingerprints connected within `radius`."""
    src, dst = [bits[:0]], [bits[:0]]
    left = bits
    while len(left) > 1:
        seed, left, front = left[0], left[1:], left[:1]
        while len(front) and len(left):
            near = np.zeros(len(left), dtype=bool)
            for i in range(0, len(front), step):
                far = np.bitwise_count(left[None, :] ^ front[i : i + step, None])
                near |= (far <= radius).any(axis=0)
            front, left = left[near], left[~near]
            src.append(front)
            dst.append(np.full(len(front), seed, dtype=bits.dtype))
    return np.concatenate(src), np.concatenate(dst)


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """doc_id, fingerprint (hex), component_id: the smallest doc_id reachable by links."""
    hashed = kept(fingerprints(docs, text, doc_id, size))
    nodes = kept(hashed.groupBy("bits").agg(F.min("doc_id").alias("least_id")))
    found = kept(components(links(nodes, radius)).withColumnRenamed("node", "bits"))
    least = found.join(nodes, "bits").groupBy("root").agg(F.min("least_id").alias("component_id"))
    linked = found.join(least, "root").select("bits", "component_id")
    classes = nodes.join(linked, "bits", "left").select(
        "bits", F.coalesce("component_id", "least_id").alias("component_id")
    )
    return hashed.join(classes, "bits").select(
        F.col("doc_id").alias(doc_id),
        F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def drop_near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """The rows of `docs` whose id stands for its component, with all their columns.

    Rows are told apart by id: those with a null id stay, and so does every row of an id that
    stands for a component. Only the ids that go are moved to the rows, not the rows.
    """
    groups = near_duplicates(docs, text, doc_id, size, radius)
    stands = F.max(F.col(doc_id) == F.col("component_id"))
    gone = kept(groups.where(F.col(doc_id).isNotNull()).groupBy(doc_id).agg(stands.alias("_stands")))
    return docs.join(gone.where("NOT _stands").select(doc_id), doc_id, "left_anti").select(*docs.columns)
