"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A fingerprint is the k smallest distinct hashes of a text's five-word shingles, each six
bytes, in ascending order, in base64. A text with fewer distinct shingles than k is held
whole. Sketches of parts merge into the sketch of the whole by keeping the k smallest of the
union. From two sketches come resemblance and containment, from one the number of distinct
shingles: exact for texts held whole, else with a standard error of about 1/sqrt(k).

Next documents: a bounded sample of ids, each with a digest of its text, cuts the rows into
ranges, and each task walks one range in order. Ids of any type that Spark orders are compared
as they are. The first row of a range is sent to the range before as well, so that the last
row there has its next one; the first of all goes to the last range. No window runs over
all rows, and a task holds two texts beside its batch. Null ids, and an id of many texts, are cut
by the digests. Rows alike in id and text stay in one task, which streams them.

Defined results: null text is empty; its fingerprint is the empty string, which is alike to
itself (1.0) and to no other (0.0). A text of fewer than five words is one shingle. Order is
by id, null ids first, rows of one id by text. A single row is its own next. Other columns are
not read.
"""

from __future__ import annotations

import base64
import bisect
import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from lexiband.llm.common import pieces

SIZE, K, BITS, SAMPLED = 5, 128, 48, 30
_MULTIPLIER, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class Hashes(dict):
    """Word to hash, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


_hashes = Hashes()


def sketch(text: str, size: int = SIZE, k: int = K) -> np.ndarray:
    """The k smallest distinct shingle hashes, ascending. Words are in lower case."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    known = _hashes
    hashes = np.array([known[word] for word in words], np.uint64)
    span = min(size, len(words))
    shingles = np.full(len(words) - span + 1, span, np.uint64)
    for i in range(span):
        shingles = shingles * _MULTIPLIER + hashes[i : i + len(shingles)]
    shingles = (shingles ^ (shingles >> np.uint64(31))) * _MIX
    shingles = (shingles ^ (shingles >> np.uint64(29))) >> np.uint64(64 - BITS)
    if len(shingles) > 8 * k:  # repeats are few, so the smallest distinct are most often among these
        least = np.unique(np.partition(shingles, 4 * k)[: 4 * k])
        if len(least) >= k:
            return least[:k]
    return np.unique(shingles)[:k]


def packed(values: np.ndarray) -> str:
    """A sketch as text: six bytes a hash, big-endian, in base64."""
    raw = values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:]
    return base64.b64encode(raw.tobytes()).decode("ascii")


def unpacked(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, 6)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 2:] = raw
    return wide.view(">u8").reshape(-1).astype(np.uint64)


def merged(parts: list[np.ndarray], k: int = K) -> np.ndarray:
    """Sketch of all parts together."""
    return np.unique(np.concatenate(parts))[:k] if parts else np.empty(0, np.uint64)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimate of shared over all distinct shingles."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate([a, b]))
    new = np.concatenate([[True], both[1:] != both[:-1]])
    ends = np.flatnonzero(new)
    limit = ends[k] if len(ends) > k else len(both)
    union = min(len(ends), k)
    return float((limit - union) / union)


def distinct_shingles(a: np.ndarray, k: int = K) -> float:
    """Estimate of the number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) * float(1 << BITS) / float(a[k - 1])


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimate of the share of a's shingles that b has."""
    alike = resemblance(a, b, k)
    if not len(a) or alike == 0:
        return float(not len(a))
    return min(1.0, alike / (1 + alike) * (1 + distinct_shingles(b, k) / distinct_shingles(a, k)))


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = SIZE, k: int = K) -> DataFrame:
    """doc_id, fingerprint and the estimated number of distinct shingles."""
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[doc_id].dataType),
            T.StructField("fingerprint", T.StringType()),
            T.StructField("n_shingles", T.DoubleType()),
        ]
    )

    def made(batches):
        for batch in pieces(batches):
            found = [sketch(value or "", size, k) for value in batch.column("text").to_pylist()]
            columns = [
                batch.column("doc_id"),
                pa.array([packed(values) for values in found], pa.string()),
                pa.array([distinct_shingles(values, k) for values in found], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(made, schema)


def merge(sketched: DataFrame, key: str, k: int = K) -> DataFrame:
    """key, fingerprint of all rows of the key together.

    Tasks merge what they have first, so a key sends one row per task and none is hot.
    """
    rows = sketched.select(F.col(key).alias("key"), "fingerprint")
    schema = T.StructType([rows.schema["key"], rows.schema["fingerprint"]])

    def in_task(batches):
        held: dict = {}
        for batch in batches:
            for name, value in zip(batch.column("key").to_pylist(), batch.column("fingerprint").to_pylist()):
                held[name] = merged([held[name], unpacked(value)], k) if name in held else unpacked(value)
            if len(held) > 10_000:
                yield made(held)
                held = {}
        if held:
            yield made(held)

    def made(held: dict) -> pa.RecordBatch:
        names = pa.array(list(held), pa.from_numpy_dtype(np.int64) if all(isinstance(x, int) for x in held) else None)
        return pa.RecordBatch.from_arrays([names, pa.array([packed(x) for x in held.values()])], names=schema.names)

    def by_key(table):
        found = merged([unpacked(value) for value in table.column("fingerprint").to_pylist()], k)
        return pa.table({"key": table.column("key").slice(0, 1), "fingerprint": [packed(found)]})

    return rows.mapInArrow(in_task, schema).groupBy("key").applyInArrow(by_key, schema).withColumnRenamed("key", key)


def edited_likeness(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = SIZE, k: int = K
) -> DataFrame:
    """Fingerprints of each text and of the text whose last quarter is replaced by the start
    of the next document, and their likenesses."""
    id_type = docs.schema[doc_id].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", id_type),
            T.StructField("n_chars", T.LongType()),
            T.StructField("edited_sha256", T.StringType()),
            T.StructField("fingerprint", T.StringType()),
            T.StructField("edited_fingerprint", T.StringType()),
            T.StructField("near_edited", T.DoubleType()),
            T.StructField("near_next", T.DoubleType()),
        ]
    )

    def rows(batches):
        for batch in pieces(batches):
            values = [value or "" for value in batch.column("text").to_pylist()]
            yield from zip(batch.column("doc_id").to_pylist(), values, batch.column("extra").to_pylist())

    def compared(batches):
        out, now = [], None
        for name, body, extra in rows(batches):
            if extra and now is None:  # a repeated row
                continue
            own = sketch(body, size, k)
            if now is not None:
                out.append(_row(now, body, own, size, k))
                if len(out) >= 2_000:
                    yield _batch(out, schema, id_type)
                    out = []
            now = None if extra else (name, body, own)
        if out:
            yield _batch(out, schema, id_type)

    return _ranges(docs, text, doc_id).mapInArrow(compared, schema)


def _row(now: tuple, following: str, next_sketch: np.ndarray, size: int, k: int) -> tuple:
    name, body, own = now
    replaced = len(body) // 4
    edited = body[: len(body) - replaced] + following[:replaced]
    other = sketch(edited, size, k)
    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    near_edited, near_next = resemblance(own, other, k), resemblance(own, next_sketch, k)
    return name, len(body), digest, packed(own), packed(other), near_edited, near_next


def _batch(rows: list[tuple], schema: T.StructType, id_type: T.DataType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    return pa.RecordBatch.from_arrays(
        [pa.array(list(values), field.type) for values, field in zip(zip(*rows), to_arrow_schema(schema))],
        names=schema.names,
    )


def _ranges(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Rows (doc_id, text, extra) in partitions of successive ids, each in order and ended by
    the first row of the next, which is `extra` there."""
    count = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    digest = F.sha2("text", 256)
    # About SAMPLED keys a partition come to the driver, and one key a partition goes to the tasks.
    share = min(1.0, SAMPLED * count / max(1, docs.count()))
    keys = sorted(map(_key, rows.sample(share, 1).select("doc_id", digest.alias("digest")).collect()))
    cuts = sorted({keys[i * len(keys) // count] for i in range(1, count)} if keys else set())
    least = _least(rows, digest)
    # The first of all rows and the first of each range: both are rows that are there.
    firsts = [least, *(cut for cut in cuts if cut > least)] if least else []

    def placed(ids: pa.Array, digests: pa.Array) -> pa.Array:
        found = []
        for key in zip(ids.to_pylist(), digests.to_pylist()):
            key = _key(key)
            at = bisect.bisect_right(firsts, key) - 1
            found.append(2 * at + (firsts[at] == key))
        return pa.array(found, pa.int64())

    put = rows.withColumn("digest", digest).withColumn("put", arrow_udf(placed, "long")("doc_id", "digest"))
    put = put.withColumn("range", F.shiftright("put", 1).cast("int"))
    here = F.struct(F.col("range").alias("bucket"), F.lit(False).alias("extra"))
    before = F.pmod(F.col("range") - 1, F.lit(max(1, len(firsts))))
    there = F.struct(before.alias("bucket"), F.lit(True).alias("extra"))
    sent = put.select(
        "doc_id", "text", "digest", F.inline(F.when(F.col("put") % 2 == 1, F.array(here, there)).otherwise(F.array(here)))
    )
    dealt = sent.repartitionById(max(1, len(firsts)), F.col("bucket"))
    ordered = dealt.sortWithinPartitions("extra", F.asc_nulls_first("doc_id"), "digest")
    return ordered.select("doc_id", "text", "extra")


def _key(row: tuple) -> tuple:
    """A row's place in the order: null ids first, rows of one id by the digest of their text."""
    return row[0] is not None, row[0], row[1]


def _least(rows: DataFrame, digest: Column) -> tuple | None:
    """The first key of all, in two narrow passes."""
    ids = rows.agg(F.min("doc_id").alias("id"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).first()
    least = None if ids["nulls"] else ids["id"]
    found = rows.where(F.col("doc_id").eqNullSafe(F.lit(least))).agg(F.min(digest).alias("digest")).first()
    return None if found["digest"] is None else _key((least, found["digest"]))
