"""Merkle manifest of a table: a root that fixes every row, and a proof for each row.

A row is a leaf, the SHA-256 of its fields. The leaves of a group (a language, say) ascend by
id, and while there is more than one, every FAN successive ones become their hash; what
remains is the group's subroot. The subroots become the root in the same way.

A leaf's rank in its group is written in digits of base FAN. Blocks of FAN ** DIGITS successive
ranks are dealt out by hash, one shuffle of leaves without text; in a block the last digit is
grouped away, then the one before it, and so on, each time nesting the children's structs in
their parent's. The blocks' digests are the nodes of the next, FAN ** DIGITS times smaller
table, until every group is one block. On the way down a block is met by the one row that has
the siblings above it; within the block no join is needed: the nested children are transformed
into steps of proofs and exploded, level by level.

Bounds: a task holds a block, FAN ** DIGITS leaves, whatever the size of its group. Ranks come
from a distributed sort. The rows that blocks meet are broadcast up to PATHS of them, and else
joined by group and block, which is a key of both sides.

Defined results: a null field is told from every value. Null ids come first; rows of one id
go by their leaf, and equal rows are leaves of their own. A null group comes first. The only
leaf of a group is its subroot, the only subroot the root; a proof without siblings is the
hash of nothing. An empty table gives no rows. Columns that are not named are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiband.llm.common import kept, small, stored
from lexiband.operators.ranking import with_rank

FAN, DIGITS, PATHS = 8, 4, 10_000
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def hashed(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """A value with its number of bytes before it, or `-` for null, so that no two rows read alike."""
    written = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(written).cast("string"), F.lit(":"), written), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    return hashed(F.concat(*(field(value) for value in fields)))


def rolled(nodes: DataFrame) -> DataFrame:
    """key, n, block, digest and the nested `kids` of each block.

    `nodes` has key, n (the nodes of the key), rank from 0, digest, and `held`, what a node
    carries along.
    """
    places = [f"d{i}" for i in range(DIGITS)]
    rows = nodes.select(
        "key",
        "n",
        F.floor(F.col("rank") / FAN**DIGITS).alias("block"),
        *(F.floor(F.col("rank") / FAN**i).cast("long").bitwiseAND(F.lit(FAN - 1)).alias(d) for i, d in enumerate(places)),
        "digest",
        "held",
    ).repartition("key", "block")
    rows = rows.withColumn("node", F.struct(F.col("d0").alias("place"), "digest", "held"))
    for level in range(DIGITS):
        above = places[level + 1 :]
        rows = rows.groupBy("key", "n", "block", *above).agg(F.array_sort(F.collect_list("node")).alias("kids"))
        parent = F.when(F.col("n") > FAN**level, hashed(F.array_join("kids.digest", ""))).otherwise(
            F.col("kids")[0]["digest"]
        )
        rows = rows.withColumn("digest", parent)
        if above:
            rows = rows.withColumn("node", F.struct(F.col(above[0]).alias("place"), "digest", "kids"))
    return rows.select("key", "n", "block", "digest", "kids")


def trees(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Blocks of the nodes, blocks of those blocks, and so on until every key has one block."""
    levels = []
    while True:
        levels.append(stored(rolled(nodes), name))
        blocks = levels[-1]
        if not blocks.agg(F.max("block").alias("last")).first()["last"]:
            return levels
        nodes = blocks.select(
            "key",
            F.ceil(F.col("n") / FAN**DIGITS).alias("n"),
            F.col("block").alias("rank"),
            "digest",
            F.struct("block").alias("held"),
        )


def child(level: int):
    """What a kid at a level becomes: its content, its digest, and the path from it up."""
    inner = "kids" if level else "held"

    def made(kid: Column, i: Column) -> Column:
        digests = F.col("kids.digest")
        step = F.struct(
            F.array_join(F.slice(digests, F.lit(1), i), "").alias("before"),
            F.array_join(F.slice(digests, i + 2, F.lit(FAN)), "").alias("after"),
        )
        path = F.when(F.col("n") > FAN**level, F.concat(F.array(step), F.col("path"))).otherwise(F.col("path"))
        return F.struct(kid[inner].alias(inner), kid["digest"].alias("digest"), path.alias("path"))

    return made


def exploded(blocks: DataFrame, carried: Sequence[str]) -> DataFrame:
    """The nodes of the blocks: what they hold, their digest, and the `path` from them up, whose
    steps have the digests to the left and to the right. `blocks` has `path` from the block up."""
    rows = blocks
    for level in reversed(range(DIGITS)):
        rows = rows.select(*carried, "n", F.inline(F.transform("kids", child(level))))
    return rows.select(*carried, "held.*", "digest", "path")


def descended(levels: Sequence[DataFrame], tops: DataFrame, carried: Sequence[str]) -> DataFrame:
    """The nodes at the bottom of `levels`. `tops` has `key`, the columns `carried` and the
    `path` above it for every key."""
    above = tops.withColumn("block", F.lit(0).cast("long"))
    for i, blocks in reversed(list(enumerate(levels))):
        met = blocks.select("key", "n", "block", "kids").join(small(kept(above), PATHS), ["key", "block"])
        above = exploded(met, ["key", *carried])
        if i:
            above = above.select("key", *carried, F.col("block"), "path")
    return above


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its path come to."""
    return F.aggregate(path, start, lambda held, step: hashed(F.concat(step["before"], held, step["after"])))


def siblings(path: Column) -> Column:
    """Hash of all digests of a path, from the leaf's level up, left to right."""
    return hashed(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), ""))


def manifest(
    rows: DataFrame,
    fields: Sequence[Column],
    group: str,
    order: str,
    forged: Column | None = None,
) -> DataFrame:
    """`order`, leaf, subroot, root, `path` and `forged` of every row.

    `fields` are hashed to the leaf. `forged` is another leaf to be checked against the root,
    null for the row's own.
    """
    other = F.lit(None).cast("string") if forged is None else forged
    leaves = rows.select(
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("key"),
        F.col(order).alias("_order"),
        leaf(fields).alias("digest"),
        other.alias("forged"),
        F.monotonically_increasing_id().alias("_row"),  # parts equal rows in the sort
    )
    by_key = [F.asc("key"), F.asc_nulls_first("_order"), F.asc("digest"), F.asc("_row")]
    ranked = with_rank(leaves, by_key).drop("n")
    sizes = kept(ranked.groupBy("key").agg(F.min("rank").alias("first"), F.count("*").alias("n")))
    nodes = ranked.join(small(sizes), "key").select(
        "key", "n", (F.col("rank") - F.col("first")).alias("rank"), "digest", F.struct("_order", "forged").alias("held")
    )
    groups = trees(nodes, "manifest-leaves")
    subroots = with_rank(groups[-1].select("key", "digest"), [F.asc("key")])
    tops = trees(
        subroots.select(
            F.lit("").alias("key"),
            "n",
            (F.col("rank") - 1).alias("rank"),
            "digest",
            F.struct(F.col("key").alias("group")).alias("held"),
        ),
        "manifest-groups",
    )
    nothing = F.array().cast("array<struct<before:string,after:string>>")
    root = tops[-1].select("key", F.col("digest").alias("root"), nothing.alias("path"))
    paths = descended(tops, root, ["root"]).select(
        F.col("group").alias("key"), F.col("digest").alias("subroot"), "root", "path"
    )
    proved = descended(groups, paths, ["subroot", "root"])
    return proved.select(F.col("_order").alias(order), F.col("digest").alias("leaf"), "subroot", "root", "path", "forged")


def checked(proved: DataFrame, order: str) -> DataFrame:
    """Each row of `manifest` with the hash of its proof, the root it folds to, and whether
    that is the root."""
    start = F.coalesce(F.col("forged"), F.col("leaf"))
    return proved.select(
        order,
        "leaf",
        "subroot",
        "root",
        siblings(F.col("path")).alias("proof_sha256"),
        folded(start, F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def lowered(text: Column) -> Column:
    """A-Z in lower case, and no other character changed."""
    return F.translate(text, CAPITALS, SMALL)


def document_proofs(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every document. Where
    3 divides the crc32 of the id, a text in lower case is held against the proof."""
    fields = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars", "text")]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    forged = F.when(tampered, leaf([*fields[:4], lowered(fields[4])]))
    return checked(manifest(docs, fields, "lang", "doc_id", forged), "doc_id")
