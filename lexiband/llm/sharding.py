"""K-d tree partitioning into shards of near equal bytes.

A row's place is its metadata: size, language, source and id, each as a whole number. The
tree splits a node, which is to become k shards, at the weighted median (more exactly, at
the share of bytes that its left k // 2 shards need) along the dimension in which the node is
widest, measured against the width of all rows, until every leaf is one shard.

The median is found exactly, without bringing rows together: bytes are summed by node and by
the next DIGIT bits of the coordinate, the sums say into which bin the cut falls, and only
that bin is looked at in the next round, until its bytes are within the tolerance. Rows with
one coordinate are told apart by a hash of their text and, if one group of equal texts holds
more than the tolerance, by a hash of their id. So equal texts with equal metadata stay
together unless the group is too large for that, and a hot value is split like any other.
The driver sees at most (nodes of a level) x 2^DIGIT sums.

Defined results: null text has size 1 and the checksum of the empty string; null metadata
has the smallest coordinate. Null ids are rows like others. Repeated rows are told apart by
their place in the table, which is fixed once. No rows: no result rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexiband.llm.common import kept

DIGIT, COORDINATE, TOLERANCE = 10, 40, 0.002


class Node(NamedTuple):
    first: int  # number of its first shard, which names it
    shards: int


def ordinal(value: Column) -> Column:
    """Strings in binary order by their first five bytes."""
    padded = F.rpad(F.substring(F.hex(F.coalesce(value.cast("string"), F.lit("")).cast("binary")), 1, 10), 10, "0")
    return F.conv(padded, 16, 10).cast("bigint")


def quantity(value: Column) -> Column:
    """Numbers on a logarithmic scale."""
    return F.floor(F.log2(F.greatest(F.coalesce(value.cast("double"), F.lit(0.0)), F.lit(0.0)) + 1) * (1 << 33)).cast("bigint")


def shards(
    docs: DataFrame,
    dims: Mapping[str, Column],
    count: int,
    text: str = "text",
    doc_id: str = "doc_id",
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row. `dims` are whole numbers of at
    most COORDINATE bits."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    size = F.octet_length(body).cast("bigint") + 1
    names = [f"c{i}" for i in range(len(dims))]
    rows = docs.select(
        F.col(doc_id).alias("id"),
        size.alias("size"),
        F.crc32(body).alias("crc"),
        F.xxhash64(body).bitwiseAND(F.lit((1 << COORDINATE) - 1)).alias("same"),
        *(F.greatest(value, F.lit(0)).alias(name) for name, value in zip(names, dims.values())),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = kept(
        rows.withColumn("own", F.xxhash64("id", "row").bitwiseAND(F.lit((1 << COORDINATE) - 1))).withColumn(
            "shard", F.lit(0)
        )
    )
    open_nodes = [Node(0, count)]
    widths = _widths(rows, names).get(0, [(0, 0)] * len(names))
    scale = [max(1, high - low) for low, high in widths]
    while open_nodes := [node for node in open_nodes if node.shards > 1]:
        rows, open_nodes = _split(rows, names, scale, open_nodes, tolerance)
    return _slots(rows).select(
        F.col("id").alias(doc_id), "size", F.col("crc").alias("text_crc32"), F.col("shard").cast("int"), "slot"
    )


def _widths(rows: DataFrame, names: list[str]) -> dict[int, list[tuple[int, int]]]:
    ends = [f(name).alias(f"{name}_{i}") for name in names for i, f in enumerate((F.min, F.max))]
    found = rows.groupBy("shard").agg(*ends).collect()
    return {row["shard"]: [(row[f"{name}_0"], row[f"{name}_1"]) for name in names] for row in found}


def _split(rows, names, scale, nodes, tolerance) -> tuple[DataFrame, list[Node]]:
    """One level of the tree."""
    widths = _widths(rows, names)
    nodes = [node for node in nodes if node.first in widths]
    if not nodes:
        return rows, []
    widest, lower = {}, {}
    for node in nodes:
        spans = [(high - low) / width for (low, high), width in zip(widths[node.first], scale)]
        axis = max(range(len(names)), key=lambda i: (spans[i], -i))
        widest[node.first], lower[node.first] = axis, 0
    axis = _by_node({first: F.col(names[i]) for first, i in widest.items()})
    # One number of three coordinates would not fit a bigint: they are gone through in turn.
    placed = rows.withColumn("along", axis)
    levels = ["along", "same", "own"]
    prefix = {node.first: [] for node in nodes}  # digits of the bin in which the cut lies
    below = {node.first: 0 for node in nodes}  # bytes before that bin
    need, slack, done = {}, {}, {}
    per_level = COORDINATE // DIGIT
    for step in range(len(levels) * per_level):
        still = [node for node in nodes if node.first not in done]
        if not still:
            break
        level, place = divmod(step, per_level)
        column = levels[level]
        digit = F.shiftright(column, COORDINATE - DIGIT * (place + 1)).bitwiseAND(F.lit((1 << DIGIT) - 1))
        inside = _by_node({node.first: _matches(levels, prefix[node.first]) for node in still}, F.lit(False))
        sums = placed.where(inside).groupBy("shard", digit.alias("digit")).agg(F.sum("size").alias("bytes"))
        bins: dict[int, list] = {}
        for row in sums.collect():  # at most nodes x 2^DIGIT rows
            bins.setdefault(row["shard"], []).append((row["digit"], row["bytes"]))
        for node in still:
            found = sorted(bins[node.first])
            if node.first not in need:
                total = sum(size for _, size in found)
                need[node.first] = total * (node.shards // 2) / node.shards
                slack[node.first] = total * tolerance
            before = below[node.first]
            for at, size in found:
                if before + size >= need[node.first]:
                    break
                before += size
            short, over = need[node.first] - before, before + size - need[node.first]
            if min(short, over) <= slack[node.first] or step == len(levels) * per_level - 1:
                done[node.first] = (prefix[node.first] + [at], over < short)  # whether the bin goes left
            else:
                prefix[node.first] = prefix[node.first] + [at]
                below[node.first] = before
    left = _by_node({first: _goes_left(levels, *cut) for first, cut in done.items()}, F.lit(True))
    half = _by_node({node.first: F.lit(node.shards // 2) for node in nodes}, F.lit(0))
    rows = kept(placed.withColumn("shard", F.when(left, F.col("shard")).otherwise(F.col("shard") + half)).drop("along"))
    children = [Node(node.first, node.shards // 2) for node in nodes]
    children += [Node(node.first + node.shards // 2, node.shards - node.shards // 2) for node in nodes]
    return rows, children


def _by_node(values: dict[int, Column], other: Column | None = None) -> Column:
    """The value of the node that a row is in."""
    chosen = None
    for first, value in values.items():
        chosen = (F if chosen is None else chosen).when(F.col("shard") == first, value)
    return chosen if other is None else chosen.otherwise(other)


def _bounds(digits: list[int], level: int) -> tuple[int, int]:
    """First and last number of the bin that these digits of a level lead to."""
    per_level = COORDINATE // DIGIT
    own = digits[level * per_level : (level + 1) * per_level]
    low = 0
    for i, digit in enumerate(own):
        low += digit << (COORDINATE - DIGIT * (i + 1))
    return low, low + (1 << (COORDINATE - DIGIT * len(own))) - 1


def _matches(levels: list[str], digits: list[int]) -> Column:
    inside = F.lit(True)
    for level, name in enumerate(levels):
        if digits[level * (COORDINATE // DIGIT) :]:
            inside = inside & F.col(name).between(*_bounds(digits, level))
    return inside


def _goes_left(levels: list[str], digits: list[int], with_bin: bool) -> Column:
    """Rows before the bin, and those in it if `with_bin`; levels compare in turn."""
    last = (len(digits) - 1) // (COORDINATE // DIGIT)
    low, high = _bounds(digits, last)
    left = F.col(levels[last]) <= high if with_bin else F.col(levels[last]) < low
    for level in range(last - 1, -1, -1):
        at, _ = _bounds(digits, level)
        left = (F.col(levels[level]) < at) | ((F.col(levels[level]) == at) & left)
    return left


def _slots(rows: DataFrame) -> DataFrame:
    """`slot`, gapless from 0 in each shard: places in salted parts of a shard, after the rows
    of the parts before. The sums are one row per shard and part."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(parts)))
    sizes = salted.groupBy("shard", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("shard", "salt").orderBy("row")) - 1
    return (
        salted.withColumn("place", place)
        .join(starts, ["shard", "salt"])
        .withColumn("slot", (F.col("start") + F.col("place")).cast("bigint"))
    )
