"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiband.llm.common import kept


def components(links: DataFrame) -> DataFrame:
    """`node`, `root`: the smallest node reachable, for every node of a link (src, dst).

    Each round joins links to the smallest neighbour of their node. That minimum is combined
    on the map side, and AQE splits the links of a hub. Rounds grow with the logarithm of a
    chain's length. Links are narrow rows; each round is checkpointed.
    """
    low, high = F.least("src", "dst"), F.greatest("src", "dst")
    links = links.where("src <> dst").select(high.alias("src"), low.alias("dst")).distinct()
    links, mark = _kept(links)
    while True:
        links, now = _kept(_small_star(_large_star(links)))
        if now == mark:
            break
        mark = now
    roots = links.select(F.col("dst").alias("node"), F.col("dst").alias("root")).distinct()
    return links.select(F.col("src").alias("node"), F.col("dst").alias("root")).unionByName(roots)


def _kept(links: DataFrame) -> tuple[DataFrame, tuple]:
    links = kept(links)
    digest = F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))
    return links, tuple(links.agg(F.count("*"), digest).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour, or the node itself."""
    both = links.unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.least(F.min("dst"), F.first("src")).alias("least"))
    return (
        both.where("dst > src")
        .join(least, "src")
        .select(F.col("dst").alias("src"), F.col("least").alias("dst"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the smallest of them."""
    least = links.groupBy("src").agg(F.min("dst").alias("least"))
    others = links.join(least, "src").where("dst <> least").select(F.col("dst").alias("src"), F.col("least").alias("dst"))
    own = least.select("src", F.col("least").alias("dst"))
    return others.unionByName(own).distinct()
