"""Ranks 1..n in a total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexiband.session import kept_files, remove, use_shared_folder

# Layout of monotonically_increasing_id: partition number above, row number below.
ROW_BITS = 33

# Folders of the rankings that were not released.
_placed: list[str | None] = []


def by_frequency(token: str) -> list[Column]:
    """The rank order: most frequent first, ties by token in binary order."""
    return [F.desc("frequency"), F.asc(token)]


def with_rank(df: DataFrame, order: list[Column]) -> DataFrame:
    """Add `rank` and the number of rows `n`, without bringing the rows together.

    The rows are range-partitioned and sorted once. A row's place in its partition plus
    the sizes of the partitions before it is its rank. Rows stay in rank order across
    the partitions of the result.
    """
    return numbered(in_order(df, order))


def in_order(df: DataFrame, order: list[Column], ranked: Column | None = None) -> DataFrame:
    """Sort `df` and keep the sorted partitions, for `numbered`. Starts jobs.

    `order` has to be total. With distinct sort keys the range partitioning can also cut
    a long run of one frequency, whatever its share of the vocabulary.

    Two checkpoints, both the size of the vocabulary and not of the text. A range
    partitioning reads its input twice, to sample and to sort: the first checkpoint keeps
    it from adding up the tasks' counts twice, and is removed when the second stands. Two
    evaluations of the sort may be cut differently, as the bounds come from a sample: the
    second fixes one, and stays until `release`. What an executor lost is read from them again.

    Rows for which `ranked` is false are put last and get no rank.
    """
    use_shared_folder(df.sparkSession)
    unsorted = df.withColumn("_ranked", F.lit(True) if ranked is None else ranked).checkpoint()
    ordered = unsorted.orderBy(F.desc("_ranked"), *order)
    placed = ordered.withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    remove(df.sparkSession, kept_files(unsorted))
    _placed.append(kept_files(placed))
    return placed


def release(spark: SparkSession, since: int = 0) -> None:
    """Delete what rankings have kept since the mark that `standing` gave, when their results
    have been written. A session that cleans checkpoints may leave it to Spark."""
    while len(_placed) > since:
        remove(spark, _placed.pop())


def standing() -> int:
    """The number of rankings that are kept: a mark for `release`."""
    return len(_placed)


def numbered(placed: DataFrame) -> DataFrame:
    """Add `rank` and the number of ranked rows `n` to what `in_order` kept."""
    kept = [name for name in placed.columns if name not in ("_ranked", "_id")]
    placed = placed.select(
        "*",
        F.shiftright("_id", ROW_BITS).alias("_part"),
        F.col("_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("_place"),
    )
    # One row per partition of the sort, so at most spark.sql.shuffle.partitions rows, which
    # does not grow with the input: small enough for a window in one task and a broadcast.
    sizes = placed.groupBy("_part").agg(F.count_if("_ranked").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
        F.sum("_size").over(Window.partitionBy()).alias("n"),
    )
    rank = F.when(F.col("_ranked"), F.col("_offset") + F.col("_place") + 1)
    return placed.join(F.broadcast(offsets), "_part").select(*kept, rank.alias("rank"), "n")


def with_letter_rank(df: DataFrame, order: list[Column]) -> DataFrame:
    """Add `rank` and `n` to a letter table: at most 26 rows, so one window task does."""
    return df.withColumns(
        {
            "rank": F.row_number().over(Window.orderBy(*order)).cast("bigint"),
            "n": F.count("*").over(Window.partitionBy()),
        }
    )
