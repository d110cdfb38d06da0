"""Rank a made-up, skewed vocabulary and report how evenly the work was cut.

    python scale_trial.py [ROWS] [HEAP]

Each row of text holds one word that is in every row, either a word that occurs only here
and shares a prefix with all such words, or one of a million repeated words, and an
address that is no word. So one key has a third of the tokens, and one prefix within one
frequency has most of the vocabulary.
"""

from __future__ import annotations

import sys
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiband.operators.frequency import token_counts
from lexiband.operators.ranking import by_frequency, in_order, numbered


def spelled(number: Column) -> Column:
    """A number written in letters."""
    return F.lower(F.translate(F.hex(number), "0123456789", "ghijklmnop"))


def skewed_texts(spark: SparkSession, rows: int) -> DataFrame:
    once = F.concat(F.lit("zzzzzz"), spelled(F.col("id")))
    repeated = F.concat(F.lit("m"), spelled(F.col("id") % 1_000_003))
    second = F.when(F.col("id") % 2 == 0, once).otherwise(repeated)
    address = F.concat(F.lit("http://x/"), F.col("id"))
    return spark.range(0, rows, 1, 64).select(F.concat_ws(" ", F.lit("the"), second, address).alias("text"))


def main(rows: int, heap: str) -> None:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.driver.memory", heap)
        .config("spark.sql.shuffle.partitions", "64")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    start = time.perf_counter()
    tokens = in_order(token_counts(skewed_texts(spark, rows)), by_frequency("token"), ranked=F.col("is_word"))
    words = numbered(tokens).where("is_word")
    checks = words.agg(F.count("*"), F.min("rank"), F.max("rank"), F.sum(F.col("rank").cast("decimal(38,0)"))).first()
    seconds = time.perf_counter() - start
    sizes = [row["count"] for row in tokens.groupBy(F.spark_partition_id()).count().collect()]
    n = checks[0]
    assert (checks[1], checks[2], int(checks[3])) == (1, n, n * (n + 1) // 2)
    print(f"{4 * rows} tokens, {n} distinct words, {seconds:.1f} s, heap {heap}")
    print(f"{len(sizes)} sort partitions, {min(sizes)} to {max(sizes)} rows")
    spark.stop()


if __name__ == "__main__":
    main(int(sys.argv[1]) if len(sys.argv) > 1 else 10_000_000, sys.argv[2] if len(sys.argv) > 2 else "4g")
