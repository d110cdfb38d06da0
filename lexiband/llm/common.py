"""Tables in the shared folder, and a broadcast behind a check of its size."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiband.session import kept_files, new_shared_path, remove, use_shared_folder

# A table of at most this many rows is broadcast; callers hold their rows under about 100 bytes.
BROADCAST_ROWS = 200_000
# Spark gives Python 10,000 rows at a time, of long texts dozens of MB, held several times on both sides.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "2m"

_written: list[str | None] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back.

    Cuts the lineage: what an executor lost is read again, never computed anew by other
    splitters. The files stay until `release`, as results are lazy.
    """
    path = new_shared_path(df.sparkSession, name)
    df.write.parquet(path)
    _written.append(path)
    return df.sparkSession.read.parquet(path)


def kept(df: DataFrame) -> DataFrame:
    """A reliable checkpoint of a narrow table. It stays until `release`, or until the last
    reference is gone where spark.cleaner.referenceTracking.cleanCheckpoints is on."""
    use_shared_folder(df.sparkSession)
    checkpointed = df.checkpoint()
    _written.append(kept_files(checkpointed))
    return checkpointed


def written() -> int:
    """How many tables of `stored` and `kept` were not released: a mark for `release`."""
    return len(_written)


def release(spark: SparkSession, since: int = 0) -> None:
    """Delete what `stored` and `kept` have written since the mark, when the results have been written."""
    while len(_written) > since:
        remove(spark, _written.pop())


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` marked for broadcast if it has no more than `rows` rows, else as it is.

    The count is an action: call it on a table that was kept. Beyond the bound the join
    shuffles, and AQE splits its hot keys.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python in batches of about BATCH_BYTES, in this session from now on, as results are lazy."""
    spark.conf.set(BATCH_SETTING, BATCH_BYTES)


def pieces(batches: Iterable, rows: int = 512) -> Iterator:
    """The batches in smaller ones, so that a task holds few texts as Python objects."""
    for batch in batches:
        yield from (batch.slice(at, rows) for at in range(0, batch.num_rows, rows))


def texts_of(batches: Iterable, column: str) -> Iterator:
    """Each Arrow batch that has rows, with the texts of `column`; null counts as empty."""
    for batch in batches:
        if batch.num_rows:
            yield batch, [text or "" for text in batch.column(column).to_pylist()]
