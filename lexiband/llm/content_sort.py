"""Exact dedup by content sort.

Sampled splitters range-partition the normalised bytes, Spark's external sort puts equal
texts next to each other, and neighbours are compared in full. The splitters work on a
bounded key: the first characters, then the digest, then the id. So no sampled text is ever
held by the driver, and a group of copies of any size is cut by id and spread over as many
partitions as it needs. Runs that a cut has divided are joined again from one row per
partition.

Defined results: a null text counts as empty, and empty texts are equal to each other. Rows
with a null id stay only if their whole group has none. Repeated rows are copies like any
other: one stays. Other columns are carried as they are, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lexiband.llm.common import pieces, stored

PREFIX = 32
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: str) -> Column:
    """The text that is compared: A-Z in lower case, nothing else changed."""
    return F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)


def duplicate_groups(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: str = "smallest"
) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = _sorted_rows(docs.select(text, doc_id), text, doc_id, keep, carry=False)
    merges = _divided_runs(rows)
    runs = (
        rows.groupBy("part", "run")
        .agg(F.count("*").alias("n"), F.max(F.when(F.col("first"), F.col("id"))).alias("head"))
        .join(F.broadcast(merges), ["part", "run"], "left")
        .select(
            "part",
            "run",
            "n",
            "head",
            F.coalesce("into_part", "part").alias("into_part"),
            F.coalesce("into_run", "run").alias("into_run"),
        )
    )
    own = (F.col("part") == F.col("into_part")) & (F.col("run") == F.col("into_run"))
    groups = runs.groupBy("into_part", "into_run").agg(
        F.sum("n").alias("group_size"), F.max(F.when(own, F.col("head"))).alias("keep_id")
    )
    runs = runs.join(groups, ["into_part", "into_run"]).select(
        "part", "run", "group_size", "keep_id", own.alias("own")
    )
    return rows.join(runs, ["part", "run"]).select(
        F.col("id").alias(doc_id),
        "keep_id",
        "group_size",
        (F.col("first") & F.col("own")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: str = "smallest"
) -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    rows = _sorted_rows(docs, text, doc_id, keep, carry=True)
    heads = rows.where("first").join(F.broadcast(_divided_runs(rows)), ["part", "run"], "left_anti")
    return heads.select("doc.*")


def _sorted_rows(docs: DataFrame, text: str, doc_id: str, keep: str, carry: bool) -> DataFrame:
    """The rows in content order, with their partition, place and run of equal texts.

    `edge` has the normalised text of a partition's first row, of its last, and of the last
    row of each Arrow batch, which may turn out to be the last.
    """
    by_id = F.desc_nulls_last("id") if keep == "largest" else F.asc_nulls_last("id")
    rows = docs.select(
        *([F.struct("*").alias("doc")] if carry else []),
        F.col(doc_id).alias("id"),
        normalised(text).alias("norm"),
    ).select("*", F.substring("norm", 1, PREFIX).alias("key"), F.sha2("norm", 256).alias("sha"))
    if carry:  # a text that is carried is shuffled once, as it is
        rows = rows.drop("norm")
    dealt = rows.repartitionByRange("key", "sha", by_id)
    if carry:
        dealt = dealt.withColumn("norm", normalised(f"doc.{text}"))
    ordered = dealt.sortWithinPartitions("key", "sha", "norm", by_id)
    # A text that is carried goes to Python once, as it is; there it is brought to lower case again.
    ordered = ordered.drop("key", "norm") if carry else ordered.drop("key")
    place = docs.columns.index(text) if carry else None
    kept_fields = [field for field in ordered.schema.fields if field.name != "norm"]
    marks = [
        T.StructField("part", T.IntegerType()),
        T.StructField("pos", T.LongType()),
        T.StructField("run", T.LongType()),
        T.StructField("first", T.BooleanType()),
        T.StructField("edge", T.StringType()),
    ]
    names = [field.name for field in kept_fields]

    def mark(batches):
        part, pos, run, last = TaskContext.get().partitionId(), 0, -1, None
        for batch in pieces(batches):
            n = batch.num_rows
            if not n:
                continue
            norm = batch.column("norm") if place is None else pc.ascii_lower(pc.fill_null(batch.column("doc").field(place), ""))
            first = np.ones(n, dtype=bool)
            first[0] = last is None or norm[0].as_py() != last
            first[1:] = pc.not_equal(norm[1:], norm[:-1]).to_numpy(zero_copy_only=False)
            runs = run + np.cumsum(first)
            run, last = int(runs[-1]), norm[n - 1].as_py()
            edge = [None] * n
            if pos == 0:
                edge[0] = norm[0].as_py()
            edge[-1] = last
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in names),
                    pa.array(np.full(n, part, dtype=np.int32)),
                    pa.array(np.arange(pos, pos + n)),
                    pa.array(runs.astype(np.int64)),
                    pa.array(first),
                    pa.array(edge, pa.string()),
                ],
                names=[*names, "part", "pos", "run", "first", "edge"],
            )
            pos += n

    return stored(ordered.mapInArrow(mark, T.StructType([*kept_fields, *marks])), "content-sort")


def _divided_runs(rows: DataFrame) -> DataFrame:
    """The first runs that go on from an earlier partition, with the run they belong to.

    One row per partition of the sort at most, so the windows and the broadcast of the
    result are bounded by the number of partitions, not by the input.
    """
    in_order = Window.orderBy("part")
    parts = (
        rows.groupBy("part")
        .agg(F.max("pos").alias("last_pos"), F.max("run").alias("last_run"))
        .withColumn("before", F.lag("part").over(in_order))
    )
    edges = rows.where("edge IS NOT NULL").select("part", "pos", "edge")
    firsts = edges.where("pos = 0").select("part", F.col("edge").alias("first_text"))
    lasts = (
        edges.join(parts.select("part", F.col("last_pos").alias("pos")), ["part", "pos"])
        .select(F.col("part").alias("before"), F.col("edge").alias("last_text"))
    )
    goes_on = F.coalesce(F.col("first_text") == F.col("last_text"), F.lit(False))
    ends = (
        parts.join(firsts, "part")
        .join(lasts, "before", "left")
        .select("part", "last_run", goes_on.alias("goes_on"))
        .withColumn(
            "begun", F.when(~F.col("goes_on") | (F.col("last_run") > 0), F.struct("part", "last_run"))
        )
        .withColumn("tail", F.last("begun", ignorenulls=True).over(in_order))
        .withColumn("into", F.lag("tail").over(in_order))
    )
    return ends.where("goes_on").select(
        "part",
        F.lit(0).cast("long").alias("run"),
        F.col("into.part").alias("into_part"),
        F.col("into.last_run").alias("into_run"),
    )
