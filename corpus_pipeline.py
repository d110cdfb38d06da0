"""The documents of a corpus, from raw to packed: STAGES, one after the other."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lexiband.llm import content_sort, mixing, packing, simhash, toxicity
from lexiband.llm.common import release, small_batches, written
from lexiband.llm.queries import ALPHA, mixing_dimensions
from lexiband.session import new_shared_path, remove

# Words whose ids a Python worker remembers: fewer than packing alone does, as executors have more to hold here.
WORDS = 100_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return content_sort.drop_duplicates(docs, keep="largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return simhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.sample(docs, mixing_dimensions(), alpha=ALPHA)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), words=WORDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack),
]

# The scores of compressed windows, XXH64 and the tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again. What a stage kept
    for itself, and what it read, is deleted when its result stands; the last result stays."""
    docs, read = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path, mark = new_shared_path(spark, name), written()
        stage(spark, docs, sf_dir).write.parquet(path)
        release(spark, mark)
        remove(spark, read)
        docs, read = spark.read.parquet(path), path
    return docs


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
