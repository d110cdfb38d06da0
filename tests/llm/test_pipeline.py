from pathlib import Path
from urllib.parse import urlparse

import corpus_pipeline
import pytest

from lexiband.llm import mixing, packing, queries, toxicity
from lexiband.llm.common import BATCH_SETTING, small_batches

from .test_simhash import brute_components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_stages_follow_each_other(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    clean = {r.doc_id for r in toxicity.score_documents(docs, labels).where("predicted = 0").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in clean]
    last = {(text or "").translate(LOWER): doc_id for doc_id, text in sorted(rows)}
    rows = [r for r in rows if r[0] in set(last.values())]
    rows = [r for r, found in zip(rows, brute_components(rows)) if found[0] == found[2]]
    left = docs.join(spark.createDataFrame([(r[0],) for r in rows], "doc_id BIGINT"), "doc_id")
    drawn = mixing.mixed(left, queries.mixing_dimensions(), alpha=queries.ALPHA).where("kept")
    want = {r.doc_id for r in drawn.select("doc.doc_id").collect()}
    found = corpus_pipeline.run(spark, sf_dir).toPandas()
    assert set(found.doc_id) == want and 0 < len(want) < 200
    lengths = found.groupby("sequence_id").length.sum()
    assert lengths.max() <= packing.CAPACITY


def test_nothing_but_the_result_stays(spark):
    """Tables that stages kept for themselves, checkpoints, and what one stage wrote for the next."""
    import gc

    from lexiband.session import use_shared_folder

    folder = Path(urlparse(use_shared_folder(spark)).path)
    gc.collect()
    before = {path for path in folder.iterdir()}
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    new = {path.name for path in folder.iterdir()} - {path.name for path in before}
    assert out.count() > 0
    assert len(new) == 1 and new.pop().startswith("best_fit_packing-")


def test_every_stage_takes_empty_tables_and_keeps_the_columns(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for rows in (docs.limit(0), docs.limit(1), docs.limit(1).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "CAST(NULL AS STRING) AS text", "lang", "source", "n_chars")):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, rows, sf_dir)
            assert out.columns == docs.columns, name
            assert out.count() <= rows.count()


@pytest.mark.parametrize("name", ["op1_mix_sources", "op8_perspectives"])
def test_operators_without_python_run_none(spark, name):
    query = next(q for q in queries.QUERIES if q.__name__ == name)
    plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "ArrowEval" not in plan and "InArrow" not in plan


def test_mixing_has_no_join_without_keys_and_reads_the_texts_once(spark, caplog):
    plan = queries.op1_mix_sources(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "text" not in plan


def test_texts_go_to_python_in_small_batches(spark, tmp_path):
    """By default 10,000 rows at once: texts of 3,000 bytes took dozens of MB, several times over, in each task."""
    rows = [(i, f"some words {i} and more", "en", "web", 20) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(20)], "doc_id BIGINT, quality INT, toxic INT")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    try:
        for name, stage in corpus_pipeline.STAGES:
            spark.conf.unset(BATCH_SETTING)
            plan = stage(spark, docs, str(tmp_path))
            small = spark.conf.get(BATCH_SETTING) == "2m"
            assert small == (name != "mix_sources"), name
            assert plan.columns
        spark.conf.unset(BATCH_SETTING)
        small_batches(spark)

        def counted(batches):
            import pyarrow as pa

            for batch in batches:
                yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows]})

        texts = spark.range(0, 3000, 1, 1).selectExpr("repeat('x', 3000) AS text")
        rows = [r.rows for r in texts.mapInArrow(counted, "rows BIGINT").collect()]
        assert sum(rows) == 3000 and max(rows) < 1000
    finally:
        spark.conf.unset(BATCH_SETTING)


def test_packing_remembers_fewer_words_here():
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    assert packing.encoder(path, corpus_pipeline.WORDS).words < packing.encoder(path).words
    assert packing.encoder(path, corpus_pipeline.WORDS) is packing.encoder(path, corpus_pipeline.WORDS)
