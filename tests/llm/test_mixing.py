import pytest
from pyspark.sql import functions as F

from lexiband.llm import mixing, queries

SCHEMA = "doc_id BIGINT, text STRING, source STRING, lang STRING, tokens INT, d0 STRING, weight STRING, doc STRING"
def dims():
    return {"source": F.col("source"), "lang": F.col("lang")}



def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "a", "b", "c") for r in rows], SCHEMA)


def brute_rake(cells, targets, sweeps):
    weight = {cell: float(tokens) for cell, tokens in cells.items()}
    for _ in range(sweeps):
        for axis, target in enumerate(targets):
            held = {}
            for cell, w in weight.items():
                held[cell[axis]] = held.get(cell[axis], 0.0) + w
            weight = {
                c: w * target.get(c[axis], 0.0) / held[c[axis]] if held[c[axis]] > 0 else 0.0 for c, w in weight.items()
            }
    return weight


def test_shares_reach_the_targets(spark):
    rows = [(i, "w " * (1 + i % 9), f"s{i % 4}" if i % 3 else "hot", "en" if i % 5 else None) for i in range(900)]
    docs = frame(spark, rows)
    targets = {
        "source": spark.createDataFrame([("hot", 0.1), ("s0", 0.3), ("s1", 0.3), ("s2", 0.2), ("s3", 0.1)], "value STRING, share DOUBLE"),
        "lang": spark.createDataFrame([("en", 0.6), (None, 0.4)], "value STRING, share DOUBLE"),
    }
    drawn = mixing.mixed(docs, dims(), targets).select("doc.*", "doc.source", F.col("doc.lang").alias("l"), "probability").toPandas()
    drawn.columns = [*docs.columns, "s", "l", "probability"]
    tokens = drawn.text.str.split().str.len() * drawn.probability
    shares = (tokens.groupby(drawn.s).sum() / tokens.sum()).to_dict()
    assert shares == pytest.approx({"hot": 0.1, "s0": 0.3, "s1": 0.3, "s2": 0.2, "s3": 0.1}, abs=1e-4)
    assert tokens[drawn.l.isna()].sum() / tokens.sum() == pytest.approx(0.4, abs=1e-4)
    assert drawn.probability.max() == pytest.approx(1.0)


def test_cells_equal_brute_force(spark):
    rows = [(i, "w " * (i % 7), f"s{i % 3}", ["en", "de", None][i * i % 3]) for i in range(60)]
    summed = mixing.cells(frame(spark, rows), dims(), "text")
    cells = {(r.d0, r.d1): r.tokens for r in summed.collect()}
    shares = [{"=s0": 0.5, "=s1": 0.25, "=s2": 0.25}, {"=en": 0.7, "=de": 0.0, "": 0.3}]
    targets = [spark.createDataFrame(list(s.items()), f"d{i} STRING, share DOUBLE") for i, s in enumerate(shares)]
    want = brute_rake(cells, shares, 4)
    found = {(r.d0, r.d1): r.weight for r in mixing.rake(summed, targets, 4).collect()}
    assert found == pytest.approx(want)


@pytest.mark.parametrize(
    "rows",
    [[], [(None, None, None, None)], [(1, "", "a", "b")], [(1, "x y", "a", "b")] * 3 + [(None, "x", "a", None), (2, "w " * 99_999, "", "b")]],
)
def test_edge_cases(spark, rows):
    docs = frame(spark, rows)
    drawn = mixing.mixed(docs, dims()).collect()
    assert len(drawn) == len(rows)
    assert all(0 <= r.probability <= 1 for r in drawn)
    assert all(r.probability == 0 for r in drawn if not any((t or "").split() for _, t, s, l in rows if (s, l) == (r.doc.source, r.doc.lang)))
    assert mixing.sample(docs, dims()).columns == docs.columns
    assert mixing.sample(docs, dims()).collect() == mixing.sample(docs, dims()).collect()


def test_targets_of_the_query_are_met(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    summed = mixing.cells(docs, queries.mixing_dimensions(), "text")
    targets = [mixing.tempered(summed, f"d{i}", queries.ALPHA) for i in range(3)]
    raked = mixing.rake(summed, targets).toPandas()
    for i, target in enumerate(targets):
        want = {r[0]: r[1] for r in target.collect()}
        assert raked.groupby(f"d{i}").weight.sum().to_dict() == pytest.approx(want, rel=1e-3)


def test_raking_goes_on_until_sparse_correlated_shares_are_met(spark):
    rows = []
    for s in range(200):  # a source has two languages of twenty
        rows += [(f"=s{s}", f"={s % 20}", 1 + s * 7919 % 997), (f"=s{s}", f"={(s * 7 + s // 20 + 1) % 20}", 200 + s * 31 % 13)]
    rows += [("=hot", f"={k}", 10_000 * (k + 1)) for k in range(3)]
    summed = spark.createDataFrame(rows, "d0 STRING, d1 STRING, tokens BIGINT").groupBy("d0", "d1").agg(F.sum("tokens").alias("tokens"))
    targets = [mixing.tempered(summed, key, 0.5) for key in ("d0", "d1")]
    raked = mixing.rake(summed, targets).toPandas()
    for i, target in enumerate(targets):
        want = {r[0]: r[1] for r in target.collect()}
        assert raked.groupby(f"d{i}").weight.sum().to_dict() == pytest.approx(want, rel=2 * mixing.TOLERANCE)
    six = mixing.rake(summed, targets, mixing.SWEEPS).groupBy("d0").agg(F.sum("weight").alias("held"))
    off = six.join(targets[0], "d0").agg(F.max(F.abs(F.col("held") / F.col("share") - 1))).first()[0]
    assert off > 0.01


def test_shares_that_cannot_be_met_are_reported(spark, caplog):
    summed = spark.createDataFrame([("=a", "=x", 10), ("=b", "=y", 10)], "d0 STRING, d1 STRING, tokens BIGINT")
    shares = [[("=a", 0.9), ("=b", 0.1)], [("=x", 0.1), ("=y", 0.9)]]
    targets = [spark.createDataFrame(rows, f"d{i} STRING, share DOUBLE") for i, rows in enumerate(shares)]
    with caplog.at_level("WARNING"):
        mixing.rake(summed, targets)
    assert "raking ended" in caplog.text


def test_an_odd_document_leaves_the_kept_share_as_it_was(spark, caplog):
    rows = [(i, "w " * (50 + i % 90), f"s{i % 4}" if i % 3 else "hot", "en" if i % 5 else "de") for i in range(900)]
    shares = []
    for more in ([], [(-1, "five words and no more", "odd", "xx")]):
        with caplog.at_level("WARNING"):
            drawn = mixing.mixed(frame(spark, rows + more), dims()).select("doc.doc_id", "doc.source", "tokens", "probability").toPandas()
        taken = drawn.tokens * drawn.probability
        assert taken.sum() / drawn.tokens.sum() == pytest.approx(mixing.BUDGET, rel=1e-6)
        shares.append((taken.groupby(drawn.source).sum() / taken.sum()).to_dict())
    assert drawn.probability[drawn.doc_id == -1].item() == 1.0
    assert {k: v for k, v in shares[1].items() if k != "odd"} == pytest.approx(shares[0], rel=0.01)
    assert "share of d0 '=odd'" in caplog.text


def test_reached_shares_are_told(spark):
    """With targets that the documents can meet, and with a value that has too few tokens for its share."""
    rows = [(i, "w " * 10, "a" if i % 4 else "b", None if i % 2 else "en") for i in range(400)]
    told = mixing.shares_reached(frame(spark, rows), dims()).collect()
    assert {(r.dimension, r.value) for r in told} == {("source", "a"), ("source", "b"), ("lang", None), ("lang", "en")}
    assert all(abs(r.share - r.reached) <= mixing.TOLERANCE * r.share for r in told)
    targets = {"source": spark.createDataFrame([("a", 0.1), ("b", 0.9)], "value STRING, share DOUBLE")}
    told = {(r.dimension, r.value): r for r in mixing.shares_reached(frame(spark, rows), dims(), targets=targets, budget=0.6).collect()}
    assert told["source", "b"].share == pytest.approx(0.9) and told["source", "b"].reached < 0.5


def test_narrow_rows_are_the_same(spark):
    rows = [(i, "w " * (i % 7), f"s{i % 3}", "en") for i in range(200)]
    docs = frame(spark, rows)
    whole = mixing.mixed(docs, dims()).select("doc.doc_id", "tokens", "probability", "kept")
    narrow = mixing.mixed(docs, dims(), keep=["doc_id"]).select("doc.doc_id", "tokens", "probability", "kept")
    assert sorted(whole.collect()) == sorted(narrow.collect())
