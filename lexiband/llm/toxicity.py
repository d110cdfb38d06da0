"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary and one on toxic text, and every
window of a text is compressed with both: the bytes that the toxic dictionary saves are the
window's distance. A frame of zstandard costs about ten bytes and a match in the middle of
a word says nothing, so words are written as codes of sixteen bytes each: a word that a
dictionary holds is one match, any other is sixteen literal bytes in both. A match costs up
to six bytes, so that one of eight would hardly show. Each dictionary
holds the words most frequent in ordinary text; the toxic one ends with the words that mark
toxic text by their document frequencies, the ordinary one with the words that mark ordinary
text, as many of them.

What counts is the strongest stretch of successive windows, so that a passage in a very long text
weighs what it weighs alone. Its threshold is calibrated on the learning rows, long ones among them.

The rows that teach are about LEARNING labelled rows at most, chosen by a hash of the id, so
that the ids can be broadcast to the texts; they are kept, one text for each id. Spark counts the document frequencies over all of
their whole texts. What reaches the driver is bounded: COMMON + MARKING words, and the
distances of about SAMPLE learning rows a label, chosen by a hash of the id, from which the threshold
and the logistic scale are fitted. The score is 0.3 exactly where the fit separates best.

Defined results: a null or empty text has no window, distance 0 and the score of that. Rows
without a label, or with a null one, don't teach; of an id with several texts the smallest does. A row that occurs twice is scored twice.
If a label is missing, or no word marks toxic text, every score is 0.
"""

from __future__ import annotations

import math
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiband.llm.common import kept, pieces, stored, texts_of

WORD = re.compile(r"[^\W\d_]+")
WINDOW, STRETCH, LEVEL, SLACK, WEIGHT = 16, 32, 3, 2, 200
COMMON, MARKING, LEAST_DOCS, LEAST_RATIO = 500, 2000, 4, 24.0
LEARNING, SAMPLE, CUT = 40_000, 10_000, 0.3


def words(text: str) -> list[str]:
    """Runs of letters, in lower case."""
    return WORD.findall(text.lower())


class Model(NamedTuple):
    ordinary: tuple[str, ...]
    toxic: tuple[str, ...]
    slope: float
    at: float  # the distance feature that scores CUT

    def score(self, feature: np.ndarray) -> np.ndarray:
        if not self.toxic:
            return np.zeros(len(feature))
        away = np.clip(self.slope * (feature - self.at) + math.log(CUT / (1 - CUT)), -30, 30)
        return 1 / (1 + np.exp(-away))


class Codes(dict):
    """Word to code, remembered up to a bound."""

    MOST = 50_000

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.MOST:
            self.clear()
        code = self[word] = xxhash.xxh128_digest(word.encode("utf-8", "surrogatepass"))
        return code


class Distance:
    """Feature of a text: log of the bytes saved per word in its strongest stretch of windows.

    Up to SLACK bytes a window are noise. A stretch has STRETCH windows, or all of a shorter text, and
    every window begins one, so that a passage weighs the same wherever it is and whatever is
    around it. A stretch counts as WEIGHT words longer than it is, so that one saving in a
    short text is no higher a share than many in a long one.
    """

    def __init__(self, ordinary: tuple[str, ...], toxic: tuple[str, ...]):
        self.codes = Codes()
        self.ordinary, self.toxic = self._compressor(ordinary), self._compressor(toxic)

    def _compressor(self, held: tuple[str, ...]):
        content = b"".join([self.codes[word] for word in held])
        trained = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        trained.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(
            level=LEVEL, dict_data=trained, write_content_size=False, write_checksum=False, write_dict_id=False
        ).compress

    def __call__(self, text: str) -> float:
        codes = self.codes
        coded = [codes[word] for word in words(text)]
        saved = []
        for i in range(0, len(coded), WINDOW):
            window = b"".join(coded[i : i + WINDOW])
            saved.append(max(0, len(self.ordinary(window)) - len(self.toxic(window)) - SLACK))
        if len(saved) <= STRETCH:
            return math.log((sum(saved) + 0.5) / (len(coded) + WEIGHT))
        upto = np.cumsum([0, *saved])
        return math.log((int((upto[STRETCH:] - upto[:-STRETCH]).max()) + 0.5) / (STRETCH * WINDOW + WEIGHT))


def _distances(docs: DataFrame, ordinary, toxic) -> DataFrame:
    """The columns of `docs` other than `_text`, and `feature`."""
    fields = [field for field in docs.schema.fields if field.name != "_text"]

    def measured(batches):
        distance = Distance(ordinary, toxic)
        for batch, texts in texts_of(pieces(batches), "_text"):
            columns = [batch.column(field.name) for field in fields]
            feature = pa.array([distance(text) for text in texts], pa.float64())
            yield pa.RecordBatch.from_arrays([*columns, feature], names=[*(f.name for f in fields), "feature"])

    return docs.mapInArrow(measured, T.StructType([*fields, T.StructField("feature", T.DoubleType())]))


def learning_rows(docs: DataFrame, labels: DataFrame, learns: Column, text: str, doc_id: str, label: str) -> DataFrame:
    """_id, _text, toxic of the labelled rows that teach, about LEARNING of them at most."""
    rows = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & learns).select(
        F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("toxic")
    )
    rows = kept(rows.groupBy("_id").agg(F.max("toxic").alias("toxic")))
    share = LEARNING / max(1, rows.count())
    chosen = rows.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < F.lit(share * (1 << 30)))
    # About LEARNING rows of an id and a label: a proven bound, so that only their texts are moved.
    texts = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    found = texts.join(F.broadcast(chosen), "_id").groupBy("_id", "toxic").agg(F.min("_text").alias("_text"))
    return stored(found, "toxicity-rows")


def train(rows: DataFrame) -> Model:
    """Dictionaries and calibration from `learning_rows`."""

    def counted(batches):
        for batch, texts in texts_of(pieces(batches), "_text"):
            found = [sorted(set(words(text))) for text in texts]
            toxic = np.repeat(batch.column("toxic").to_numpy(), [len(some) for some in found])
            flat = [word for some in found for word in some]
            yield pa.RecordBatch.from_arrays([pa.array(flat, pa.string()), pa.array(toxic)], names=["word", "toxic"])

    totals = {row["toxic"]: row["n"] for row in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_ordinary = totals.get(1, 0), totals.get(0, 0)
    if not n_toxic or not n_ordinary:
        return Model((), (), 0.0, 0.0)
    counts = (
        rows.mapInArrow(counted, "word string, toxic int")
        .groupBy("word")
        .agg(F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") == 0).alias("o"))
    )
    share_t, share_o = (F.col("t") + 0.5) / (n_toxic + 1), (F.col("o") + 0.5) / (n_ordinary + 1)
    counts = kept(counts.where("t + o > 1").withColumn("ratio", share_t / share_o))

    def top(some: DataFrame, by: list[Column], most: int) -> list[str]:
        return [row["word"] for row in some.orderBy(*by, "word").limit(most).select("word").collect()]

    marks = counts.where(f"t >= {LEAST_DOCS} AND ratio >= {LEAST_RATIO}")
    toxic = top(marks, [F.desc("ratio")], MARKING)
    if not toxic:
        return Model((), (), 0.0, 0.0)
    common = top(counts.where(f"ratio < {LEAST_RATIO}"), [F.desc("o")], COMMON)
    plain = counts.where(f"o >= {LEAST_DOCS} AND ratio < 1").where(~F.col("word").isin(common))
    ordinary = top(plain, [F.asc("ratio")], len(toxic))
    dictionaries = tuple([*ordinary, *common[::-1]]), tuple([*toxic, *common[::-1]])

    # About SAMPLE rows a label, by a hash: each task decides on its rows alone.
    part = F.pmod(F.xxhash64(F.lit("sample"), F.col("_id")), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, SAMPLE / n_toxic).otherwise(SAMPLE / n_ordinary)
    measured = _distances(rows.where(part < share).select("_text", "toxic"), *dictionaries).toPandas()
    marked = measured["toxic"] == 1
    if marked.all() or not marked.any():
        return Model((), (), 0.0, 0.0)
    weight = np.where(marked, n_toxic / marked.sum(), n_ordinary / (~marked).sum())
    return Model(*dictionaries, *_calibrated(measured["feature"].to_numpy(), measured["toxic"].to_numpy(), weight))


def _calibrated(feature: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope of a logistic fit, and the feature above which F1 is highest."""
    order = np.argsort(-feature, kind="stable")
    hits = np.cumsum((weight * toxic)[order])
    picked = np.cumsum(weight[order])
    f1 = 2 * hits / (picked + (weight * toxic).sum())
    ends = np.flatnonzero(np.append(np.diff(feature[order]) != 0, True))  # ties are picked together
    best = ends[int(np.argmax(f1[ends]))]
    low = feature[order][best]
    at = (low + feature[order][best + 1]) / 2 if best + 1 < len(order) else low - 1.0
    slope, bias = 1.0, 0.0
    for _ in range(50):  # Newton steps with a little ridge
        p = 1 / (1 + np.exp(-np.clip(slope * (feature - at) + bias, -30, 30)))
        x = np.stack([feature - at, np.ones_like(feature)])
        gradient = x @ (weight * (toxic - p)) - np.array([0.01 * slope, 0.01 * bias])
        hessian = (x * (weight * p * (1 - p))) @ x.T + 0.01 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        slope, bias = slope + float(step[0]), bias + float(step[1])
        if abs(step).max() < 1e-9:
            break
    return max(slope, 0.1), float(at)


def scored(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("*",)) -> DataFrame:
    """`doc`, a struct of the columns `keep` of `docs`, and its `score` between 0 and 1."""
    # A text that is kept goes to Python once, in the struct.
    names = docs.columns if keep == ("*",) else list(keep)
    place = names.index(text) if text in names else None
    rows = docs.select(F.struct(*keep).alias("doc"), *([F.col(text).alias("_text")] if place is None else []))
    fields = [rows.schema["doc"], T.StructField("score", T.DoubleType())]

    def measured(batches):
        distance = Distance(model.ordinary, model.toxic)
        for batch in pieces(batches):
            texts = batch.column("_text") if place is None else batch.column("doc").field(place)
            score = model.score(np.array([distance(text or "") for text in texts.to_pylist()]))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(score)], names=["doc", "score"])

    return rows.mapInArrow(measured, T.StructType(fields))


def learns(doc_id: str = "doc_id") -> Column:
    """Rows that may teach: crc32 of the id as text, modulo 4, is not 2."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 != 2


def score_documents(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic") -> DataFrame:
    """doc_id, held_out, score, predicted of every row of `docs`."""
    model = train(learning_rows(docs, labels, learns(doc_id), text, doc_id, label))
    return scored(docs, model, text, (doc_id,)).select(
        F.col(f"doc.{doc_id}").alias(doc_id),
        F.coalesce(~learns(f"doc.{doc_id}"), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic") -> DataFrame:
    """The rows of `docs` that score below CUT, with all their columns."""
    model = train(learning_rows(docs, labels, learns(doc_id), text, doc_id, label))
    return scored(docs, model, text).where(F.col("score") < CUT).select("doc.*")
