"""Quality of texts: logistic regression over hashed word n-grams, learnt by following the
regularised leader.

A text is a row of words: runs of letters, runs of digits, and runs of one other character
alike. Its features are its words and pairs of successive words, hashed to SLOTS slots; a
word in capitals alone and a word that follows itself count as such too, whatever the word.
A feature's value grows with the logarithm of its count, and the values of a text have length
1, so that a long text weighs as much as a short one. A text is scored as the product of this sparse
row with the weights.

The rows that teach are about LEARNING labelled rows at most, chosen by a hash of their id, kept
in the order of another, and read by PARTS tasks at most. In every one of EPOCHS rounds each task
goes on from the common state, row by row: per slot a sum of gradients, corrected for the moves of
the weight, and a sum of squared gradients, from which follows the weight that minimises the
regularised sum so far; it is 0 unless the first sum exceeds L1. The tasks' moves, weighed by
their rows, make the next round's start. What comes to the driver is bounded by PARTS and
SLOTS, whatever the input. One row in PARTS, by a hash, teaches nothing: its score sets the offset
and the slope by which a score of CUT is where the two labels part best.

Defined results: null text is empty; a text without words has one feature of its own and gets a
score like any other. Rows with a null id or label don't teach; of an id with several
labels the largest holds, with several texts the smallest teaches. With fewer than two labels, every score is the
share of label 1, or 1 without any labels. Repeated rows are scored alike. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiband.llm.common import kept, pieces, stored, texts_of

WORD = re.compile(r"[^\W\d_]+|\d+|([^\w\s]|_)\1*")
SLOTS, LEARNING, PARTS, EPOCHS, CUT = 1 << 18, 40_000, 8, 8, 0.3
RATE, SMOOTHING, L1, L2 = 2.0, 1.0, 0.02, 0.01
_MULTIPLIER, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_CAPITALS, _AGAIN, _NOTHING = (np.uint64(xxhash.xxh64_intdigest(x)) for x in (b"capitals", b"again", b"nothing"))


class Words(dict):
    """Word to its hash, whose last bit says if it is in capitals; remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        digest = xxhash.xxh64_intdigest(word.lower().encode("utf-8", "surrogatepass"))
        found = self[word] = digest & ~1 | (len(word) > 1 and word.isupper())
        return found


_words = Words()


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Slots, ascending and distinct, and their values."""
    words = np.fromiter((_words[match[0]] for match in WORD.finditer(text)), np.uint64)
    if not len(words):
        return np.array([int(_NOTHING) % SLOTS], np.int64), np.ones(1)
    capitals = words & np.uint64(1)
    words ^= capitals
    pairs = (words[:-1] * _MULTIPLIER + words[1:]) * _MIX
    pairs[words[:-1] == words[1:]] = _AGAIN
    again = int((words[:-2] == words[2:]).sum())
    hashes = np.concatenate([words, pairs, np.full(again, _AGAIN), np.full(int(capitals.sum()), _CAPITALS)])
    hashes = (hashes ^ (hashes >> np.uint64(31))) * _MIX
    slots, counts = np.unique((hashes >> np.uint64(40)).astype(np.int64) % SLOTS, return_counts=True)
    values = 1 + np.log(counts)
    return slots, values / math.sqrt(float(values @ values))


class State(NamedTuple):
    """Per slot, and for the constant at the end: corrected gradients and squares."""

    gradients: np.ndarray
    squares: np.ndarray

    def weights(self) -> np.ndarray:
        return weight(self.gradients, self.squares)


def weight(gradients: np.ndarray, squares: np.ndarray) -> np.ndarray:
    beyond = np.sign(gradients) * L1 - gradients
    return np.where(np.abs(gradients) <= L1, 0.0, beyond / ((SMOOTHING + np.sqrt(squares)) / RATE + L2))


def start() -> State:
    return State(np.zeros(SLOTS + 1), np.zeros(SLOTS + 1))


def learn(state: State, rows: Iterable[tuple[np.ndarray, np.ndarray, int]]) -> None:
    """Go on from `state`, which changes, over rows of slots, values and label."""
    gradients, squares = state
    for slots, values, label in rows:
        at, x = np.append(slots, SLOTS), np.append(values, 1.0)
        z, n = gradients[at], squares[at]
        w = weight(z, n)
        g = (probability(float(w @ x)) - label) * x
        more = n + g * g
        gradients[at] = z + g - (np.sqrt(more) - np.sqrt(n)) / RATE * w
        squares[at] = more


def probability(margin: float) -> float:
    return 1 / (1 + math.exp(-min(max(margin, -30.0), 30.0)))


class Model(NamedTuple):
    slots: np.ndarray  # those with a weight
    weights: np.ndarray
    constant: float
    slope: float
    at: float  # the margin that scores CUT
    share: float | None = None  # the score of all texts, if there was nothing to learn

    def dense(self) -> np.ndarray:
        out = np.zeros(SLOTS)
        out[self.slots] = self.weights
        return out

    def score(self, margins: np.ndarray) -> np.ndarray:
        if self.share is not None:
            return np.full(len(margins), self.share)
        away = np.clip(self.slope * (margins - self.at) + math.log(CUT / (1 - CUT)), -30, 30)
        return 1 / (1 + np.exp(-away))


def learning_rows(docs: DataFrame, labels: DataFrame, learns: Column, text: str, doc_id: str, label: str) -> DataFrame:
    """part, label, order, slots, values of about LEARNING labelled rows at most, kept."""
    rows = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & learns).select(
        F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("label")
    )
    rows = kept(rows.groupBy("_id").agg(F.max("label").alias("label")))
    share = LEARNING / max(1, rows.count())
    chosen = rows.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < F.lit(share * (1 << 30)))
    # About LEARNING rows of an id and a label: a proven bound, so that no text is moved to find them.
    texts = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    found = texts.join(F.broadcast(chosen), "_id").groupBy("_id", "label").agg(F.min("_text").alias("_text"))
    order = F.xxhash64(F.lit("order"), F.col("_id"))
    part = F.pmod(F.shiftright(order, 8), F.lit(PARTS)).cast("int")
    found = found.select(part.alias("part"), "label", order.alias("order"), "_text").sortWithinPartitions("order", "label")

    def read(batches):
        for batch, texts_ in texts_of(pieces(batches), "_text"):
            rows_ = [features(value) for value in texts_]
            columns = [batch.column(name) for name in ("part", "label", "order")]
            columns.append(pa.array([slots.astype(np.int32) for slots, _ in rows_], pa.list_(pa.int32())))
            columns.append(pa.array([values.astype(np.float32) for _, values in rows_], pa.list_(pa.float32())))
            yield pa.RecordBatch.from_arrays(columns, names=["part", "label", "order", "slots", "values"])

    schema = "part int, label int, order long, slots array<int>, values array<float>"
    return stored(found.mapInArrow(read, schema), "quality-rows")


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    slots, values = batch.column("slots"), batch.column("values")
    for i, label in enumerate(batch.column("label").to_pylist()):
        yield slots[i].values.to_numpy(), values[i].values.to_numpy().astype(np.float64), label


def one_round(rows: DataFrame, state: State) -> State:
    """The state moved by the mean of what PARTS tasks at most learn from it."""

    def taught(batches):
        own, taught_rows = State(state.gradients.copy(), state.squares.copy()), 0
        for batch in batches:
            learn(own, _rows(batch))
            taught_rows += batch.num_rows
        if taught_rows:
            moves = [own.gradients - state.gradients, own.squares - state.squares]
            slots = np.flatnonzero((moves[0] != 0) | (moves[1] != 0))
            columns = [slots.astype(np.int32), *(move[slots].astype(np.float32) for move in moves)]
            cells = [pa.array([column.tobytes()], pa.binary()) for column in columns]
            yield pa.RecordBatch.from_arrays([pa.array([taught_rows]), *cells], names=["rows", "slots", "gradients", "squares"])

    told = rows.coalesce(PARTS).mapInArrow(taught, "rows long, slots binary, gradients binary, squares binary").collect()
    gradients, squares = state.gradients.copy(), state.squares.copy()
    total = sum(row["rows"] for row in told)
    for row in sorted(told):  # in one order, as sums of floats depend on it
        slots = np.frombuffer(row["slots"], np.int32)
        gradients[slots] += np.frombuffer(row["gradients"], np.float32) * (row["rows"] / total)
        squares[slots] += np.frombuffer(row["squares"], np.float32) * (row["rows"] / total)
    return State(gradients, squares)


def train(rows: DataFrame) -> Model:
    """Weights and calibration from `learning_rows`."""
    sums = rows.groupBy("part").agg(F.count("*").alias("n"), F.sum("label").alias("ones")).toPandas()
    n, ones = int(sums["n"].sum()), int(sums["ones"].sum())
    if not 0 < ones < n:
        return Model(np.empty(0, np.int64), np.empty(0), 0.0, 1.0, 0.0, ones / n if n else 1.0)
    last = PARTS - 1
    apart = sums[sums["part"] == last]
    # Few rows teach and calibrate at once.
    both = len(apart) and 5 <= apart["ones"].sum() <= apart["n"].sum() - 5 and len(sums) > 1
    teachers = rows.where(F.col("part") != last) if both else rows
    state = start()
    for _ in range(EPOCHS):
        state = one_round(teachers, state)
    weights = state.weights()
    slots = np.flatnonzero(weights[:SLOTS])
    model = Model(slots, weights[slots], float(weights[SLOTS]), 1.0, 0.0)
    judged = rows.where(F.col("part") == last) if both else rows
    return model._replace(**_calibration(judged, model))


def _calibration(rows: DataFrame, model: Model) -> dict:
    """Slope and offset from the margins of `rows`, at most LEARNING of them."""

    def measured(batches):
        dense = model.dense()
        for batch in batches:
            margins = [float(dense[slots] @ values) + model.constant for slots, values, _ in _rows(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(margins, pa.float64())], names=["label", "margin"])

    found = rows.select("label", "slots", "values").mapInArrow(measured, "label int, margin double").toPandas()
    margins, labels = found["margin"].to_numpy(), found["label"].to_numpy()
    return dict(zip(("slope", "at"), calibrated(margins, labels)))


def calibrated(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope of a logistic fit, and the margin that parts the labels best: the mean of the shares
    told right is largest; in the middle of the margins between which that is so."""
    order = np.argsort(margins, kind="stable")
    sorted_, marks = margins[order], labels[order]
    below = np.concatenate([[0], np.cumsum(marks == 0)]) / max(1, (marks == 0).sum())
    lost = np.concatenate([[0], np.cumsum(marks == 1)]) / max(1, (marks == 1).sum())
    gain = below - lost
    cuts = np.concatenate([[sorted_[0] - 1], (sorted_[1:] + sorted_[:-1]) / 2, [sorted_[-1] + 1]])
    possible = np.concatenate([[True], sorted_[1:] != sorted_[:-1], [True]])  # no cut between equal margins
    best = np.flatnonzero(possible & (gain >= gain[possible].max() - 1e-12))
    at = float((cuts[best[0]] + cuts[best[-1]]) / 2)
    slope, bias = 1.0, 0.0
    x = np.stack([margins - at, np.ones_like(margins)])
    for _ in range(50):  # Newton steps with a little ridge
        p = 1 / (1 + np.exp(-np.clip(slope * x[0] + bias, -30, 30)))
        gradient = x @ (labels - p) - np.array([0.01 * slope, 0.01 * bias])
        step = np.linalg.solve((x * (p * (1 - p))) @ x.T + 0.01 * np.eye(2), gradient)
        slope, bias = slope + float(step[0]), bias + float(step[1])
        if abs(step).max() < 1e-9:
            break
    return max(slope, 0.1), at


def scored(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("*",)) -> DataFrame:
    """`doc`, a struct of the columns `keep` of `docs`, and its `score` between 0 and 1."""
    rows = docs.select(F.struct(*keep).alias("doc"), F.col(text).alias("_text"))

    def measured(batches):
        dense = model.dense()
        for batch, texts in texts_of(pieces(batches), "_text"):
            margins = [float(dense[slots] @ values) for slots, values in map(features, texts)]
            score = model.score(np.array(margins) + model.constant)
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(score)], names=["doc", "score"])

    return rows.mapInArrow(measured, T.StructType([rows.schema["doc"], T.StructField("score", T.DoubleType())]))


def learns(doc_id: str = "doc_id") -> Column:
    """Rows that may teach: crc32 of the id as text, modulo 5, is not 0."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 != 0


def score_documents(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality"
) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of `docs`."""
    model = train(learning_rows(docs, labels, learns(doc_id), text, doc_id, label))
    return scored(docs, model, text, (doc_id,)).select(
        F.col(f"doc.{doc_id}").alias(doc_id),
        F.coalesce(~learns(f"doc.{doc_id}"), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )
