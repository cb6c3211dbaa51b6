"""A quality classifier: naive Bayes log-count ratios under a linear support vector machine.

A document is the set of its word n-grams and of its shape n-grams: letter case, length and
punctuation of a word, and whether it repeats the word before. Each n-gram is an indicator hashed
to one of 2 ** HASH_BITS places, scaled by the log ratio of its counts in the two classes. On the
scaled rows, brought to length one, a hinge-loss model is fitted by dual coordinate descent. Both are
learned from a sample of at most ``sample_rows`` labelled documents of each class: those with the
least hash of their id.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from folioflow.llm.common import map_texts, narrow, stored
from folioflow.session import cut_lineage

HASH_BITS = 18
# Odd multipliers that spread n-grams over the places, one per family.
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)
_TAIL = re.compile(rb"[!-/:-@\[-`{-~]*$")
_CACHED_WORDS = 300_000
SAMPLE_ROWS = 4000
# Places (32-bit numbers) of a class's sample that come to the driver at most.
SAMPLE_PLACES = 1 << 25
_STEP = 1 << 17


def _shape(word: bytes) -> int:
    """Case, length class and closing punctuation of a word, as a small number."""
    tail = _TAIL.search(word)[0]
    core = word[:len(word) - len(tail)].decode("utf-8", "replace")
    case = "u" if core.isupper() and len(core) > 1 else "t" if core[:1].isupper() else "d" if core.isdigit() else "l"
    size = len(core)
    length = min(size, 3) if size < 4 else 4 if size < 7 else 5 if size < 11 else 6 if size < 20 else 7
    return zlib.crc32(f"{case}{length}".encode() + tail[:4])


class _Words(dict):
    """Word to its hash and shape, kept for the words seen last."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        value = self[word] = zlib.crc32(word.lower()) << 32 | _shape(word)
        return value


# The name of a worker's words.
_STORE = ("quality words",)


def features(text: bytes) -> np.ndarray:
    """The places of a text's n-grams, each once, ascending."""
    tokens = text.split()
    if not tokens:
        return np.empty(0, np.int32)
    packed = np.fromiter(map(stored(_STORE, _Words).__getitem__, tokens), np.uint64, len(tokens))
    found = []
    for at in range(0, len(packed), _STEP):
        part = packed[max(0, at - 2):at + _STEP]
        word, shape = part >> np.uint64(32), part & np.uint64(0xFFFFFFFF)
        again = np.concatenate(([False], word[1:] == word[:-1]))
        shape = shape * np.uint64(2) + again
        grams = [
            word * _MIX[0], (word[:-1] * _MIX[1] + word[1:]) * _MIX[2], shape * _MIX[3],
            (shape[:-1] * _MIX[1] + shape[1:]) * _MIX[4],
            ((shape[:-2] * _MIX[1] + shape[1:-1]) * _MIX[2] + shape[2:]) * _MIX[5],
        ]
        found.append(np.unique((np.concatenate(grams) >> np.uint64(64 - HASH_BITS)).astype(np.int32)))
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))


@dataclass(frozen=True)
class Model:
    """``ratio`` scales the indicators, ``weight`` is the fitted plane, ``bias`` its offset."""

    ratio: np.ndarray
    weight: np.ndarray
    bias: float

    def margin(self, places: np.ndarray) -> float:
        scale = self.ratio[places]
        norm = float(np.sqrt(scale @ scale))
        return float(scale @ self.weight[places]) / norm + self.bias if norm else self.bias


def log_ratio(positive: np.ndarray, negative: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    p, q = positive + smoothing, negative + smoothing
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, costs: np.ndarray,
                            size: int, epochs: int = 30, tolerance: float = 1e-3, seed: int = 0) -> np.ndarray:
    """Weights (the last one is the bias) of the L2-regularised hinge-loss model.

    One dual variable per row, held between 0 and the row's cost; a step solves its own problem
    exactly. Ends when no projected gradient of an epoch exceeds the tolerance.
    """
    weight, alpha = np.zeros(size + 1), np.zeros(len(rows))
    square = np.array([v @ v + 1.0 for v in values])
    order = np.arange(len(rows))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        rng.shuffle(order)
        worst = 0.0
        for i in order:
            y = labels[i]
            gradient = y * (weight[rows[i]] @ values[i] + weight[size]) - 1.0
            projected = min(gradient, 0.0) if alpha[i] <= 0 else max(gradient, 0.0) if alpha[i] >= costs[i] else gradient
            worst = max(worst, abs(projected))
            if projected:
                new = min(max(alpha[i] - gradient / square[i], 0.0), costs[i])
                weight[rows[i]] += (new - alpha[i]) * y * values[i]
                weight[size] += (new - alpha[i]) * y
                alpha[i] = new
        if worst < tolerance:
            break
    return weight


def _counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Rows of each class that hold each feature; 2 ** HASH_BITS rows at most come to the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, 1 << HASH_BITS), np.int64)
        for batch in batches:
            labels = batch.column(0).to_pylist()
            for label, places in zip(labels, batch.column(1)):
                totals[label][places.values.to_numpy()] += 1
        place = np.flatnonzero(totals.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(place.astype(np.int32)), pa.array(totals[0][place]), pa.array(totals[1][place])],
            names=["place", "negative", "positive"])

    summed = rows.select("label", "places").mapInArrow(run, "place int, negative bigint, positive bigint").groupBy(
        "place").agg(F.sum("negative").alias("negative"), F.sum("positive").alias("positive")).toArrow()
    counts = np.zeros((2, 1 << HASH_BITS))
    place = summed.column("place").to_numpy()
    counts[0][place], counts[1][place] = summed.column("negative").to_numpy(), summed.column("positive").to_numpy()
    return counts[1], counts[0]


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, cost: float = 1.0, label_col: str = "label",
        id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from rows with a 0/1 label; rows with a null label are left out.

    The plane is fitted on ``sample_rows`` rows of each class at most, those with the least hash of
    id and text; a class's weight makes up for unequal numbers. With one class only, or none, the
    model gives every text the same score.
    """
    rows = narrow(labelled, id_col, text_col, F.col(label_col).cast("int").alias("label")).filter("label IN (0, 1)")
    keyed = rows.select("label", F.xxhash64("doc_id", "text").alias("key"), "text")

    def run(texts: list[bytes]) -> dict:
        return {"places": pa.array([features(t) for t in texts], pa.list_(pa.int32()))}

    held = cut_lineage(map_texts(keyed, run, "places array<int>", as_bytes=True, keeps=_STORE))
    positive, negative = _counts(held)
    ratio = log_ratio(positive, negative)
    places, labels = [], []
    for label in (0, 1):
        taken = held.filter(F.col("label") == label).orderBy("key").limit(sample_rows)
        # Of very long texts fewer are taken: what comes to the driver is bounded in numbers as well.
        upto = F.sum(F.size("places")).over(Window.orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        taken = taken.withColumn("upto", upto).filter(F.col("upto") <= SAMPLE_PLACES).select("places").toArrow()
        for row in taken.column("places"):
            places.append(row.values.to_numpy())
            labels.append(2 * label - 1)
    labels = np.array(labels, float)
    if len(set(labels)) < 2:
        return Model(ratio, np.zeros(1 << HASH_BITS), float(labels[0]) if len(labels) else 1.0)
    values = []
    for p in places:
        scale = ratio[p]
        values.append(scale / max(np.sqrt(scale @ scale), 1e-12))
    shares = {c: len(labels) / (2 * (labels == c).sum()) for c in (-1.0, 1.0)}
    weight = dual_coordinate_descent(places, values, labels, np.array([cost * shares[c] for c in labels]), 1 << HASH_BITS)
    return Model(ratio, weight[:-1], float(weight[-1]))


# The score is a logistic curve of the margin; at a margin of 1, where the hinge loss ends, 0.95.
_SLOPE = 3.0


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", *others: Column) -> DataFrame:
    """``doc_id``, the other columns asked for, and ``score`` from 0 to 1 for every row.

    Only the text is read. Null and empty texts get the score of the model's offset.
    """
    rows = narrow(docs, id_col, text_col, *others)
    # Two arrays of 2 ** HASH_BITS numbers.
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: list[bytes]) -> dict:
        margins = np.fromiter((sent.value.margin(features(t)) for t in texts), float, len(texts))
        return {"score": 1.0 / (1.0 + np.exp(-_SLOPE * margins))}

    return map_texts(rows.select(*(c for c in rows.columns if c != "text"), "text"), run, "score double", as_bytes=True,
                     keeps=_STORE)


def held_out(doc_id: Column) -> Column:
    """True for the third of the ids that no model learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labels_of(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, label_col: str = "quality",
              id_col: str = "doc_id") -> DataFrame:
    """``doc_id, text, label``: a sample of the documents with their label, held-out ids left out.

    Per class the ``sample_rows`` labelled ids with the least hash are taken; only their texts are
    read on. Several labels of one id count as their majority, a tie as 1; labels of ids without a
    document do not count towards the sample.
    """
    one = (
        labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
        .groupBy(F.col(id_col).alias("labelled")).agg((F.avg(label_col) >= 0.5).cast("int").alias("label"))
    )
    one = one.join(docs.select(F.col(id_col).alias("labelled")), "labelled", "left_semi")
    order = [F.xxhash64("labelled"), "labelled"]
    picked = [one.filter(F.col("label") == c).orderBy(*order).limit(sample_rows) for c in (0, 1)]
    # Twice ``sample_rows`` ids at most.
    sample = F.broadcast(cut_lineage(picked[0].unionByName(picked[1])))
    known = docs.select(F.col(id_col).alias("doc_id"), "text")
    return known.join(sample, F.col("doc_id") == F.col("labelled")).select("doc_id", "text", "label")
