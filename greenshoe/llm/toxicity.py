"""Toxic texts by a linear classifier on character n-grams.

Features are the distinct n-grams of 3 to 6 characters inside the words of a text (a word's ends
count as characters), hashed. Each is scaled by its naive Bayes log-count ratio: how much more
often it stands in toxic training texts than in others. A logistic regression is fitted on top.

Only texts are looked at. Labels without a class or an id are left out; of several labels for an
id the larger counts. Training uses at most ``TRAINING_ROWS`` labelled rows, the first by a hash
of the id, which bounds what the driver holds; scoring covers all rows. Without labels of both
classes every text gets the share of toxic labels (smoothed) as its score.

Null and empty texts have no features and get the score of the intercept. Rows that repeat are
scored each on its own, null ids too. A very long text is scored whole, by its distinct words. An
empty table gives no rows. Other columns are ignored.
"""

import sys
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenshoe.llm.shared import (
    U64,
    bounded_batches,
    mixed,
    per_process,
    text_of,
    window_hashes,
)

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The most labelled rows that training uses.
TRAINING_ROWS = 4_000
SIZES = (3, 4, 5, 6)
BUCKETS = 1 << 18
# Of the hashed features, the ones that tell the classes apart best are fitted.
FEATURES, MIN_DOCUMENTS = 1 << 15, 3
SMOOTHING, L2, STEPS, RATE = 1.0, 1.0, 150, 0.02
# Rows whose features are unpacked at once while fitting.
SLICE = 256
THRESHOLD = 0.3
# Contract: rows with this remainder of crc32(id) mod 4 are held out.
FOLDS, HELD_OUT = 4, 2
# Words whose features a worker remembers (some 100 MB at most), and words hashed at once.
REMEMBERED, AT_ONCE = 250_000, 5_000


def held_out(id_col: str) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT


def words_features(words: list[str], place: np.ndarray | None = None) -> list[np.ndarray]:
    """The hashed n-grams of each word, all words at once.

    With ``place`` their numbers in it instead, without those that have a negative one.
    """
    text = "\x02" + "\x03\x02".join(words) + "\x03"
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(U64)
    sizes = np.array([len(w) + 2 for w in words])
    owner = np.repeat(np.arange(len(words)), sizes)
    end = np.repeat(np.cumsum(sizes), sizes)
    owners, features = [], []
    for n in SIZES:
        hashes = window_hashes(codes, list(range(n)), n)
        inside = np.flatnonzero(np.arange(len(hashes)) + n <= end[: len(hashes)])
        found = (mixed(hashes[inside] + U64(n)) & U64(BUCKETS - 1)).astype(np.int32)
        if place is not None:
            found = place[found]
            inside, found = inside[found >= 0], found[found >= 0]
        owners.append(owner[inside])
        features.append(found)
    owners, features = np.concatenate(owners), np.concatenate(features)
    order = np.argsort(owners, kind="stable")
    counts = np.bincount(owners, minlength=len(words))
    return np.split(features[order], np.cumsum(counts)[:-1])


class TextFeatures:
    """Features of texts, as ``words_features`` gives them; remembers those of words."""

    def __init__(self, place: np.ndarray | None = None):
        self.place, self.known = place, {}

    def learn(self, words: list[str]) -> None:
        for i in range(0, len(words), AT_ONCE):
            part = words[i : i + AT_ONCE]
            for word, found in zip(part, words_features(part, self.place)):
                # A copy, as a slice would keep the array of all words alive.
                self.known[word] = found.copy() if len(found) else None

    def __call__(self, texts: list[str | None]) -> Iterator[list[np.ndarray]]:
        """For each text the features of each of its distinct words that has any."""
        for text in texts:
            words = set((text or "").lower().split())
            new = words.difference(self.known)
            if len(self.known) + len(new) > REMEMBERED:
                self.known, new = {}, words
            if new:
                self.learn(list(new))
            yield [f for f in map(self.known.__getitem__, words) if f is not None]


@dataclass(frozen=True)
class Model:
    """Scores are 1 / (1 + exp(-(intercept + the sum of the weights of a text's features)))."""

    intercept: float
    buckets: np.ndarray  # the hashed features that bear weight, sorted
    weights: np.ndarray

    def scorer(self) -> Callable[[list[str | None]], list[float]]:
        place = np.full(BUCKETS, -1, np.int32)
        place[self.buckets] = np.arange(len(self.buckets), dtype=np.int32)

        features, present = TextFeatures(place), np.zeros(len(self.buckets))

        def score(texts: list[str | None]) -> list[float]:
            totals = np.full(len(texts), self.intercept)
            for i, words in enumerate(features(texts)):
                if words:
                    at = np.concatenate(words)
                    present[at] = 1
                    totals[i] += present @ self.weights
                    present[at] = 0
            return (1 / (1 + np.exp(-totals))).tolist()

        return score


def worker_scorer(model: "Model") -> Callable[[list[str | None]], list[float]]:
    """The scorer of a model, with the words that earlier tasks of this worker have met."""
    mark = xxhash.xxh3_64_hexdigest(model.weights.tobytes() + model.buckets.tobytes())
    return per_process("toxicity", lambda: BoundedScorers())(mark, model)


class BoundedScorers:
    """Remembers the scorer of the last model only."""

    def __init__(self):
        self.mark, self.scorer = None, None

    def __call__(self, mark: str, model: "Model"):
        if self.mark != (mark, model.intercept):
            self.mark, self.scorer = (mark, model.intercept), model.scorer()
        return self.scorer


def fit(rows: list[np.ndarray], toxic: np.ndarray) -> Model:
    """Log-count ratios and a logistic regression (Adam, full batches) on hashed features."""
    n, y = len(rows), toxic.astype(np.float64)
    prior = (y.sum() + 1) / (n + 2)
    none = Model(float(np.log(prior / (1 - prior))), np.zeros(0, np.int64), np.zeros(0))
    if not n or y.min() == y.max():
        return none
    present, absent = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for features, label in zip(rows, y):
        (present if label else absent)[features] += 1
    ratio = np.log((present + SMOOTHING) / (y.sum() + 2 * SMOOTHING))
    ratio -= np.log((absent + SMOOTHING) / ((1 - y).sum() + 2 * SMOOTHING))
    strength = np.abs(ratio) * np.sqrt(present + absent)
    strength[present + absent < MIN_DOCUMENTS] = 0
    chosen = np.sort(np.argsort(-strength, kind="stable")[:FEATURES])
    chosen = chosen[strength[chosen] > 0]
    if not len(chosen):
        return none
    place = np.full(BUCKETS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    # Two bytes for each feature of a row; all else is made for some rows at a time.
    columns = [c[c >= 0].astype(np.uint16) for c in (place[features] for features in rows)]
    value = ratio[chosen]
    weight, intercept = np.zeros(len(chosen)), none.intercept
    m, v = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for step in range(1, STEPS + 1):
        scaled = weight * value
        slope, error = np.zeros(len(chosen)), 0.0
        for a in range(0, n, SLICE):
            part = columns[a : a + SLICE]
            owner = np.repeat(np.arange(len(part)), [len(c) for c in part])
            column = np.concatenate(part)
            total = np.bincount(owner, scaled[column], len(part)) + intercept
            off = 1 / (1 + np.exp(-total)) - y[a : a + SLICE]
            slope += np.bincount(column, off[owner], len(chosen))
            error += off.sum()
        slope = np.append((slope * value + L2 * weight) / n, error / n)
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        change = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        weight, intercept = weight - change[:-1], intercept - change[-1]
    return Model(float(intercept), chosen, weight * value)


def training_rows(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str
) -> DataFrame:
    """(features, toxic) of the labelled rows that training uses.

    Only the ids are sorted; at most ``TRAINING_ROWS`` of them are broadcast to the documents.
    """
    known = labels.select(F.col(id_col).alias("_label_id"), F.col(label_col).alias("_toxic"))
    known = known.where(F.col("_label_id").isNotNull() & F.col("_toxic").isNotNull())
    known = known.where(~held_out("_label_id")).groupBy("_label_id").agg(F.max("_toxic").alias("_toxic"))
    chosen = known.orderBy(F.xxhash64("_label_id"), "_label_id").limit(TRAINING_ROWS)
    texts = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    rows = texts.join(F.broadcast(chosen), F.col("_id") == F.col("_label_id"))
    # Rows that share an id are one training row.
    rows = rows.select("_id", "_text", "_toxic").dropDuplicates(["_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = TextFeatures()
        for batch in batches:
            found = []
            for words in features(batch.column(0).to_pylist()):
                distinct = np.unique(np.concatenate(words)) if words else np.zeros(0, np.int32)
                found.append(distinct.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.binary()), batch.column(1)], ["features", "toxic"]
            )

    rows = rows.select("_text", F.col("_toxic").cast("int").alias("toxic"), "_id")
    return rows.select("_text", "toxic").mapInArrow(run, "features binary, toxic int")


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model:
    bounded_batches(docs.sparkSession)
    rows = training_rows(docs, labels, id_col, text_col, label_col).toArrow()
    toxic = rows["toxic"].to_numpy() > 0
    # Views of the Arrow buffers, which the driver holds once.
    features = [
        np.frombuffer(value.as_buffer() or b"", np.int32) for value in rows["features"]
    ]
    order = sorted(range(len(features)), key=lambda i: zlib.crc32(features[i]))
    return fit([features[i] for i in order], toxic[order])


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row its id and ``score``. Map-only."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = worker_scorer(Model(**shared.value))
        for batch in batches:
            scores = scorer(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())], ["_id", "score"]
            )

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, score double").withColumnRenamed("_id", id_col)


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows that are not predicted to be toxic, with all their columns. Map-only."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = worker_scorer(Model(**shared.value))
        for batch in batches:
            clean = [s < THRESHOLD for s in scorer(batch.column(at).to_pylist())]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
