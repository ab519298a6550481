"""Quality of texts by a logistic regression on hashed word n-grams.

A text's tokens are its runs of word characters and its runs of other visible characters; a token
equal to the one before it is read as the mark of a repeat. Its features are the n-grams of one and
two tokens, hashed; a feature's value is log(1 + occurrences), and the values of a text are scaled
to length one. A score is a sparse dot product with the weights, put through the logistic function.

Weights come from follow-the-regularised-leader updates: per weight the sum of its gradients and of
their squares, from which the weight follows in closed form; those that the L1 term keeps at zero
are left out of the model. As the updates take one row after the other, training streams: a task
holds these sums and one batch, and the driver only the model.

Only texts are looked at. Labels without a class or an id are left out; of several labels for an
id the larger counts. Training uses at most ``TRAINING_ROWS`` labelled rows, the first by a hash of
the id, ``EPOCHS`` times; scoring covers all rows. Without labels of both classes every text gets
the share of good labels (smoothed) as its score; so does an empty table's model.

Null and empty texts have no features and get the score of the intercept. Rows that repeat are
scored each on its own, null ids too. Very long texts are read in slices, whose counts are added;
an empty table gives no rows. Other columns are ignored.
"""

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenshoe.llm.shared import U64, bounded_batches, mixed, text_of, text_slices, window_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The most labelled rows that training uses, and how often it goes through them.
TRAINING_ROWS, EPOCHS = 4_000, 5
SIZES = (1, 2)
BUCKETS = 1 << 20
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.1, 0.1
THRESHOLD = 0.7
# Contract: rows with this remainder of crc32(id) mod 4 are held out.
FOLDS, HELD_OUT = 4, 2

TOKEN = re.compile(r"\w+|[^\w\s]+")
REPEAT = 0x52455045


def held_out(id_col: str) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT


def _slice_features(hashes: np.ndarray, earlier: int) -> np.ndarray:
    """Buckets of the n-grams that end behind the first ``earlier`` tokens."""
    found = []
    for n in SIZES:
        windows = window_hashes(hashes, list(range(n)), n)[max(0, earlier - n + 1) :]
        found.append(mixed(windows + U64(n)) & U64(BUCKETS - 1))
    return np.concatenate(found).astype(np.int64)


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A text's distinct features, ascending, and their values."""
    buckets, counts = [], []
    carried, last = np.zeros(0, U64), None
    for piece in text_slices(text):
        tokens = TOKEN.findall(piece.decode("utf-8", "replace"))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, tokens), U64, len(tokens))
        if not len(hashes):
            continue
        plain, again = hashes, np.zeros(len(hashes), bool)
        again[1:] = plain[1:] == plain[:-1]
        again[0] = plain[0] == last
        last = plain[-1]
        hashes = np.concatenate([carried, np.where(again, U64(REPEAT), plain)])
        found, n = np.unique(_slice_features(hashes, len(carried)), return_counts=True)
        buckets.append(found)
        counts.append(n)
        carried = hashes[len(hashes) - max(SIZES) + 1 :]
    if not buckets:
        return np.zeros(0, np.int64), np.zeros(0)
    found, count = buckets[0], counts[0].astype(np.float64)
    if len(buckets) > 1:
        found, place = np.unique(np.concatenate(buckets), return_inverse=True)
        count = np.bincount(place, np.concatenate(counts))
    values = np.log1p(count)
    return found, values / np.sqrt((values * values).sum())


def logistic(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -500, 500))))


@dataclass(frozen=True)
class Model:
    """The weights that are not zero, by ascending bucket."""

    intercept: float
    buckets: np.ndarray
    weights: np.ndarray

    def score(self, text: bytes) -> float:
        found, values = features(text)
        if not len(found) or not len(self.buckets):
            return logistic(self.intercept)
        at = np.minimum(np.searchsorted(self.buckets, found), len(self.buckets) - 1)
        known = self.buckets[at] == found
        return logistic(self.intercept + float((self.weights[at[known]] * values[known]).sum()))


class Leader:
    """Follow-the-regularised-leader updates of a logistic regression, one row at a time."""

    def __init__(self):
        self.gradients, self.squares = np.zeros(BUCKETS), np.zeros(BUCKETS)
        self.seen = [0, 0]
        self.offset = [0.0, 0.0]  # the same two sums for the intercept, which no term shrinks

    @staticmethod
    def weights(gradients: np.ndarray, squares: np.ndarray) -> np.ndarray:
        beyond = np.sign(gradients) * np.maximum(np.abs(gradients) - L1, 0)
        return -beyond / ((BETA + np.sqrt(squares)) / ALPHA + L2)

    def intercept(self) -> float:
        return -self.offset[0] / ((BETA + np.sqrt(self.offset[1])) / ALPHA)

    def update(self, found: np.ndarray, values: np.ndarray, good: int) -> None:
        self.seen[good] += 1
        gradients, squares = self.gradients[found], self.squares[found]
        weights, intercept = self.weights(gradients, squares), self.intercept()
        slope = logistic(float((weights * values).sum()) + intercept) - good
        step = slope * values
        rate = (np.sqrt(squares + step * step) - np.sqrt(squares)) / ALPHA
        self.gradients[found] = gradients + step - rate * weights
        self.squares[found] = squares + step * step
        total, square = self.offset
        rate = (np.sqrt(square + slope * slope) - np.sqrt(square)) / ALPHA
        self.offset = [total + slope - rate * intercept, square + slope * slope]

    def model(self) -> Model:
        bad, good = self.seen
        if not bad or not good:
            none = float(np.log((good + 1) / (bad + 1)))
            return Model(none, np.zeros(0, np.int64), np.zeros(0))
        weights = self.weights(self.gradients, self.squares)
        kept = np.flatnonzero(weights)
        return Model(self.intercept(), kept, weights[kept])


def training_rows(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str
) -> DataFrame:
    """(text, good) of the labelled rows that training uses.

    Only the ids are sorted; at most ``TRAINING_ROWS`` of them are broadcast to the documents.
    """
    known = labels.select(F.col(id_col).alias("_label_id"), F.col(label_col).alias("_label"))
    known = known.where(F.col("_label_id").isNotNull() & F.col("_label").isNotNull())
    known = known.where(~held_out("_label_id")).groupBy("_label_id")
    good = (F.max("_label") > 0).cast("int").alias("good")
    chosen = known.agg(good).orderBy(F.xxhash64("_label_id"), "_label_id").limit(TRAINING_ROWS)
    texts = docs.select(F.col(id_col).alias("_id"), text_of(text_col).cast("binary").alias("text"))
    rows = texts.join(F.broadcast(chosen), F.col("_id") == F.col("_label_id"))
    # Rows that share an id are one training row.
    return rows.groupBy("_id").agg(F.min(F.struct("text", "good")).alias("row")).select("row.*")


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> Model:
    """Features are made by all tasks. The updates, one after the other by nature, are one task."""
    bounded_batches(docs.sparkSession)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(text) for text in batch.column(0).to_pylist()]
            columns = [
                pa.array([b.astype("<i4").tobytes() for b, _ in found], pa.binary()),
                pa.array([v.astype("<f4").tobytes() for _, v in found], pa.binary()),
                batch.column(1),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["buckets", "values", "good"])

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader = Leader()
        for batch in batches:
            for buckets, values, good in zip(*(c.to_pylist() for c in batch.columns)):
                leader.update(np.frombuffer(buckets, "<i4"), np.frombuffer(values, "<f4"), good)
        model = leader.model()
        row = [[model.intercept], [model.buckets.astype("<i4").tobytes()], [model.weights.tobytes()]]
        kinds = [pa.float64(), pa.binary(), pa.binary()]
        arrays = [pa.array(v, kind) for v, kind in zip(row, kinds)]
        yield pa.RecordBatch.from_arrays(arrays, ["intercept", "buckets", "weights"])

    rows = training_rows(docs, labels, id_col, text_col, label_col)
    rows = rows.mapInArrow(measure, "buckets binary, values binary, good int")
    rows = rows.withColumn("order", F.xxhash64("buckets", "values"))
    rows = rows.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(EPOCHS))))
    # The order does not depend on ids, and is the same in every run.
    ordered = rows.repartition(1).sortWithinPartitions("epoch", "order", "buckets", "values", "good")
    fitted = ordered.select("buckets", "values", "good").mapInArrow(
        follow, "intercept double, buckets binary, weights binary"
    )
    row = fitted.first()
    if row is None:
        return Leader().model()
    buckets, weights = np.frombuffer(row["buckets"], "<i4"), np.frombuffer(row["weights"], "<f8")
    return Model(row["intercept"], buckets.astype(np.int64), weights)


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row its id and ``score``. Map-only; the model is broadcast, at most 16 bytes a bucket."""
    bounded_batches(docs.sparkSession)
    # As plain values: a class of this module travels with the function, not with a broadcast.
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).cast("binary").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(**shared.value)
        for batch in batches:
            scores = [known.score(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())], ["_id", "score"]
            )

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, score double").withColumnRenamed("_id", id_col)
