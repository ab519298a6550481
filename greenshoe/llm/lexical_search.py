"""The best documents for each item of a set, by integer term scores.

A document is a vector: per term an impact, which grows with the term's occurrences and shrinks with
the document's length. An item is a vector too, of the weights of its terms. A score is their inner
product. The search orders the documents' vectors by length and cuts them into buckets:

* Of a bucket with longest vector l no document can score above |item| x l (Cauchy-Schwarz). As
  buckets come in falling length, an item is done with a task's documents once that is below what
  its k-th best document has.
* Inside a bucket only the coordinates of an item's heaviest terms are read at first. What the other
  coordinates can add is bounded twice: by the largest value that each of them has in the bucket,
  and by the length that is left of the item's and of the document's vector.
* Documents that pass are scored exactly, in 64-bit integers.

What an item has to beat is known before: all documents that hold the item's rarest term that at
least k documents hold are scored first, wherever they are. That is a lower bound of the k-th best
score; it prunes and drops nothing. Documents keep to their partitions: no vector is shuffled, so
copies and frequent words make no task larger.

Items are searched in blocks of bounded size, each against all documents. A filter of bounded size
tells which terms of a document may be an item's; what it lets through wrongly adds length only.

Null and empty texts have no terms: as documents they are not counted, as items they find nothing.
Rows of documents that repeat are documents of their own, as are rows with null ids, which come last
among equal scores. Items that share id and text are one; items that share an id only are searched
each on its own, and their rows share the id. Very long texts are read in slices. Empty tables give
no rows. Other columns are ignored.
"""

import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from greenshoe.llm.decontaminate import passing, seed_filter
from greenshoe.llm.shared import (
    U64,
    Scratch,
    bounded_batches,
    int_lists,
    text_of,
    text_slices,
)

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOP = 10
# Fixed values of the contract: a term's weight, a document's length factor and an impact.
WEIGHT = "floor(1000 * ln((2 * {n} + 2) / (2 * df + 1)))"
FACTOR = "100 - 90 + cast((90 * cast({n} AS DECIMAL(20, 0)) * n_terms) div {total} AS BIGINT)"
IMPACT = "transform(counts, c -> (1000000000 * c) div (1000 * c + 8 * factor))"
# Items of one block have about so many terms together, with repeats among items.
BLOCK_TERMS = 200_000
# The terms read first are the heaviest that have this share of an item's squared length.
FOCUS = 0.6
# Bounds are made in floating point; this much they may be off.
SLACK = 1e-9

# Separators are 00-2F, 3A-40, 5B-60 and 7B-7F; of the letters only A-Z are lower-cased.
_PLAIN = bytes(
    c if c > 0x7F or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 0x20
    for c in range(256)
)


def terms_of(text: bytes) -> Counter:
    """A text's terms and how often each occurs."""
    counts: Counter = Counter()
    for piece in text_slices(text.translate(_PLAIN)):
        counts.update(piece.split())
    return counts


def _hashes(terms: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, terms), U64, len(terms))


def _lists(parts: list[list[bytes]]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, parts)], dtype=np.int32)
    return pa.ListArray.from_arrays(
        pa.array(offsets), pa.array([t for p in parts for t in p], pa.binary())
    )


def item_terms(items: DataFrame) -> DataFrame:
    """(item, term, seed) for the distinct terms of each item; ``seed`` is the term's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(*(c.to_pylist() for c in batch.columns)):
                terms = sorted(terms_of(text))
                columns = [
                    pa.array([item] * len(terms), pa.int64()),
                    pa.array(terms, pa.binary()),
                    pa.array(_hashes(terms).view(np.int64)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["item", "term", "seed"])

    return items.select("item", "_text").mapInArrow(run, "item long, term binary, seed long")


def document_vectors(docs: DataFrame, bits: int, bitmap) -> DataFrame:
    """(doc_id, n_terms, terms, counts): of the terms only those that the filter lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [terms_of(text) for text in batch.column(1).to_pylist()]
            flat = [term for counts in found for term in counts]
            cuts = np.cumsum([0, *map(len, found)])
            at = passing(_hashes(flat), bits, bitmap.value)
            parts = [at[a:b] for a, b in zip(*(np.searchsorted(at, c) for c in (cuts[:-1], cuts[1:])))]
            terms = [[flat[i] for i in part] for part in parts]
            counts = [np.array([c[t] for t in ts], np.int64) for c, ts in zip(found, terms)]
            columns = [
                batch.column(0),
                pa.array([c.total() for c in found], pa.int64()),
                _lists(terms),
                int_lists(counts, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_terms", "terms", "counts"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_terms long, terms array<binary>, counts array<long>"
    return docs.mapInArrow(run, schema)


@dataclass
class Items:
    """A block of items; terms are numbers in the block's vocabulary, the heaviest first."""

    numbers: list[int]
    vocabulary: list[bytes]
    terms: list[np.ndarray]
    weights: list[np.ndarray]
    seeds: list[int | None]  # the rarest term that enough documents hold
    least: list[int]  # a score that the k-th best document reaches

    def lengths(self) -> list[float]:
        return [float(np.sqrt((w.astype(np.float64) ** 2).sum())) for w in self.weights]

    def shortest(self) -> float:
        """No document with a shorter vector can be wanted by any item."""
        needed = [least / max(n, 1) for least, n in zip(self.least, self.lengths())]
        return min(needed, default=0.0) * (1 - SLACK)


def collect_items(rows: DataFrame, top: int) -> Items:
    """One block, of bounded size."""
    table = rows.select("item", "term", "df", "weight").toArrow().to_pydict()
    by_item: dict[int, list] = {}
    for item, term, df, weight in zip(*(table[c] for c in ("item", "term", "df", "weight"))):
        by_item.setdefault(item, []).append((-weight, term, df))
    vocabulary = sorted({term for found in by_item.values() for _, term, _ in found})
    number = {term: k for k, term in enumerate(vocabulary)}
    out = Items([], vocabulary, [], [], [], [])
    for item in sorted(by_item):
        found = sorted(by_item[item])
        rare = [(df, term) for _, term, df in found if df >= top]
        out.numbers.append(item)
        out.terms.append(np.array([number[t] for _, t, _ in found], np.int64))
        out.weights.append(np.array([-w for w, _, _ in found], np.int64))
        out.seeds.append(number[min(rare)[1]] if rare else None)
        out.least.append(0)
    return out


class Bucket:
    """The vectors of one batch, as postings of the block's terms."""

    def __init__(self, batch: pa.RecordBatch, vocabulary: pa.Array):
        self.ids = batch.column(0)
        self.lengths = batch.column(1).to_numpy()
        terms, impacts = batch.column(2), batch.column(3)
        sizes = np.diff(terms.offsets.to_numpy())
        number = pc.fill_null(pc.index_in(terms.flatten(), vocabulary), -1).to_numpy()
        known = np.flatnonzero(number >= 0)
        order = known[np.argsort(number[known], kind="stable")]
        self.rows = np.repeat(np.arange(len(sizes)), sizes)[order]
        self.impacts = impacts.flatten().to_numpy()[order].astype(np.int64)
        self.starts = np.searchsorted(number[order], np.arange(len(vocabulary) + 1))
        self.largest = np.zeros(len(vocabulary), np.int64)
        held = np.flatnonzero(np.diff(self.starts))
        if len(held):
            self.largest[held] = np.maximum.reduceat(self.impacts, self.starts[held])
        self.slot = np.full(len(sizes), -1)

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(self.starts[term], self.starts[term + 1])
        return self.rows[at], self.impacts[at]

    def add(self, chosen: np.ndarray, scores: np.ndarray, terms, weights) -> np.ndarray:
        """Scores of the chosen documents with these terms added."""
        if not len(chosen):
            return scores
        self.slot[chosen] = np.arange(len(chosen))
        for term, weight in zip(terms.tolist(), weights.tolist()):
            rows, impacts = self.postings(term)
            at = self.slot[rows]
            scores[at[at >= 0]] += weight * impacts[at >= 0]
        self.slot[chosen] = -1
        return scores

    def survivors(self, terms, weights, length: float, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that can reach the floor, and their exact scores."""
        squares = weights.astype(np.float64) ** 2
        n_focus = int(np.searchsorted(np.cumsum(squares), FOCUS * squares.sum())) + 1
        partial = np.zeros(len(self.lengths), np.int64)
        read = np.zeros(len(self.lengths))
        for term, weight in zip(terms[:n_focus].tolist(), weights[:n_focus].tolist()):
            rows, impacts = self.postings(term)
            partial[rows] += weight * impacts
            read[rows] += impacts.astype(np.float64) ** 2
        others = int((weights[n_focus:] * self.largest[terms[n_focus:]]).sum())
        chosen = np.flatnonzero(partial >= floor - others)
        left = np.sqrt(squares[n_focus:].sum())
        behind = np.sqrt(np.maximum(self.lengths[chosen] ** 2 - read[chosen], 0))
        # The subtraction above can lose digits of the square, at most this much.
        off = 1e3 * SLACK * left * self.lengths[chosen] + 1
        chosen = chosen[partial[chosen] + left * behind + off >= floor]
        scores = self.add(chosen, partial[chosen], terms[n_focus:], weights[n_focus:])
        return chosen, scores


class Best:
    """The k best of what one task has met, for every item of a block."""

    def __init__(self, items: Items, top: int):
        self.items, self.top = items, top
        self.found: list[list[tuple]] = [[] for _ in items.numbers]

    def floor(self, k: int) -> int:
        full = len(self.found[k]) == self.top
        return max(1, self.items.least[k], -self.found[k][-1][0] if full else 0)

    def offer(self, k: int, ids: pa.Array, rows: np.ndarray, scores: np.ndarray) -> None:
        good = np.flatnonzero(scores >= self.floor(k))
        if len(good) > self.top:  # beyond the k-th best only equal scores can matter
            limit = np.partition(scores[good], len(good) - self.top)[len(good) - self.top]
            good = good[scores[good] >= limit]
        new = ids.take(pa.array(rows[good])).to_pylist()
        pairs = [(-s, i is None, i) for s, i in zip(scores[good].tolist(), new)]
        self.found[k] = sorted(self.found[k] + pairs, key=_rank)[: self.top]

    def rows(self, kind: pa.DataType) -> pa.RecordBatch:
        flat = [(n, i, -s) for n, found in zip(self.items.numbers, self.found) for s, _, i in found]
        columns = [
            pa.array([n for n, _, _ in flat], pa.int64()),
            pa.array([i for _, i, _ in flat], kind),
            pa.array([s for _, _, s in flat], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])


def _rank(found: tuple) -> tuple:
    score, missing, doc_id = found
    return (score, missing) if missing else (score, missing, doc_id)


def _each_task(vectors: DataFrame, shared, top: int, seeding: bool) -> DataFrame:
    """(item, doc_id, score) of the best documents that each task has.

    ``shared`` holds the fields of the items: plain values, as workers need not have the package.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(**shared.value)
        vocabulary = pa.array(items.vocabulary, pa.binary())
        best, lengths = Best(items, top), items.lengths()
        active, kind = list(range(len(items.numbers))), None
        for batch in batches:
            kind = batch.schema.field(0).type
            if not batch.num_rows or not active:
                continue
            bucket = Bucket(batch, vocabulary)
            if seeding:
                for k in active:
                    if items.seeds[k] is None:
                        continue
                    rows, _ = bucket.postings(items.seeds[k])
                    scores = np.zeros(len(rows), np.int64)
                    scores = bucket.add(rows, scores, items.terms[k], items.weights[k])
                    if len(rows):
                        best.offer(k, bucket.ids, rows, scores)
                continue
            longest = float(bucket.lengths[0]) * (1 + SLACK)
            active = [k for k in active if lengths[k] * longest >= best.floor(k)]
            for k in active:
                rows, scores = bucket.survivors(
                    items.terms[k], items.weights[k], lengths[k], best.floor(k)
                )
                if len(rows):
                    best.offer(k, bucket.ids, rows, scores)
        if kind is not None:
            yield best.rows(kind)

    kind = vectors.schema["doc_id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"item long, doc_id {kind}, score long")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    """The k best of each item, from the best of each task."""
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return ranked.where(F.col("rank") <= top)


def search(
    docs: DataFrame,
    items: DataFrame,
    scratch: Scratch,
    top: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): per item the ``top`` documents that score above 0."""
    spark = docs.sparkSession
    bounded_batches(spark)
    wanted = items.select(
        F.col(item_id_col).alias("item_id"), text_of(item_text_col).cast("binary").alias("_text")
    ).dropDuplicates()
    wanted = scratch.save(wanted.withColumn("item", F.monotonically_increasing_id()), "items")
    terms = scratch.save(item_terms(wanted), "item-terms")
    bits, bitmap = seed_filter(terms.select("seed").distinct())
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).cast("binary"))
    filter_ = spark.sparkContext.broadcast(bitmap)
    vectors = scratch.save(document_vectors(texts, bits, filter_), "vectors")
    filter_.destroy()

    n, total = vectors.agg(F.count_if(F.col("n_terms") > 0), F.sum("n_terms")).first()
    frequency = vectors.select(F.explode("terms").alias("term")).groupBy("term")
    weighted = terms.drop("seed").join(frequency.agg(F.count("*").alias("df")), "term")
    weighted = weighted.withColumn("weight", F.expr(WEIGHT.format(n=n)))
    weighted = scratch.save(weighted, "weighted")
    n_blocks = -(-weighted.count() // block_terms)

    held = vectors.where(F.size("terms") > 0)
    held = held.withColumn("factor", F.expr(FACTOR.format(n=n, total=total or 1)))
    held = held.withColumn("impacts", F.expr(IMPACT))
    square = F.aggregate("impacts", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    held = held.select("doc_id", F.sqrt(square).alias("length"), "terms", "impacts")

    results = []
    for block in range(n_blocks):
        mine = weighted.where(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == block)
        gathered = collect_items(mine, top)
        if not gathered.numbers:
            continue
        shared = spark.sparkContext.broadcast(vars(gathered))
        first = _ranked(_each_task(held, shared, top, seeding=True), top).where(F.col("rank") == top)
        least = {r["item"]: r["score"] for r in first.select("item", "score").collect()}
        shared.destroy()
        gathered.least = [least.get(number, 0) for number in gathered.numbers]
        shared = spark.sparkContext.broadcast(vars(gathered))
        long = held.where(F.col("length") >= gathered.shortest())
        ordered = long.sortWithinPartitions(F.desc("length"))
        found = _ranked(_each_task(ordered, shared, top, seeding=False), top)
        results.append(scratch.save(found, f"found-{block}"))
        shared.destroy()
    if not results:
        kind = docs.schema[id_col].dataType.simpleString()
        empty = f"item long, doc_id {kind}, score long, rank int"
        results = [spark.createDataFrame([], empty)]
    found = reduce(DataFrame.unionByName, results)
    return found.join(wanted.select("item", "item_id"), "item").select(
        "item_id", "rank", "doc_id", "score"
    )
