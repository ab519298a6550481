"""Documents that contain benchmark passages, found by spaced seeds.

A seed is the hash of the tokens at chosen places of a window; the places that a mask leaves out
may differ, so a seed still hits where single tokens were replaced. The seeds of all windows of
all documents meet the seeds of the benchmark in a join on the hash, and each hit is verified by
comparing document and item token by token around it.

Tokens are runs of letters, digits and underscores, lower-cased; punctuation does not count.
Items shorter than the window match as a whole and without replacements; items of fewer than
``MIN_TOKENS`` tokens say too little and match nothing. Null texts count as empty and match
nothing. Rows with the same id and text are one document (or item); ids may be null. A very long
text is hashed whole by one task; only stretches around hits are passed on. Without documents or
items nothing is found. Other columns are ignored.
"""

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenshoe.llm.shared import (
    U64,
    Scratch,
    bounded_batches,
    int_lists,
    mixed,
    text_of,
    window_hashes,
    word_hashes,
)

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Masks over windows of 9 to 12 tokens; each reads 8 places. Whichever 2 tokens of 13 are replaced,
# some window of some mask has none of them; for 3 of 15, 3 of 16 and 4 of 20 that holds for 94, 97
# and 99 of a hundred ways. Longer overlaps have more windows.
SPAN = 12
MASKS = [
    [0, 1, 2, 3, 4, 5, 6, 8],
    [0, 1, 2, 4, 5, 7, 8, 9],
    [0, 1, 2, 4, 6, 7, 8, 10],
    [0, 1, 3, 4, 5, 6, 9, 10],
    [0, 1, 2, 4, 5, 9, 10, 11],
    [0, 1, 3, 7, 8, 9, 10, 11],
    [0, 1, 2, 5, 7, 8, 10, 11],
]
MIN_TOKENS = 5
# An overlap counts from so many tokens on (or the whole item), with at least this share equal.
MIN_OVERLAP, MIN_IDENTITY = 13, 0.8
COST = round(MIN_IDENTITY / (1 - MIN_IDENTITY))
# Bits of the filter before the join, as powers of two: sized to the benchmark, 16 MB at most.
LEAST_BITS, MOST_BITS, PROBES = 20, 27, 3
BITMAP = 32_768  # bits of one bitmap of Spark's bitmap functions

SEPARATORS = r"[^\p{L}\p{N}_]+"


def normalised(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id, a hash of the text as it is, and its tokens with single spaces between."""
    text = text_of(text_col)
    plain = F.regexp_replace(F.lower(text), SEPARATORS, " ").cast("binary")
    return df.select(
        F.col(id_col).alias("_id"), F.xxhash64(text).alias("_text"), plain.alias("_plain")
    )


def window_seeds(tokens: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Seeds of all windows, one array per mask, with the tokens that its windows span."""
    for k, mask in enumerate(MASKS):
        span = mask[-1] + 1
        yield span, mixed(window_hashes(tokens, mask, span) + U64(k))


def short_seeds(tokens: np.ndarray, n: int) -> np.ndarray:
    """Seeds of all windows of ``n`` tokens, for items of that length."""
    return mixed(window_hashes(tokens, list(range(n)), n) + U64(100 + n))


def benchmark_seeds(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per item: id, its tokens, and its seeds with their places in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, seeds, places = [], [], []
            for plain in batch.column(2).to_pylist():
                t = word_hashes(plain)
                found = [np.zeros(0, U64)]
                if len(t) >= SPAN:
                    found += [s for _, s in window_seeds(t)]
                elif len(t) >= MIN_TOKENS:
                    found.append(short_seeds(t, len(t)))
                tokens.append(t.view(np.int64))
                seeds.append(np.concatenate(found).view(np.int64))
                places.append(np.concatenate([np.arange(len(s)) for s in found]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    int_lists(tokens, pa.int64()),
                    int_lists(seeds, pa.int64()),
                    int_lists(places, pa.int32()),
                ],
                ["item_id", "item_tokens", "seeds", "places"],
            )

    rows = normalised(items, id_col, text_col).dropDuplicates(["_id", "_text"])
    kind = rows.schema["_id"].dataType.simpleString()
    schema = f"item_id {kind}, item_tokens array<long>, seeds array<long>, places array<int>"
    return rows.mapInArrow(run, schema).withColumn("item", F.monotonically_increasing_id())


def _probe(seed: Column, k: int, bits: int) -> Column:
    low, high = seed.bitwiseAND(F.lit(2**32 - 1)), F.shiftrightunsigned(seed, 32)
    return (low + F.lit(k) * high).bitwiseAND(F.lit(2**bits - 1))


def seed_filter(seeds: DataFrame) -> tuple[int, np.ndarray]:
    """A Bloom filter of the benchmark's seeds: log2 of its bits, and its bytes.

    Its size is bounded. A fuller filter lets more windows through to the join and loses none.
    """
    bits = min(max((32 * seeds.count()).bit_length(), LEAST_BITS), MOST_BITS)
    places = F.array(*[_probe(F.col("seed"), k, bits) + 1 for k in range(PROBES)])
    maps = (
        seeds.select(F.explode(places).alias("p"))
        .groupBy(F.bitmap_bucket_number("p").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bitmap"))
    )
    out = np.zeros(2**bits // 8, np.uint8)
    for row in maps.collect():  # 4,096 bitmaps of 4 kB at most
        at = (row["bucket"] - 1) * BITMAP // 8
        out[at : at + BITMAP // 8] = np.frombuffer(row["bitmap"], np.uint8)
    return bits, out


def passing(seeds: np.ndarray, bits: int, bitmap: np.ndarray) -> np.ndarray:
    """Indexes of the seeds that the filter lets through."""
    at = np.arange(len(seeds))
    for k in range(PROBES):
        low, high = seeds[at] & U64(2**32 - 1), seeds[at] >> U64(32)
        p = ((low + U64(k) * high) & U64(2**bits - 1)).astype(np.int64)
        at = at[(bitmap[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1]
    return at


def _segments(docs: DataFrame, bits: int, bitmap, reach: int, short: list[int]) -> DataFrame:
    """The stretches of documents around seeds that pass the filter, with these seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs_tokens = [word_hashes(x) for x in batch.column(2).to_pylist()]
            ends = np.cumsum([len(t) for t in docs_tokens])
            if not len(ends) or not ends[-1]:
                continue
            tokens = np.concatenate(docs_tokens)
            end_of = np.repeat(ends, [len(t) for t in docs_tokens])
            hit_seeds, hit_at = [], []
            found = [*window_seeds(tokens)]
            found += [(n, short_seeds(tokens, n)) for n in short]
            for span, seeds in found:
                at = passing(seeds, bits, bitmap.value)
                at = at[at + span <= end_of[at]]  # no window reaches into the next document
                hit_seeds.append(seeds[at])
                hit_at.append(at)
            seeds, at = np.concatenate(hit_seeds), np.concatenate(hit_at)
            order = np.argsort(at, kind="stable")
            seeds, at = seeds[order], at[order]
            owner = np.searchsorted(ends, at, "right")
            cuts = np.flatnonzero((np.diff(owner) != 0) | (np.diff(at) > 2 * reach + SPAN)) + 1
            rows, starts, parts, part_seeds, part_at = [], [], [], [], []
            for group in np.split(np.arange(len(at)), cuts):
                if not len(group):
                    continue
                doc = owner[group[0]]
                begin = ends[doc] - len(docs_tokens[doc])
                first = max(begin, at[group[0]] - reach)
                last = min(ends[doc], at[group[-1]] + SPAN + reach)
                rows.append(doc)
                starts.append(first - begin)
                parts.append(tokens[first:last].view(np.int64))
                part_seeds.append(seeds[group].view(np.int64))
                part_at.append(at[group] - begin)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows)),
                        batch.column(1).take(pa.array(rows)),
                        pa.array(starts, pa.int32()),
                        int_lists(parts, pa.int64()),
                        int_lists(part_seeds, pa.int64()),
                        int_lists(part_at, pa.int32()),
                    ],
                    ["_id", "_text", "start", "tokens", "seeds", "places"],
                )

    kind = docs.schema["_id"].dataType.simpleString()
    schema = (
        f"_id {kind}, _text long, start int, tokens array<long>, seeds array<long>,"
        " places array<int>"
    )
    found = docs.mapInArrow(run, schema)
    return found.withColumn("segment", F.monotonically_increasing_id())


def best_overlap(equal: np.ndarray) -> tuple[int, int]:
    """The longest stretch with ``MIN_IDENTITY`` equal tokens; of several the first with most equal.

    Each differing token is paid for by four equal ones, so a stretch has the share exactly if its
    sum is not negative.
    """
    total = np.concatenate([[0], np.cumsum(np.where(equal, 1, -COST))])
    # The greatest sum from each place on falls, so the last end for each start is found by search.
    rest = np.maximum.accumulate(total[::-1])
    ends = len(total) - 1 - np.searchsorted(rest, total)
    sizes = ends - np.arange(len(total))
    starts = np.flatnonzero(sizes == sizes.max())
    start = int(starts[np.argmax(total[ends[starts]] - total[starts])])
    return start, int(ends[start])


def _verified(candidates: DataFrame) -> DataFrame:
    """Candidates (document stretch, item, shift) that overlap far enough."""
    extra = "n_equal int, n_compared int, doc_start int, item_start int, item_tokens int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, rows = [], []
            columns = [batch.column(c) for c in ("tokens", "item_tokens", "start", "shift")]
            for i in range(batch.num_rows):
                doc, item = (c[i].values.to_numpy() for c in columns[:2])
                start, shift = (c[i].as_py() for c in columns[2:])
                offset = shift - start  # where the item's first token lies in the stretch
                a, b = max(0, -offset), min(len(item), len(doc) - offset)
                if b <= a:
                    continue
                equal = doc[a + offset : b + offset] == item[a:b]
                x, y = best_overlap(equal)
                n = int(equal[x:y].sum())
                if y - x >= min(MIN_OVERLAP, len(item)):
                    keep.append(i)
                    rows.append((n, y - x, shift + a + x, a + x, len(item)))
            names = extra.replace(" int", "").split(", ")
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(pa.array(keep, pa.int64())) for c in ("_id", "_text", "item_id")]
                + [pa.array([r[k] for r in rows], pa.int32()) for k in range(5)],
                ["_id", "_text", "item_id", *names],
            )

    kinds = {f.name: f.dataType.simpleString() for f in candidates.schema}
    schema = f"_id {kinds['_id']}, _text long, item_id {kinds['item_id']}, {extra}"
    return candidates.mapInArrow(run, schema)


def overlaps(
    docs: DataFrame,
    items: DataFrame,
    scratch: Scratch,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The best verified overlap of every document and item that have one.

    Columns: ``doc_id``, ``text_hash`` (xxhash64 of the text), ``item_id``, ``n_equal`` of
    ``n_compared`` tokens from ``doc_start`` and ``item_start`` on, ``item_tokens``. Only
    stretches around hits are shuffled, never whole documents.
    """
    bounded_batches(docs.sparkSession)
    bench = scratch.save(benchmark_seeds(items, item_id_col, item_text_col), "items")
    seeds = bench.select(
        "item", F.explode(F.arrays_zip("seeds", "places")).alias("s")
    ).select("item", F.col("s.seeds").alias("seed"), F.col("s.places").alias("item_place"))
    bits, bitmap = seed_filter(seeds)
    size = F.size("item_tokens")
    reach = bench.agg(F.max(size)).first()[0] or 0
    lengths = bench.where((size < SPAN) & (size >= MIN_TOKENS)).select(size.alias("n")).distinct()
    short = sorted(r["n"] for r in lengths.collect())  # SPAN - MIN_TOKENS values at most
    shared_bitmap = docs.sparkSession.sparkContext.broadcast(bitmap)
    found = _segments(normalised(docs, id_col, text_col), bits, shared_bitmap, reach, short)
    segments = scratch.save(found, "segments")
    hits = segments.select(
        "segment", F.explode(F.arrays_zip("seeds", "places")).alias("h")
    ).select("segment", F.col("h.seeds").alias("seed"), F.col("h.places").alias("place"))
    candidates = (
        hits.join(seeds, "seed")
        .select("segment", "item", (F.col("place") - F.col("item_place")).alias("shift"))
        .distinct()
        .join(segments.drop("seeds", "places"), "segment")
        .join(bench.select("item", "item_id", "item_tokens"), "item")
    )
    figures = ["n_equal", "n_compared", "doc_start", "item_start", "item_tokens"]
    # The most equal tokens, then the fewest compared, then the first place.
    order = [(-F.col(c)).alias(f"less_{c}") for c in figures[1:4]]
    ranked = F.struct(F.col("n_equal").alias("equal"), *order, *figures)
    best = _verified(candidates).groupBy("_id", "_text", "item_id").agg(F.max(ranked).alias("b"))
    return best.select(
        F.col("_id").alias("doc_id"),
        F.col("_text").alias("text_hash"),
        "item_id",
        *[F.col(f"b.{c}").alias(c) for c in figures],
    )


def without_contaminated(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Documents without any overlap in ``found``; clean ones stay, with all their columns."""
    bad = found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_text")).distinct()
    text = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    same = docs["doc_id"].eqNullSafe(bad["_id"]) & (text == bad["_text"])
    return docs.join(bad, same, "left_anti")
