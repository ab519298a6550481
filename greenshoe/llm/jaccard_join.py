"""Near duplicates: documents whose sets of word shingles have a Jaccard similarity of 0.8.

A grouped prefix join. With the tokens of every set in one order, rarest first, two similar sets
share a token among the first few of each (the prefix). Sets with the same prefix and size are
one group; groups that share a prefix token, are close in size and have that token early enough
are candidates; candidates are expanded to their members, and these are verified on whole sets.

1. Every document's set is hashed; equal sets form one class, which its least document stands for.
2. Tokens below a fixed hash are counted over all documents. A set of n tokens that has a partner
   shares all but n/5 of them with others; a document of which fewer are shared is out. This is a
   necessary condition, so nothing is lost, and the more costly steps see few documents.
3. The classes left are counted in full, which gives the order, the prefixes and the groups.
4. Candidates are verified in stars first: the members of a group against its first, and of the
   groups at a prefix token each against one of them. What is linked is one component from then
   on, so that a large family of near copies takes a number of pairs in proportion to its size.
   The first centre at a token is a set that has it earliest, so one with few tokens of its own,
   which is what copies were made from. Other centres follow while that pays.
5. All remaining candidates in different components are verified. No pair of candidates goes
   unchecked unless its documents are connected already.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. A document of one to four words has its whole
sequence as only shingle; null, empty and blank texts have none and are linked with nothing. Sets
are compared by 64-bit hashes of shingles, and equal sets found by 128-bit hashes. Rows that
repeat are copies of each other. A null id never stands for a component unless all its ids are
null. A very long text is a set like any other; its shingles' hashes are held by one task. An empty
table gives no rows. Other columns are ignored.
"""

import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from greenshoe.llm.components import connected_components
from greenshoe.llm.shared import (
    U64,
    Scratch,
    bounded_batches,
    int_lists,
    mixed,
    window_hashes,
    word_hashes,
)
from greenshoe.llm.token_counts import count_tokens

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE, PERCENT = 5, 80
# Share of the hash range that step 2 counts.
SAMPLED = 0.3
# Step 5 begins when so few pairs per prefix token are left to compare, after so many rounds of
# stars, or when a round has linked less than a tenth of what the one before has.
FEW_PAIRS, STAR_ROUNDS = 16, 4
# Bits of the filter that tells which documents stand for a class: 2 MB, whatever their number.
FILTER_BITS, BITMAP = 24, 32_768


def shingles(data: bytes) -> np.ndarray:
    """The sorted hashes of a text's distinct shingles."""
    hashes = word_hashes(data.lower())  # of bytes: A-Z only
    if not len(hashes):
        return hashes
    if len(hashes) < SHINGLE:
        n = len(hashes)
        return mixed(window_hashes(hashes, list(range(n)), n) + U64(n))
    return np.unique(window_hashes(hashes, list(range(SHINGLE)), SHINGLE))


def least_overlap(n: int) -> int:
    """Tokens that a set of ``n`` shares with any set similar enough."""
    return (PERCENT * n + 99) // 100


def _signatures(docs: DataFrame) -> DataFrame:
    """Steps 1 and 2: id, size and fingerprint of every set, and whether it can have a partner."""

    def read(batch: pa.RecordBatch):
        limit = U64(int(SAMPLED * 2**32) << 32)
        kept = {"_id": batch.column(0).to_pylist(), "n": [], "set": [], "sampled": []}
        tokens = []
        for data in batch.column(1).to_pylist():
            s = shingles(data)
            kept["n"].append(len(s))
            kept["set"].append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            tokens.append(s[: np.searchsorted(s, limit)])
        kept.pop("sampled")
        return kept, tokens

    def finish(kept, _, counts):
        out = {"_id": kept["_id"], "n": kept["n"], "set": kept["set"], "open": []}
        for n, c in zip(kept["n"], counts):
            enough = int((c > 1).sum()) >= len(c) - (n - least_overlap(n))
            out["open"].append(bool(n and enough))
        return out

    schema = T.StructType(
        [
            T.StructField("_id", docs.schema["_id"].dataType),
            T.StructField("n", T.LongType()),
            T.StructField("set", T.BinaryType()),
            T.StructField("open", T.BooleanType()),
        ]
    )
    return count_tokens(docs, read, finish, schema, needs_tokens=False)


def _id_filter(classes: DataFrame) -> np.ndarray:
    """Bits of the hashed ids that stand for a class; bounded, and may let others through too."""
    place = F.xxhash64("first").bitwiseAND(F.lit(2**FILTER_BITS - 1)) + 1
    maps = (
        classes.select(place.alias("p"))
        .groupBy(F.bitmap_bucket_number("p").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bitmap"))
    )
    out = np.zeros(2**FILTER_BITS // 8, np.uint8)
    for row in maps.collect():  # 512 bitmaps of 4 kB at most
        at = (row["bucket"] - 1) * BITMAP // 8
        out[at : at + BITMAP // 8] = np.frombuffer(row["bitmap"], np.uint8)
    return out


CANDIDATES = T.StructType(
    [
        T.StructField("set", T.BinaryType()),
        T.StructField("n", T.LongType()),
        T.StructField("tokens", T.ArrayType(T.LongType())),
        T.StructField("prefix_key", T.BinaryType()),
        T.StructField("prefix", T.ArrayType(T.LongType())),
        T.StructField("places", T.ArrayType(T.IntegerType())),
    ]
)


def _candidates(docs: DataFrame, id_bits: np.ndarray) -> DataFrame:
    """Step 3: the sets that can have a partner, with their prefixes."""
    bits = docs.sparkSession.sparkContext.broadcast(id_bits)
    rows = docs.select(
        F.xxhash64("_id").bitwiseAND(F.lit(2**FILTER_BITS - 1)).alias("_place"), "_text"
    )

    def read(batch: pa.RecordBatch):
        place = batch.column(0).to_numpy()
        passes = (bits.value[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
        kept, tokens = {"set": []}, []
        for data in batch.column(1).filter(pa.array(passes)).to_pylist():
            s = shingles(data)
            if len(s):
                kept["set"].append(xxhash.xxh3_128_digest(s.tobytes()))
                tokens.append(s)
        return kept, tokens

    def finish(kept, tokens, counts):
        out = {f.name: [] for f in CANDIDATES}
        for key, s, c in zip(kept["set"], tokens, counts):
            n = len(s)
            if int((c > 1).sum()) < least_overlap(n):
                continue
            order = np.lexsort((s, c))[: n - least_overlap(n) + 1]
            shared = np.flatnonzero(c[order] > 1)
            if not len(shared):
                continue
            prefix = s[order]
            out["set"].append(key)
            out["n"].append(n)
            out["tokens"].append(s.view(np.int64))
            out["prefix_key"].append(xxhash.xxh3_128_digest(n.to_bytes(8) + prefix.tobytes()))
            out["prefix"].append(prefix[shared].view(np.int64))
            out["places"].append(shared.astype(np.int32))
        for name, kind in (("tokens", pa.int64()), ("prefix", pa.int64()), ("places", pa.int32())):
            out[name] = int_lists(out[name], kind)
        return out

    return count_tokens(rows, read, finish, CANDIDATES, needs_tokens=True)


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""

    def side(x: str) -> DataFrame:
        return sets.select(
            F.col("set").alias(x), F.col("n").alias(f"n_{x}"), F.col("tokens").alias(f"t_{x}")
        )

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    common = F.size(F.array_intersect("t_a", "t_b"))
    similar = 100 * common >= PERCENT * (F.col("n_a") + F.col("n_b") - common)
    return both.where(similar).select("a", "b")


def _close(x: str, y: str):
    """Whether sizes and the places of a shared prefix token allow for the similarity.

    ``x`` and ``y`` are prefixes of column names. The token at these places and all after it are
    the most that the sets can share, if it is the first that they share.
    """
    n_x, n_y = F.col(f"{x}n"), F.col(f"{y}n")
    sizes = (100 * n_x >= PERCENT * n_y) & (100 * n_y >= PERCENT * n_x)
    most = F.least(n_x - F.col(f"{x}place"), n_y - F.col(f"{y}place"))
    return sizes & ((100 + PERCENT) * most >= PERCENT * (n_x + n_y))


class _Links:
    """Components of the sets so far; links that are verified later merge them."""

    def __init__(self, scratch: Scratch):
        self.scratch, self.step, self.labels = scratch, 0, None

    def of(self, rows: DataFrame, column: str, name: str) -> DataFrame:
        """``rows`` with the component of the set in ``column``."""
        if self.labels is None:
            return rows.withColumn(name, F.col(column))
        labels = self.labels.select(F.col("node").alias(column), F.col("component").alias("_c"))
        joined = rows.join(labels, column, "left")
        return joined.withColumn(name, F.coalesce("_c", column)).drop("_c")

    def add(self, links: DataFrame) -> int:
        """Merge the components that ``links`` (a, b) connect; the number of links."""
        self.step += 1
        links = self.scratch.save(links, f"links-{self.step}")
        if not (n := links.count()):
            return 0
        ends = self.of(self.of(links, "a", "_a"), "b", "_b")
        ends = ends.select(F.col("_a").alias("a"), F.col("_b").alias("b"))
        merged = connected_components(ends, self.scratch, f"merge-{self.step}")
        if self.labels is not None:
            new = merged.select(F.col("node").alias("component"), F.col("component").alias("_m"))
            old = self.labels.join(new, "component", "left")
            old = old.select("node", F.coalesce("_m", "component").alias("component"))
            known = self.labels.select("node")
            merged = old.unionByName(merged.join(known, "node", "left_anti"))
        self.labels = self.scratch.save(merged, f"labels-{self.step}")
        return n


def _open_pairs(postings: DataFrame) -> int:
    """Pairs at the same token in different components, counted without making them."""
    by_component = postings.groupBy("token", "component").agg(F.count("*").cast("double").alias("k"))
    by_token = by_component.groupBy("token").agg(
        ((F.sum("k") * F.sum("k") - F.sum(F.col("k") * F.col("k"))) / 2).alias("pairs")
    )
    return by_token.agg(F.sum("pairs")).first()[0] or 0


def _linked(sets: DataFrame, scratch: Scratch) -> _Links:
    """Steps 4 and 5: the components of all sets."""
    group = sets.groupBy("prefix_key").agg(F.min("set").alias("group"))
    members = scratch.save(
        sets.select("set", "n", "prefix_key").join(group, "prefix_key").drop("prefix_key"), "members"
    )
    heads = members.where(F.col("set") == F.col("group")).select("group", "set")
    entries = F.explode(F.arrays_zip("prefix", "places"))
    groups = sets.join(heads, "set").select("group", "n", entries.alias("e"))
    postings = scratch.save(
        groups.select("group", "n", F.col("e.prefix").alias("token"), F.col("e.places").alias("place")),
        "postings",
    )
    n_postings = postings.count()
    links = _Links(scratch)
    in_groups = members.where(F.col("set") != F.col("group"))
    links.add(_similar(in_groups.select(F.col("group").alias("a"), F.col("set").alias("b")), sets))
    linked_before = 0
    for number in range(1, STAR_ROUNDS + 1):
        labelled = links.of(postings, "group", "component")
        if number > 1 and _open_pairs(labelled) <= FEW_PAIRS * n_postings:
            break
        order = [F.xxhash64("group", F.lit(number)).alias("order")]
        if number == 1:
            order.insert(0, F.col("place").alias("early"))
        centre = F.min(F.struct(*order, "group", "component", "n", "place"))
        centres = (
            labelled.groupBy("token")
            .agg(centre.alias("c"), F.count("*").alias("k"))
            .where(F.col("k") > 1)
            .select("token", *[F.col(f"c.{x}").alias(f"c_{x}") for x in ("group", "component", "n", "place")])
        )
        spokes = (
            labelled.withColumnsRenamed({"n": "g_n", "place": "g_place"})
            .join(centres, "token")
            .where(F.col("component") != F.col("c_component"))
            .where(_close("g_", "c_"))
        )
        pairs = spokes.select(F.col("c_group").alias("a"), F.col("group").alias("b")).distinct()
        n_links = links.add(_similar(pairs, sets))
        if 10 * n_links < linked_before:
            break
        linked_before = n_links
    # Every pair of members that shares a prefix token and is not connected yet.
    expanded = links.of(
        postings.drop("n").join(members, "group").select("token", "place", "n", "set"),
        "set", "component",
    )
    x = expanded.toDF(*["token" if c == "token" else f"x_{c}" for c in expanded.columns])
    y = expanded.toDF(*["token" if c == "token" else f"y_{c}" for c in expanded.columns])
    pairs = (
        x.join(y, "token")
        .where(F.col("x_component") < F.col("y_component"))
        .where(_close("x_", "y_"))
        .select(F.col("x_set").alias("a"), F.col("y_set").alias("b"))
        .distinct()
    )
    links.add(_similar(pairs, sets))
    return links


def near_duplicates(
    docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row ``doc_id``, ``n_shingles`` and ``component_id``.

    Two rows have the same component if links lead from one to the other; it is named by its
    least id. The result is written to ``scratch``; everything else there is deleted.
    """
    bounded_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text"))
    signatures = scratch.save(_signatures(rows), "signatures")
    classes = scratch.save(
        signatures.where("open").groupBy("set").agg(F.min("_id").alias("first")), "classes"
    )
    sets = scratch.save(_candidates(rows, _id_filter(classes)), "sets")
    if sets.count() > sets.select("set").distinct().count():
        sets = scratch.save(sets.dropDuplicates(["set"]), "distinct-sets")
    named = _linked(sets, scratch).of(classes, "set", "component")
    names = named.groupBy("component").agg(F.min("first").alias("name"))
    by_set = named.join(names, "component").select("set", "name")
    result = scratch.save(
        signatures.join(by_set, "set", "left").select(
            F.col("_id").alias("doc_id"),
            F.col("n").alias("n_shingles"),
            F.coalesce("name", "_id").alias("component_id"),
        ),
        "result",
    )
    scratch.drop(
        "signatures", "classes", "sets", "distinct-sets", "members", "postings",
        *[f"{kind}-{i}" for kind in ("links", "labels") for i in range(STAR_ROUNDS + 3)],
    )
    return result


def one_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """One row of each component, with all its columns: the one that the component is named by.

    Rows that share an id are one document, of which one row stays. Rows without an id stay
    unless they are in a component that has a name.
    """
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    names = found.groupBy(F.col("doc_id").alias("_id")).agg(
        F.count("*").alias("_rows"), F.max(stays).alias("_stays")
    )
    names = names.where("_stays")
    one = (names["_rows"] == 1) | names["_id"].isNull()
    same = docs["doc_id"].eqNullSafe(names["_id"])
    alone = docs.join(names.where(one), same, "left_semi")
    several = docs.join(names.where(~one), same, "left_semi")
    return alone.unionByName(several.dropDuplicates(["doc_id"]))
